import random

from conftest import rows
from tessera.operators import joins as J


def _runs(spark, sizes, seed):
    rnd = random.Random(seed)
    data = []
    for k, n in enumerate(sizes):
        for _ in range(n):
            a, b = rnd.randint(0, 40), rnd.randint(0, 40)
            s, e = (a, b) if rnd.random() < 0.1 else (min(a, b), max(a, b))
            data.append((k, len(data), s, e, -5, 70))
    return spark.createDataFrame(data, "k int, id int, s long, e long, ss long, se long"), data


def test_few_runs_are_compared_in_their_list(spark):
    df, data = _runs(spark, [4, 1, 2, 7, 32], 8)
    few, rest = J._by_group_size(df, ["k"], ["s", "e"])
    assert few.count() == len(data) and rest.count() == 0
    per = J._overlap_of_few(few.selectExpr("k", "id AS __id", "s AS __s", "e AS __e"), ["k"])
    got = rows(per.selectExpr("k", "__id", "I_e - I_s", "A", "B", "Z"))
    of = lambda r: [x for x in data if x[0] == r[0]]
    upto = lambda r, t: sum(max(t - x[2], 0) - max(t - x[3], 0) for x in of(r))
    assert got == sorted((r[0], r[1], upto(r, r[3]) - upto(r, r[2]), sum(x[2] < r[3] for x in of(r)), sum(x[3] <= r[2] for x in of(r)),
                          sum(x[2] == x[3] == r[2] for x in of(r))) for r in data)

    def kinds(o):
        for _, _, s, e, _, se in of(o):
            if s < o[2] < e < o[3]:
                yield e - o[4]
            elif o[2] < s < o[3] < e:
                yield se - o[2]
            elif o[2] <= s <= o[3] and o[2] <= e <= o[3]:
                yield e - o[2]
    got = rows(J._kinds_of_few(few.withColumnRenamed("id", "__id"), ["k"]), "k", "__id", "__t", "__n")
    assert got == sorted((o[0], o[1], sum(kinds(o)), len([*kinds(o)])) for o in data if o[2] <= o[3])


def test_larger_groups_and_rows_without_key_or_time_are_swept(spark):
    df, data = _runs(spark, [33, 2, 2], 9)
    odd = spark.createDataFrame([(None, 100, 1, 2, 0, 9), (2, 101, None, 3, 0, 9)], df.schema)
    few, rest = J._by_group_size(df.unionByName(odd), ["k"], ["s", "e"])
    assert {r[0] for r in few.select("k").distinct().collect()} == {1}
    assert {r[0] for r in rest.select("k").distinct().collect()} == {0, 2, None} and few.count() + rest.count() == 39
