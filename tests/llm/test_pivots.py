import numpy as np
import pytest

from tessera.llm import pivots as pv
from tessera.llm.queries import op1_pivot_permutation


def brute(rows):
    """vec_id -> (links, component) by all pairs; rows are (id, vector or None, label)."""
    good = [(i, np.array(v, float), lab) for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    root = {i: i for i, _, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    links = {i: 0 for i in root}
    for n, (i, x, lab) in enumerate(good):
        for j, y, other in good[n + 1:]:
            if lab == other and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (links[i], find(i)) for i in root}


def got(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    assert got(op1_pivot_permutation(spark, "/root/testdata/sf0.01")) == brute(rows)


def planted(n=900, d=64, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        c = rng.normal(size=d)
        for _ in range(rng.choice([1, 1, 2, 5, 60])):
            v = c + rng.normal(size=d) * np.linalg.norm(c) / d ** 0.5 * rng.choice([0, 0.02, 0.1, 0.14, 0.2])
            rows.append((len(rows), (v * rng.choice([1, 7])).astype(np.float32).tolist(), int(rng.integers(3)) if rng.random() < .9 else 0))
    return rows


def test_recall_of_planted_links(spark):
    rows = planted()
    want, have = brute(rows), got(pv.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")))
    n = sum(x for x, _ in want.values())
    assert n > 2000 and all(have[i][0] <= want[i][0] for i in want)
    assert sum(x for x, _ in have.values()) >= 0.99 * n


def crowded(n, noise, seed=0, d=64):
    """A third of ``n`` rows is one group round a centre; the others are pairs."""
    rng = np.random.default_rng(seed)
    c, m = rng.normal(size=d), n // 3
    group = c + rng.normal(size=(m, d)) * noise * np.linalg.norm(c) / d ** 0.5
    pairs = np.repeat(rng.normal(size=((n - m + 1) // 2, d)), 2, 0)[:n - m]
    return np.r_[group, pairs + rng.normal(size=pairs.shape) * 0.1].astype(np.float32)


@pytest.mark.parametrize("noise", [0.1, 0.14, 0.2])
def test_links_of_a_group_of_a_third_of_the_rows(spark, noise):
    x = crowded(10_000, noise)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = (u @ u.T >= pv.LEAST_COSINE).sum(1) - 1
    have = got(pv.near_duplicates(spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")))
    links = np.array([have[i][0] for i in range(len(x))])
    m = len(x) // 3
    assert (links[:m] == want[:m]).all() and want[:m].sum() > 0
    assert (links <= want).all() and links[m:].sum() >= 0.99 * want[m:].sum()


def test_blocks_give_the_same(spark, monkeypatch):
    df = spark.createDataFrame(planted(300, seed=4), "vec_id long, embedding array<float>, label int")
    whole = got(pv.near_duplicates(df))
    monkeypatch.setattr(pv, "BLOCK", 7)
    assert got(pv.near_duplicates(df)) == whole


def test_edge_rows(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [None, 1.0], 1),
            (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.1], 1), (None, [1.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, kept string")
    out = sorted(((r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in pv.near_duplicates(df).collect())
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10)]
    assert out == [(0, 4, None, True), (1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), *alone, (11, 4, 1, False)]
    assert pv.near_duplicates(df.limit(0)).count() == 0
