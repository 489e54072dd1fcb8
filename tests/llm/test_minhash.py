import random
import re

import numpy as np
import pytest

from tessera.llm import minhash as mh
from tessera.llm.common import components, shingle_set
from tessera.llm.queries import op2_multi_index_minhash


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """doc_id -> (n_shingles, component)."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    by = {}
    for i, s in sets.items():
        for g in s:
            by.setdefault(g, []).append(i)
    count = {}
    for ids in by.values():
        for a in ids:
            for b in ids:
                if a < b:
                    count[a, b] = count.get((a, b), 0) + 1
    for (a, b), n in count.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    d = f"/root/testdata/{sf}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op2_multi_index_minhash(spark, d).collect()}
    assert got == brute(rows)
    assert len({c for _, c in got.values()}) < len(rows)


def test_edited_copies_equal_brute_force(spark):
    rng = random.Random(5)
    rows, i = [], 0
    common = [f"c{k}" for k in range(40)]
    for _ in range(25):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.choice([3, 6, 40, 150]))] + common * rng.randrange(2)
        for _ in range(rng.randrange(1, 14)):
            w = list(words)
            for _ in range(rng.randrange(0, 9)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
            rows.append((i, " ".join(w[rng.randrange(0, 3):]) if len(w) > 9 else "\n".join(w).upper()))
            i += 1
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in mh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(80)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(80)] = f"e{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    df, want = spark.createDataFrame(rows, "doc_id long, text string"), brute(rows)
    for block, size in ((1024, 10 ** 8), (20, 4000)):
        monkeypatch.setattr(mh, "BLOCK", block)
        monkeypatch.setattr(mh, "UNIT_BYTES", size)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in mh.near_duplicates(df).collect()} == want


def test_pigeonhole_guarantee():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 2 ** 16, mh.SYMBOLS)
        b = a.copy()
        at = rng.choice(mh.SYMBOLS, mh.RADIUS, replace=False)
        b[at] ^= 1
        assert set(mh.keys(a)) & set(mh.keys(b))


def test_symbol_agreement_estimates_similarity():
    rng = np.random.default_rng(2)
    same = []
    for k in range(200):
        s = rng.integers(0, 2 ** 63, 500).astype(np.uint64)
        t = np.r_[s[:428], rng.integers(0, 2 ** 63, 72).astype(np.uint64)]
        a, b = mh.minima(s), mh.minima(t)
        same.append((a == b).mean())
        assert (mh.screen(a) != mh.screen(b)).sum() <= mh.FAR
    assert abs(np.mean(same) - 428 / 572) < 0.02


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(150)] + [(500, k) for k in range(501, 560)] + [(9, 9)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i
    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert {k: v for k, v in got.items() if k != v} == {k: find(k) for k in root if find(k) != k}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edge_rows(spark):
    t = "one two three four five six"
    df = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, " \n", 1), (5, t, 1), (4, t.upper(), 1), (4, t, 1), (None, t, 1), (6, "a b", 1), (7, "A  b", 1)], "doc_id long, text string, kept int")
    got = sorted(((r.doc_id or -1), r.n_shingles, r.component_id, r.kept) for r in mh.near_duplicates(df).collect())
    assert got == [(-1, 2, 4, False), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 2, 4, True), (4, 2, 4, True), (5, 2, 4, False), (6, 1, 6, True), (7, 1, 6, False)]
    assert sorted(r.doc_id or -1 for r in mh.deduplicated(df).collect()) == [1, 2, 3, 4, 6]
    assert mh.near_duplicates(df.limit(0)).count() == 0
    assert len(shingle_set(b"a b")) == 1


def test_rows_of_one_id_with_two_texts_link_all_their_partners(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    df = spark.createDataFrame([(5, a), (5, b), (7, a + " more"), (8, b + " more"), (9, "quite another text of its own")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id, r.kept) for r in mh.near_duplicates(df).collect()} == {(5, 5, True), (7, 5, False), (8, 5, False), (9, 9, True)}
    assert sorted(r.doc_id for r in mh.deduplicated(df).collect()) == [5, 9]


def test_one_copy_stays_where_ids_repeat_or_are_null(spark):
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(None, t, 1), (None, t, 1), (3, t, 1), (3, t, 1), (None, "alone it stands without an id", 2), (None, "alone it stands without an id", 3), (None, None, 4), (None, "", 5)],
                               "doc_id long, text string, n_shingles int")
    got = mh.deduplicated(df).collect()
    assert [r.doc_id for r in got if r.text == t] == [3]
    assert len([r for r in got if r.text and r.text.startswith("alone")]) == 1
    assert sorted(r.n_shingles for r in got if not r.text) == [4, 5]
    near = " ".join(f"w{i}" for i in range(29)) + " other"  # a near copy, found through rows without an id
    only = mh.deduplicated(df.where("doc_id is null").unionByName(spark.createDataFrame([(None, near, 1)], df.schema))).collect()
    assert len([r for r in only if r.text and r.text.startswith("w0")]) == 1


def test_very_long_texts(spark):
    t = " ".join(f"w{i}" for i in range(200_000))
    df = spark.createDataFrame([(1, t), (2, t + " end"), (3, "x" * 500_000)], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in mh.near_duplicates(df).collect()} == {(1, 1), (2, 1), (3, 3)}
