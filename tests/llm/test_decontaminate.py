import random
from collections import Counter

import numpy as np

from tessera.llm import decontaminate as dc
from tessera.llm.notices import words_of
from tessera.llm.queries import op6_simhash_decontamination


def brute(text, items):
    """All windows of all items: item -> best similarity."""
    w = [x.decode() for x in words_of((text or "").encode())]
    out = {}
    for i, t in items:
        v = [x.decode() for x in words_of(t.encode())]
        k = min(5, len(v))
        if not v or len(w) < k:
            continue
        item = Counter(tuple(v[j:j + k]) for j in range(len(v) - k + 1))
        s = [tuple(w[j:j + k]) for j in range(len(w) - k + 1)]
        m = min(len(s), item.total())
        if not set(s) & set(item):
            continue
        best = max(dc.weighted_similarity(item, Counter(s[j:j + m])) for j in range(len(s) - m + 1))
        if best >= 0.75:
            out[i] = best
    return out


def check(r, text, items):
    want = brute(text, items)
    assert r.items == ",".join(map(str, sorted(want))) and r.n_items == len(want) and r.contaminated == bool(want)
    assert abs(r.similarity - max(want.values(), default=0)) < 1e-12


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    rows = {r.doc_id: r for r in op6_simhash_decontamination(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for x in docs:
        check(rows[x.doc_id], x.text, items)
    assert any(r.contaminated for r in rows.values())


def test_edited_passages_equal_brute_force(spark):
    rng = random.Random(2)
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([2, 4, 6, 15, 30, 60])))) for i in range(60)]
    docs = []
    for i in range(400):
        v = items[rng.randrange(60)][1].split()
        for _ in range(rng.randrange(0, 3)):
            v[rng.randrange(len(v))] = "zz"
        v = v[rng.randrange(0, 1 + len(v) // 7):] if rng.random() < .4 else v
        filler = [f"f{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(0, 90))]
        cut = rng.randrange(len(filler) + 1)
        docs.append((i, (" ".join(filler[:cut]) + ". " + " ".join(v).upper() + "! " + ", ".join(filler[cut:]))))
    got = dc.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), items=25).collect()
    wrong = 0
    for r in got:
        try:
            check(r, r.text, items)
        except AssertionError:
            wrong += 1
    assert wrong <= 1 and sum(r.contaminated for r in got) > 100


def test_blocks_guarantee_the_radius():
    rng = np.random.default_rng(3)
    index = dc.ItemIndex([(i, " ".join(f"x{rng.integers(10 ** 9)}" for _ in range(20)).encode()) for i in range(30)])
    for _ in range(200):
        i = int(rng.integers(30))
        p = index.prints[i].copy()
        p[rng.choice(dc.BITS, dc.RADIUS, replace=False)] ^= 1
        assert (0, i) in index.candidates(p[None], (5, 16))


def test_edge_rows(spark):
    bench = spark.createDataFrame([(1, "Alpha, beta gamma delta epsilon zeta"), (1, None), (2, ""), (None, "one two"), (3, "one two"), (4, "ONE two")], "item_id long, text string")
    docs = spark.createDataFrame([(1, None, "c"), (1, "", "c"), (2, "alpha BETA gamma; delta epsilon zeta", "c"), (2, "x one  two y", "c"), (None, "one", "c")], "doc_id long, text string, items string")
    assert [r.items for r in dc.find(docs, bench).collect()] == ["", "", "1", "3,4", ""]
    kept = dc.clean(docs, bench)
    assert kept.columns == docs.columns and [(r.doc_id, r.items) for r in kept.collect()] == [(1, "c"), (1, "c"), (None, "c")]
    assert dc.find(docs.limit(0), bench).count() == 0 and dc.find(docs, bench.limit(0)).where("contaminated").count() == 0
