import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import katz
from tessera.llm.queries import op3_katz_backoff


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


class Brute:
    """Katz backoff over word pairs, from the definition."""

    def __init__(self, texts):
        self.uni, self.bi, self.ctx = Counter(), Counter(), Counter()
        for t in texts:
            w = ["<s>", *words(t), "</s>"]
            self.uni.update(w[1:])
            self.bi.update(zip(w, w[1:]))
            self.ctx.update(w[:-1])
        self.n = sum(self.uni.values())
        self.r1, self.r2 = self.star(self.uni), self.star(self.bi)
        self.left = 1 - sum(self.r1(c) for c in self.uni.values()) / self.n
        self.after = defaultdict(dict)
        for (a, b), c in self.bi.items():
            self.after[a][b] = c

    @staticmethod
    def star(counts):
        hist = Counter(counts.values())

        def f(r):
            g = (r + 1) * hist[r + 1] / hist[r] if r <= katz.CUT else 0
            return g if 0 < g < r else r - 0.5
        return f

    def p1(self, b):
        return self.r1(self.uni[b]) / self.n if b in self.uni else self.left

    def alpha(self, a):
        if a not in self.after:
            return 1.0
        s = self.after[a]
        return (1 - sum(self.r2(c) for c in s.values()) / self.ctx[a]) / (1 - sum(self.p1(b) for b in s))

    def p(self, a, b):
        return self.r2(self.bi[a, b]) / self.ctx[a] if (a, b) in self.bi else self.alpha(a) * self.p1(b)

    def score(self, t):
        w = ["<s>", *words(t), "</s>"]
        return sum(math.log10(self.p(a, b)) for a, b in zip(w, w[1:]))

    def base(self, t):
        return sum(math.log10((self.uni[b] + 0.5) / (self.n + 0.5 * (len(self.uni) + 1))) for b in [*words(t), "</s>"])


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def check(got, docs):
    m = Brute([t for i, t in docs if not held(i)])
    assert len(got) == len(docs)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for i, t in docs:
        w = [*words(t), "</s>"]
        r = next(r for r in by[i] if r.n_tokens == len(w))
        assert r.held_out == held(i) and r.train_tokens == m.n and r.n_known == sum(x in m.uni for x in w)
        assert math.isclose(r.base_score, m.base(t), rel_tol=1e-9) and math.isclose(r.score, m.score(t), rel_tol=1e-9), i
    return m


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = op3_katz_backoff(spark, d).collect()
    m = check(got, docs)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    vocab = list(m.uni)
    for a in ["<s>", *vocab[:30], "never seen"]:
        assert abs(sum(m.p(a, b) for b in vocab) + m.p(a, "no such word") - 1) < 1e-9


@pytest.mark.parametrize("hot,entries", [(3, 150), (40, 10 ** 6), (400, 400)])
def test_partitions_and_frequent_lists_change_nothing(spark, monkeypatch, hot, entries):
    rng = np.random.default_rng(hot)
    docs = [(int(i), " ".join(f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(0, 40)) if x < 300)) for i in range(150)]
    docs += [(200 + i, "the same words stand in every one of these") for i in range(60)]
    monkeypatch.setattr(katz, "HOT", hot)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    check(katz.score(df, entries).collect(), docs)


def test_copies_take_nothing_off_the_frequent_lists(spark, monkeypatch):
    monkeypatch.setattr(katz, "HOT", 200)
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.5, 60) if x < 3000)) for i in range(400)]
    plain = spark.createDataFrame(docs, "doc_id long, text string")
    copied = plain.union(spark.range(5000).selectExpr("id + 1000", "'only here such words are'"))
    a, b = katz.frequent(plain), katz.frequent(copied)
    own = set(katz.word_hashes([w.encode() for w in "only here such words are".split()]).tolist())
    assert len(a.words) > 5 and set(b.words.tolist()) == set(a.words.tolist()) | own
    assert set(a.pairs.tolist()) <= set(b.pairs.tolist())


def test_edge_rows(spark):
    docs = [(0, None), (3, ""), (3, ""), (3, " a A\tb "), (None, "a b"), (2, "x"), (4, "x a"), (5, "ü é")]
    df = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id long, text string, score double")
    check(katz.score(df).collect(), docs)
    assert katz.score(df.limit(0)).count() == 0
    only = [i for i in range(60) if held(i)][:3]
    got = katz.score(spark.createDataFrame([(i, "a b") for i in only], "doc_id long, text string")).collect()
    assert [(r.n_known, r.train_tokens, r.score) for r in got] == [(0, 0, 0.0)] * 3


def test_pack_round_trip():
    cols = [np.array([1, 2, 2 ** 40]), np.array([], np.int64), np.array([3, 2 ** 63], np.uint64), np.array([0.5]), np.array([True, False])]
    back = katz.unpack(katz.pack(*cols))
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(cols, back))
