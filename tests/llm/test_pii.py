import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import pii
from tessera.llm.boosting import BoostedTrees
from tessera.llm.queries import op5_boosted_pii

SF = "/root/testdata/sf0.01"


def brute(t):
    """The contract's patterns, as written."""
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else (2 * int(c)) // 10 + (2 * int(c)) % 10 for i, c in enumerate(reversed(d))) % 10 == 0
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from("01234567889..@@+-  ()ab%é٣"), max_size=50))
def test_base_spans_equal_patterns(t):
    assert pii.base_spans(t) == brute(t)


@pytest.mark.parametrize("t", ["a@b.c@d.e", "x@@y.z", "1.2.3.4.5.6.7.8", "300.1.1.1 1.2.3.4", "4111 1111 1111 1111 4", "+1 (555) 010-99999", "4111-1111-1111-1111", "+" + "1" * 30])
def test_base_examples(t):
    assert pii.base_spans(t) == brute(t)


@pytest.fixture(scope="module")
def got(spark):
    return {r.doc_id: r for r in op5_boosted_pii(spark, SF).collect()}


def test_query_base_equals_brute_force(spark, got):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    extra = 0
    for d in docs:
        base, r = brute(d.text), got[d.doc_id]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in base) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert {f"{k}:{a}:{b}" for a, b, k in base} <= set(spans)
        extra += len(spans) - len(base)
    assert extra <= 0.02 * len(docs)  # plain texts are left alone


def test_disguised_spans_are_added(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = pii.fit(docs)
    assert set(model.least) >= {"email", "phone", "card"}
    for s, kind in (("jo.doe at mail7 dot example dot com", "email"), ("jo.doe [at] mail7.example.com", "email"), ("(136) 555-7479", "phone"),
                    ("4111.1111.1111.1111", "card"), ("10[.]20[.]30[.]40", "ip")):
        t = f"Ering the onea {s} tion of the whea."
        assert (15, 15 + len(s), kind) in [x[:3] for x in model.added(t, pii.base_spans(t))], s
    for s in ("we met at noon and ate the pie", "order 4111111111111112 of", "version 1.2.3 at 10:30", "in 2003 2004 2005"):
        assert model.added(s, pii.base_spans(s)) == []


def test_copies_of_one_row_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    one = docs.where("text rlike '[0-9]{4}|@'").orderBy("doc_id").limit(1)
    many = docs.union(one.crossJoin(spark.range(5000)).select("doc_id", "text"))
    a, b = pii.fit(docs), pii.fit(many)
    assert a.least == b.least and set(a.least) >= {"email", "phone", "card"}


def test_union_of_spans():
    base = pii.base_spans("a@" + ".".join(["1"] * 60) + " z")
    assert len(base) > 9 and pii._union(base) == [(0, 121)] and pii._overlaps(pii._union(base), 100, 130)
    assert not pii._overlaps(pii._union(base), 121, 130) and not pii._overlaps([], 0, 9)


def test_redaction_and_edges(spark):
    assert pii.redacted("a x@y.zz b", [(2, 8, "email")]) == "a [EMAIL] b"
    model = pii.SpanModel(np.empty((0, 3)), np.empty(0))
    df = spark.createDataFrame([(1, None, 5), (1, "", 5), (None, "x@y.zz", 5)], "doc_id long, text string, n_email int")
    out = pii.find(df, model, redact=True).collect()
    assert [r.redacted for r in out] == ["", "", "[EMAIL]"] and [r.n_email for r in out] == [0, 0, 1]
    assert out[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find(df.limit(0), pii.fit(df.limit(0))).count() == 0


def test_boosted_trees_learn_xor():
    x = np.random.default_rng(0).random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = BoostedTrees(rounds=80).fit(x[:1000], y[:1000]).calibrate(x[1000:1500], y[1000:1500])
    assert (((m.probability(x[1500:]) > 0.5) == y[1500:]).mean()) > 0.95
