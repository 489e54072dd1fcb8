import itertools
import zlib

import numpy as np
import pytest

from tessera.llm import toxicity as tx
from tessera.llm.queries import op4_deobfuscated_toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def fitted(spark):
    return tx.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_model_is_normalised(fitted):
    assert np.allclose(np.exp(fitted.model.astype(float)).sum(1), 1, atol=1e-4)


@pytest.mark.parametrize("seen,meant", [("1d1ot", "idiot"), ("stup!d", "stupid"), ("p@thetic", "pathetic"), ("tr4sh", "trash"), ("s.t.u.p.i.d", "stupid"),
                                        ("s t u p i d", "stupid"), ("stuuuupid", "stupid"), ("w0rthl3ss", "worthless"), ("d1sgu5t1ng", "disgusting"), ("l0s3r", "loser")])
def test_restores_disguised_words(fitted, seen, meant):
    assert meant in tx.words_of(tx.Decoder(fitted.model).restore(f"The onea {seen} tion."))


def test_viterbi_equals_brute_force(fitted):
    d = tx.Decoder(fitted.model)
    for s in ("1d1ot", "m0r0n", "sc|m", "a1b", "cl0*n"):
        best = (-np.inf, "")
        for path in itertools.product(*tx.lattice(s), [(" ", 0.0)]):
            at, total = 0, sum(c for _, c in path)
            for ch in "".join(x for x, _ in path):
                code = 0 if ch == " " else ord(ch) - 96
                total += float(fitted.model[at, code])
                at = at % tx.SIZE ** 2 * tx.SIZE + code
            best = max(best, (total, "".join(x for x, _ in path).strip()))
        assert d.decode(s) == best[1]


@pytest.mark.parametrize("seen", ["*diot", "idio7", "tras4", "a$$", "1d*o*", "f**k", "**um", "l0s*r*", "a**b1", "wow!!", "!d!o!", "0123456a"])
def test_stars_and_end_signs_equal_brute_force(fitted, seen):
    d = tx.Decoder(fitted.model)
    best = (-np.inf, "")
    for path in itertools.product(*tx.lattice(seen), [(" ", 0.0)]):
        at, total = 0, 0.0
        for letters, cost in path:
            total += cost
            for ch in letters:
                code = 0 if ch == " " else ord(ch) - 96
                total += float(fitted.model[at, code])
                at = at % tx.SIZE ** 2 * tx.SIZE + code
        best = max(best, (total, "".join(x for x, _ in path).strip()))
    assert d.decode(seen) == d._all_states(seen) == best[1]
    assert d.restore(f"the {seen} is").split() == ["the", *best[1].split(), "is"]


@pytest.mark.parametrize("seen,meant", [("idio7", "idiot"), ("*diot", "idiot"), ("st**id", "stupid"), ("i***t", "idiot"), ("w*rthl*ss", "worthless"), ("stupid!", "stupid"), ("1d1o7!!!", "idiot")])
def test_restores_words_disguised_at_their_ends(fitted, seen, meant):
    assert meant in tx.words_of(tx.Decoder(fitted.model).restore(f"The onea {seen} tion."))


def test_a_run_of_signs_stands_for_as_many_letters(fitted):
    assert all(len(tx.lattice("b" + "*" * n + "d")) == n + 2 for n in (1, 4, 9))
    assert len(tx.lattice("*")[0]) == 27
    d = tx.Decoder(fitted.model)
    whole = d._all_states("a" + "*" * 600)
    tx._SAVED, held = 7, tx._SAVED
    try:
        assert d._all_states("a" + "*" * 600) == whole
    finally:
        tx._SAVED = held


def test_stars_at_the_end_equal_all_states(fitted):
    d = tx.Decoder(fitted.model)
    rng = np.random.default_rng(3)
    letters = list("abcdefghilmnorstu014@$!")
    for n in range(120):
        s = "".join(rng.choice(letters, rng.integers(0, 9))) + "*" * int(rng.integers(1, 6))
        assert d._viterbi(s) == d._all_states(s), s
    assert d._viterbi("wor" + "*" * 80) == d._all_states("wor" + "*" * 80)


def test_repeated_rows_of_an_id_do_not_change_the_model(spark):
    docs = [(i, f"text {i} " + ("you moron idiot" if i % 3 == 0 else "quiet words here")) for i in range(1, 60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(1, 60)], "doc_id long, toxic int")
    once = tx.fit(spark.createDataFrame(docs, "doc_id long, text string"), labels)
    rows = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 5]
    more = tx.fit(spark.createDataFrame(docs + [rows[0]] * 500, "doc_id long, text string"), labels)
    assert once.lexicon == more.lexicon and np.allclose(once.weights, more.weights)


def test_held_out_accuracy(spark):
    rows = op4_deobfuscated_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.98
    assert np.mean([r.predicted for r in rows if r.toxic]) > 0.9
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.01


def test_disguised_documents_are_caught(spark, fitted):
    clean = "The onea hetion of thering and eringst to ofand in thewh ha for onre. " * 4
    bad = clean + "You 1d1ot are w0rthl3ss s.c.u.m and a stuuupid m0ron. " + clean
    rows = tx.score(spark.createDataFrame([(1, clean, 9.0), (2, bad, 9.0), (3, None, 9.0), (3, "", 9.0)], "doc_id long, text string, score double"), fitted, restored=True).collect()
    assert [r.predicted for r in rows] == [0, 1, 0, 0]


def test_empty_tables_and_one_sided_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score < 0.01 for r in tx.score(docs, tx.fit(docs, none)).collect()] == [True, True]
    one = spark.createDataFrame([(1, 1), (1, 1), (None, 0), (1, None)], "doc_id long, toxic int")
    assert tx.score(docs.limit(0), tx.fit(docs.limit(0), one)).count() == 0


def test_long_texts_stay_linear(fitted):
    d = tx.Decoder(fitted.model)
    assert d.restore("a" * 300_000) and d.restore("a " * 50_000) is not None and d.restore("1a" * 50_000)
