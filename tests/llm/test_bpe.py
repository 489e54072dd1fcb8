import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm.bpe import ForcedBoundaryBPE, encode_documents, fragments
from tessera.llm.queries import op8_forced_boundary_bpe, tokenizer_json

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bpe():
    return ForcedBoundaryBPE(tokenizer_json())


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_str(tokenizer_json())


def same(bpe, plain, text):
    ids = np.frombuffer(bpe.encode(text.encode()), "<u4").tolist()
    want = plain.encode(text, add_special_tokens=False).ids
    assert ids == want, text
    assert bpe.decode(np.array(ids, "<u4").tobytes()).decode() == plain.decode(want, skip_special_tokens=False)


HARD = ["", " ", "\n\n a", "a  b", "x  \n\ty", "it's 'll ''s !'s a'S don't", "<|endoftext|>a<|endoftext|>", "é'é'e 　z",
        "a\x1c\x1c b", "日本語テキスト qz zq", "\U0001f600‍\U0001f600", "1234567890" * 50, "a" * 3000, "word " * 3000, "$$$ *** &&& !!x", "  q", "I' re"]


@pytest.mark.parametrize("text", HARD)
def test_equals_library(bpe, plain, text):
    same(bpe, plain, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aeqzZ'strvmld 1!$.\n\t  éßñ<|>　語"), max_size=60))
def test_equals_library_on_odd_texts(bpe, plain, text):
    same(bpe, plain, text)


def test_fragments_join_to_text(bpe):
    t = "Qzx the xyz, 'tis; jq.".encode()
    assert b"".join(fragments(t, bpe.cut)) == t and len(fragments(t, bpe.cut)) > 3


def test_query_matches_library(spark, plain):
    rows = {r.doc_id: r for r in op8_forced_boundary_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = plain.encode(d.text or "", add_special_tokens=False).ids
        r = rows[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(plain.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, 7), (1, "", 7), (None, "a b", None), (2, "a b", 1)], "doc_id long, text string, N_TOKENS int")
    out = encode_documents(df, tokenizer_json()).collect()
    assert [len(r.token_ids) // 4 for r in out] == [r.n_tokens for r in out] == [0, 0, 2, 2]
    assert encode_documents(df.limit(0), tokenizer_json()).count() == 0


def test_record_batches_are_bounded_by_bytes(spark):
    from tessera.llm import common

    key = common._BATCH_KEY
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, common._BATCH_DEFAULT)
        common.bounded_batches(spark)
        assert spark.conf.get(key) == f"{common.BATCH}b"
        spark.conf.set(key, "9m")
        common.bounded_batches(spark)
        assert spark.conf.get(key) in ("9m", f"{9 << 20}b")
    finally:
        spark.conf.set(key, before)
