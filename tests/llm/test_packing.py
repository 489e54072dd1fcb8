"""Best-fit decreasing against a search over all open windows; pieces against the library's ids."""

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import packing as pk
from tessera.llm import queries as q
from tessera.llm.queries import tokenizer_json

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_str(tokenizer_json())


@pytest.fixture(scope="module")
def words():
    return pk.RankBPE(tokenizer_json())


def reference_best_fit(lengths, window):
    """Rooms after placing each length in the tightest window, all windows tried."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(window - n)
    return sorted(rooms)


@settings(max_examples=150, deadline=None)
@given(st.integers(2, 70).flatmap(lambda w: st.tuples(st.just(w), st.lists(st.integers(1, w - 1), max_size=60))))
def test_tree_finds_the_tightest_window(case):
    window, lengths = case
    got = pk.best_fit([(i, 0, n) for i, n in enumerate(lengths)], window, [])
    assert sorted(window - sum(p[2] for p in w) for w in got) == reference_best_fit(lengths, window)
    full, left = pk.close_windows(got, window)
    assert all(sum(p[2] for p in w) == window for w in full)
    assert sum(p[2] for p in left) == sum(lengths) % window
    tail = pk.powers_of_two(left)
    assert all((n := sum(p[2] for p in w)) & n - 1 == 0 for w in tail)
    seen = defaultdict(list)
    for w in full + tail:
        for doc, start, n in w:
            assert n > 0
            seen[doc] += range(start, start + n)
    assert {d: sorted(x) for d, x in seen.items()} == {i: list(range(n)) for i, n in enumerate(lengths)}


def test_blocks_go_on_with_the_open_window():
    rng = random.Random(1)
    docs = [(i, np.arange(rng.randint(1, 3000), dtype="<u4").tobytes()) for i in range(400)]
    for block in (1, 500, 10**9):
        rows = list(pk.Packer(64, 7 << 33, block).pack(iter(docs)))
        check(rows, dict(docs), 64, tails=6)


def check(rows, ids_of, window, tails):
    """Every id in exactly one piece; sequences gapless; at most ``tails`` sequences below a
    window, all powers of two."""
    docs, sequences = defaultdict(dict), defaultdict(dict)
    for key, start, length, ids, total, sequence, offset in rows:
        assert len(ids) == 4 * length and total == len(ids_of[key]) // 4
        assert start not in docs[key] and offset not in sequences[sequence]
        docs[key][start], sequences[sequence][offset] = ids, length
    assert {k: b"".join(x[s] for s in sorted(x)) for k, x in docs.items()} == ids_of
    short = 0
    for x in sequences.values():
        at = 0
        for offset in sorted(x):
            assert offset == at
            at += x[offset]
        assert at <= window and (at == window or at & at - 1 == 0)
        short += at < window
    assert short <= tails


@pytest.mark.parametrize("text", ["", " ", "a", "a b", "a  b", "a \n b\n \nc", "l'été  d'or  x", "　 y", "x <|endoftext|> z<|endoftext|>", "tab\t tab", "é à  ", "don't we 'll",
                                  "1 2 33 ,, .\n\n\n  end ", "  thin", "a" * 5000, "word " * 3000, "\x1c x\x85 y"])
def test_words_equal_the_library(words, plain, text):
    assert np.frombuffer(words.encode(text.encode()), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'sré1.,\n\t   \x1c🙂")), max_size=40))
def test_any_spacing_equals_the_library(words, plain, text):
    assert np.frombuffer(words.encode(text.encode()), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_long_pieces_and_other_files_go_to_the_fragment_encoder(words, plain):
    for text in ("a" * 9_000, " " * 9_000 + "x", "ab\n" * 3_000, "é" * 3_000 + " end"):
        assert np.frombuffer(words.encode(text.encode()), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert words.ranks is not None
    spec = json.loads(tokenizer_json())
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    other = pk.RankBPE(json.dumps(spec))
    assert other.ranks is None
    assert np.frombuffer(other.encode(b"some other text"), "<u4").tolist() == Tokenizer.from_str(json.dumps(spec)).encode("some other text", add_special_tokens=False).ids


def test_edge_rows(spark, plain):
    long = "every window of this text is full " * 20_000
    rows = [(1, None, "s"), (1, "", "t"), (None, "no id", "u"), (2, long, "v"), (3, "same text", "w"), (3, "same text", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset string")
    got = pk.pack(df, tokenizer_json(), keep=("doc_id", "offset")).collect()
    assert got[0].asDict().keys() == {"doc_id", *pk.RESULT}
    want = sum(len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in rows)
    assert sum(r["length"] for r in got) == want
    assert sorted(r["doc_tokens"] for r in got if r["doc_id"] == 1) == [1, 1]
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
    assert pk.pack(df.limit(0), tokenizer_json()).collect() == []


def test_assembled_sequences(spark, plain):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = pk.pack(df, tokenizer_json())
    whole = pk.assembled(pieces).collect()
    assert all(len(r["ids"]) == 4 * r["n_tokens"] <= 4096 for r in whole)
    want = sum(len(plain.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in df.collect())
    assert sum(r["n_tokens"] for r in whole) == want


def test_query_equals_the_library(spark, plain):
    """Each id in one piece, by its crc32; windows full but for powers of two."""
    ids = {r["doc_id"]: np.array(plain.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
           for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = q.QUERIES["op11_best_fit_packing"](spark, SF).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset").collect()
    rows = []
    for doc, start, length, crc, total, sequence, offset in got:
        piece = ids[doc][4 * start:4 * (start + length)]
        assert zlib.crc32(piece) == crc
        rows.append((doc, start, length, piece, total, sequence, offset))
    check(rows, ids, 1024, tails=10 * 8)
