"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be joined by a merge, so the place
between its bytes is a certain cut. A text is cut there, each distinct fragment is encoded once
per task by the tokenizers library, and the ids are concatenated: the result equals encoding the
whole text. Fragments are word-sized, so a very long text needs no long merge loop.

A cut must also leave the pre-tokenizer's split unchanged. Its pattern looks ahead only behind
white space and reads contractions from an apostrophe, so no cut is made behind white space,
before an apostrophe, or between the letters of a contraction; nor inside a character.

Edge cases: null and empty texts give no ids (the hash of no bytes) and decode to the empty
text; repeated rows give repeated results; strings of special tokens become their ids, as the
library does; other columns of the input are kept, those named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import texts_of, with_columns

# Unicode White_Space beyond ASCII, as UTF-8 (fixed values of the standard).
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
# The letters of the contractions in the byte-level pre-tokenizer's pattern (fixed values).
_CONTRACTIONS = (b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d")


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the code
    points from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def token_bytes(tokenizer_json: str) -> list[bytes]:
    """Bytes of every id; special tokens stand for their own text."""
    spec = json.loads(tokenizer_json)
    chars = byte_of_char()
    words = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    special = {t["content"] for t in spec["added_tokens"]}
    out = [b""] * (max(words.values()) + 1)
    for w, i in words.items():
        out[i] = w.encode() if w in special else bytes(chars[c] for c in w)
    return out


def cut_table(tokens: list[bytes]) -> np.ndarray:
    """For each pair of bytes (first * 256 + second): is the place between them a certain cut?"""
    cut = np.ones(1 << 16, bool)
    for t in (*tokens, *_CONTRACTIONS):
        for x, y in zip(t, t[1:]):
            cut[x << 8 | y] = False
    cut = cut.reshape(256, 256)
    cut[[*range(9, 14), *range(28, 33)], :] = False  # behind white space the pattern looks ahead
    cut[:, 0x27] = False
    cut[:, 0x80:0xC0] = False  # inside a character
    return cut.reshape(-1)


def fragments(text: bytes, cut: np.ndarray) -> list[bytes]:
    """The text, split at every certain cut."""
    if not text:
        return []
    b = np.frombuffer(text, np.uint8).astype(np.uint16)
    at = (np.flatnonzero(cut[b[:-1] << 8 | b[1:]]) + 1).tolist()
    if wide := {m.end() for m in _WIDE_SPACE.finditer(text)}:
        at = [i for i in at if i not in wide]
    return [text[i:j] for i, j in zip([0, *at], [*at, len(text)])]


class ForcedBoundaryBPE:
    """Encoder and decoder of one task. ``keep`` bounds the fragments remembered; the memory is
    emptied when full, which costs time only."""

    def __init__(self, tokenizer_json: str, keep: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokens = token_bytes(tokenizer_json)
        self.cut = cut_table(self.tokens)
        self.keep, self.known = keep, {}

    def encode(self, text: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts = fragments(text, self.cut)
        if len(self.known) > self.keep:
            self.known = {}
        new = [p for p in set(parts) if p not in self.known]
        if new:
            for p, e in zip(new, self.tokenizer.encode_batch([p.decode() for p in new], add_special_tokens=False)):
                self.known[p] = np.array(e.ids, "<u4").tobytes()
        return b"".join(map(self.known.__getitem__, parts))

    def decode(self, ids: bytes) -> bytes:
        """Text of the ids, as UTF-8; special tokens are kept."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace").encode()


def encode_documents(docs: DataFrame, tokenizer_json: str, text: str = "text", with_ids: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for,
    ``token_ids`` (the ids as little-endian unsigned 32-bit integers)."""
    def make():
        bpe = ForcedBoundaryBPE(tokenizer_json)

        def run(batch: pa.RecordBatch) -> dict:
            ids = [bpe.encode(t) for t in texts_of(batch, text)]
            out = {"n_tokens": [len(i) // 4 for i in ids],
                   "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
                   "decoded_sha256": [hashlib.sha256(bpe.decode(i)).hexdigest() for i in ids]}
            return out | ({"token_ids": ids} if with_ids else {})
        return run

    return with_columns(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids binary" * with_ids, make)
