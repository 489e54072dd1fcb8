"""Packing of documents into fixed windows by best-fit decreasing.

Every document is encoded, ended by a separator and cut into full windows first; what remains is
shorter than a window. A task collects the remainders of some millions of tokens (a block), takes
them by decreasing length and puts each into the open window with the least room that still holds
it. A segment tree indexed by remaining room finds that window in one climb and one descent.

What best fit leaves open is closed at the end of the block: the emptiest windows are taken apart
and their pieces, cut where needed, fill the room of the fullest. So at most one window stays open,
and it goes on into the next block. At the end of the task it is cut into sequences whose lengths
are powers of two, which need no padding. Each task packs its own documents: nothing is shuffled,
nothing passes the driver, memory is one block, and a task that is run again gives the same rows.

Edge cases: null and empty texts are one piece, the separator alone; a very long text fills windows
of its own and leaves one remainder; equal lengths are taken in the order of the rows; repeated
rows and ids are documents of their own; an empty table gives no piece; kept columns named like a
result are replaced by it.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.bpe import ForcedBoundaryBPE
from tessera.llm.common import record_batch, slices, texts_of

#: Tokens of remainders that a task places at once.
BLOCK_TOKENS = 2_000_000
#: Pieces that a task returns at once (at most a window of ids each).
_ROWS = 500

RESULT = {"start": T.LongType(), "length": T.LongType(), "ids": T.BinaryType(), "doc_tokens": T.LongType(), "sequence_id": T.LongType(), "offset": T.LongType()}


# ---- open windows ------------------------------------------------------------------------

class RoomTree:
    """Open windows by remaining room. ``count[i]`` holds the windows below tree node i; the leaf
    of room r lists the windows that have just that room."""

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.count = [0] * (2 * self.width)
        self.windows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        i = room + self.width
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes and gives (room, window) of the tightest window with room for ``need``; of
        equal ones the last added."""
        count, i = self.count, need + self.width
        if not count[i]:
            while i & 1 or not count[i + 1]:  # climb until a right neighbour holds a window
                i >>= 1
                if i <= 1:
                    return None
            i += 1
            while i < self.width:
                i = 2 * i + (not count[2 * i])
        room, at = i - self.width, i
        while at:
            count[at] -= 1
            at >>= 1
        return room, self.windows[room].pop()


Piece = tuple  # (document, start, length)


def best_fit(pieces: list[Piece], window: int, open_window: list[Piece]) -> list[list[Piece]]:
    """Windows of pieces, each shorter than ``window``; ``open_window`` is one that stands open.
    By decreasing length each piece goes to the tightest window that holds it."""
    windows, tree = [], RoomTree(window)
    if open_window:
        windows.append(list(open_window))
        tree.add(window - sum(p[2] for p in open_window), 0)
    for p in sorted(pieces, key=lambda p: -p[2]):
        found = tree.take(p[2])
        if found is None:
            found = window, len(windows)
            windows.append([])
        room, at = found
        windows[at].append(p)
        if room > p[2]:
            tree.add(room - p[2], at)
    return windows


def close_windows(windows: list[list[Piece]], window: int) -> tuple[list[list[Piece]], list[Piece]]:
    """(full windows, the one left open). Of the windows with room, the emptiest are taken apart
    into the fullest; a piece is cut only where it is longer than the room."""
    filled = [(sum(p[2] for p in w), w) for w in windows]
    full = [w for n, w in filled if n == window]
    rest = sorted((x for x in filled if x[0] < window), key=lambda x: -x[0])
    give = len(rest) - 1
    for take, (n, target) in enumerate(rest):
        room = window - n
        while room and take < give:
            doc, start, length = rest[give][1].pop()
            target.append((doc, start, min(length, room)))
            if length > room:
                rest[give][1].append((doc, start + room, length - room))
            room -= min(length, room)
            if not rest[give][1]:
                give -= 1
        if room:
            return full, target
        full.append(target)
        if take >= give:
            break
    return full, []


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """The pieces cut into windows whose lengths are falling powers of two."""
    out, left = [], sum(p[2] for p in pieces)
    todo = pieces[::-1]
    while left:
        need = 1 << left.bit_length() - 1
        left -= need
        out.append([])
        while need:
            doc, start, length = todo.pop()
            out[-1].append((doc, start, min(length, need)))
            if length > need:
                todo.append((doc, start + need, length - need))
            need -= min(length, need)
    return out


# ---- encoding ----------------------------------------------------------------------------

#: The split before the merges that byte-level tokenizers of this kind share (fixed value).
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes without or of white space beyond which a text goes to the fragment encoder: the rank
#: encoder's time grows with the square of a single piece's length.
_LONG = 2_000


class RankBPE:
    """Encodes whole texts with the merge ranks of a byte-level tokenizer file whose ids follow
    the order of its merges. Other files, and texts with a very long piece, go to the fragment
    encoder; the ids are those of the tokenizers library either way."""

    def __init__(self, tokenizer_json: str):
        import tiktoken

        spec = json.loads(tokenizer_json)
        self.fragments = ForcedBoundaryBPE(tokenizer_json)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        pre = spec.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
        self.ranks = None
        if plain and made == sorted(made) and len(made) + 256 + len(special) == len(self.fragments.tokens):
            ranks = {t: i for i, t in enumerate(self.fragments.tokens) if i not in special.values()}
            self.ranks = tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(text) > _LONG:
            lengths = list(map(len, text.split()))
            if max(lengths, default=0) > _LONG or len(text) - sum(lengths) - len(lengths) > _LONG:
                return self.fragments.encode(text)
        if self.ranks is None:
            return self.fragments.encode(text)
        return self.ranks.encode_to_numpy(text.decode(), allowed_special="all").astype("<u4").tobytes()


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer_json: str) -> RankBPE:
    """One encoder for all tasks of a worker."""
    return RankBPE(tokenizer_json)


# ---- packing -----------------------------------------------------------------------------

class Packer:
    """Packs the documents of one task. ``pack`` gives rows (document, start, length, ids,
    document's tokens, sequence, offset); ids of sequences start at ``first``."""

    def __init__(self, window: int, first: int, block: int = BLOCK_TOKENS):
        self.window, self.next, self.block = window, first, block
        self.open: list[Piece] = []

    def _rows(self, pieces: list[Piece]) -> Iterator[tuple]:
        at, sequence = 0, self.next
        self.next += 1
        for doc, start, length in pieces:
            key, base, ids, total = doc
            yield key, start, length, ids[4 * (start - base):4 * (start - base + length)], total, sequence, at
            at += length

    def pack(self, docs: Iterator[tuple]) -> Iterator[tuple]:
        """``docs``: (key, ids as bytes). A document's tail is kept as (key, start, ids, tokens)."""
        waiting, tokens = [], 0
        for key, ids in docs:
            n = len(ids) // 4
            base = n - n % self.window
            for start in range(0, base, self.window):
                yield from self._rows([((key, 0, ids, n), start, self.window)])
            if n > base:
                waiting.append(((key, base, ids[4 * base:], n), base, n - base))
                tokens += n - base
            if tokens >= self.block:
                yield from self._place(waiting)
                waiting, tokens = [], 0
        yield from self._place(waiting)
        for pieces in powers_of_two(self.open):
            yield from self._rows(pieces)

    def _place(self, waiting: list[Piece]) -> Iterator[tuple]:
        full, self.open = close_windows(best_fit(waiting, self.window, self.open), self.window)
        for pieces in full:
            yield from self._rows(pieces)


def pack(docs: DataFrame, tokenizer_json: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", window: int = 1024, separator: int = 0) -> DataFrame:
    """Pieces of all documents: the columns ``keep``, ``start`` and ``length`` in the document,
    ``ids`` (little-endian unsigned 32-bit integers), ``doc_tokens`` (separator included),
    ``sequence_id`` and ``offset``. Sequences hold ``window`` tokens, but for a task's last ones."""
    keep = tuple(c for c in keep if c.lower() not in RESULT)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, t) for n, t in RESULT.items()])
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode: Callable[[bytes], bytes] = _encoder(tokenizer_json).encode

        def encoded():
            for whole in batches:
                for batch in slices(whole):
                    # a kept value travels as a one-row slice, whatever its type
                    keys = batch.select(list(keep))
                    for i, t in enumerate(texts_of(batch, text)):
                        yield (keys, i), encode(t) + end

        def made(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows))
            kept = [pa.concat_arrays([k.column(c).slice(i, 1) for k, i in cols[0]]) for c in range(len(keep))]
            new = record_batch(dict(zip(RESULT, cols[1:])), T.StructType([T.StructField(n, t) for n, t in RESULT.items()]))
            return pa.RecordBatch.from_arrays(kept + new.columns, schema.names)

        rows = []
        for row in Packer(window, TaskContext.get().partitionId() << 33).pack(encoded()):
            rows.append(row)
            if len(rows) == _ROWS:
                yield made(rows)
                rows = []
        if rows:
            yield made(rows)

    return docs.select(*keep, text).mapInArrow(run, schema)


def assembled(pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the pieces of every sequence joined in order of offset. A
    sequence is at most a window of tokens, so a group is small whatever the corpus."""
    listed = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), listed.alias("_p")).select(
        "sequence_id", "n_tokens", F.aggregate("_p.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"))


def digests(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``ids_crc32`` instead of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
