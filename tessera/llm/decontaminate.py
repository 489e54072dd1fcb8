"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks.

Every document is read in windows of each benchmark item's own size. A window's 128-bit SimHash is
looked up in the items of that size: the fingerprint is split into ``BLOCKS`` blocks, and the index holds
each item under all block values within two errors, so every fingerprint within ``RADIUS`` is
found for certain (pigeonhole). Candidates are verified by the exact weighted similarity of their
five-word shingles: each shingle weighs as often as it occurs, and the sum of the lesser weights
must reach 0.75 of the sum of the greater ones. A window at that similarity differs in 22 of 128
bits on average (standard deviation 4.3).

Windows with too few shingles of that size's items to reach 0.75 are not fingerprinted: their
similarity cannot reach it, so nothing is lost, and a bitmap of fixed size finds most of them. Items are read in blocks of
``ITEMS``; each block is one pass over the documents in the same job, and documents are never
moved. The blocks' indexes pass through the driver and live in every task, so the benchmark's
size is bounded by their memory.

Words are lower-cased runs of letters, digits and non-ASCII characters, as a leaked passage may
change case and punctuation.

Edge cases: null and empty texts and items without words match nothing; items under five words are
one shingle; a document shorter than an item is one window; repeated rows give repeated results;
equal items are all reported; rows without an item id are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mix, shingle_hashes, texts_of, with_columns, word_hashes
from tessera.llm.notices import words_of

WORDS = 5
LEAST = 0.75
BITS, BLOCKS, ERRORS = 128, 13, 2
#: Guaranteed: with more differing bits every block could have more than ``ERRORS``.
RADIUS = BLOCKS * (ERRORS + 1) - 1
#: Items of one pass.
ITEMS = 2000
_MAP_BITS = 20

_EDGES = [BITS * i // BLOCKS for i in range(BLOCKS + 1)]


def bits_of(shingles: np.ndarray) -> np.ndarray:
    """(n, 128) zeros and ones."""
    two = np.stack([mix(shingles), mix(shingles ^ np.uint64(0xD1B54A32D192ED03))], 1)
    return np.unpackbits(two.view(np.uint8), axis=1)


def block_values(fingerprints: np.ndarray) -> np.ndarray:
    """(n, BLOCKS) block values of (n, 128) fingerprints."""
    return np.stack([fingerprints[:, a:b].astype(np.int64) @ (1 << np.arange(b - a)) for a, b in zip(_EDGES, _EDGES[1:])], 1)


def _near_values(width: int) -> np.ndarray:
    """Masks of at most two errors in a block."""
    one = [1 << i for i in range(width)]
    return np.array([0, *one, *(x | y for i, x in enumerate(one) for y in one[:i])], np.int64)


def weighted_similarity(a: Counter, b: Counter) -> float:
    low = sum((a & b).values())
    return low / (a.total() + b.total() - low) if low else 0.0


class ItemIndex:
    """Fingerprints, blocks and shingle weights of one block of items."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.ids, self.weights, prints = [], [], []
        self.by_size: dict[tuple[int, int], list[int]] = {}  # (shingle length, shingles) -> items
        for i, text in items:
            words = words_of(text)
            if i is None or not words:
                continue
            s = shingle_hashes(word_hashes(words), WORDS)
            self.by_size.setdefault((min(WORDS, len(words)), len(s)), []).append(len(self.ids))
            self.ids.append(i)
            self.weights.append(Counter(s.tolist()))
            prints.append(2 * bits_of(s).sum(0, dtype=np.int64) > len(s))
        self.prints = np.array(prints, np.uint8).reshape(len(prints), BITS)
        self.sizes = sorted(self.by_size)
        self.lengths = sorted({n for n, _ in self.sizes})
        # every shingle with the sizes of the items that hold it
        held = sorted({(h, k) for k, size in enumerate(self.sizes) for i in self.by_size[size] for h in self.weights[i]})
        self.known, first = np.unique(np.array([h for h, _ in held], np.uint64), return_index=True)
        self.first, self.size_of = np.r_[first, len(held)], np.array([k for _, k in held], np.int64)
        self.map = np.zeros(1 << _MAP_BITS, bool)
        self.map[self.known >> np.uint64(64 - _MAP_BITS)] = True
        self.blocks = {size: self._index(np.array(items)) for size, items in self.by_size.items()}

    def _index(self, items: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each block: where each value's items start, and the items by value."""
        values, out = block_values(self.prints[items]), []
        for k, (a, b) in enumerate(zip(_EDGES, _EDGES[1:])):
            near = _near_values(b - a)
            v = (values[:, k, None] ^ near[None]).reshape(-1)
            order = np.argsort(v, kind="stable")
            out.append((np.searchsorted(v[order], np.arange((1 << (b - a)) + 1)), items[order // len(near)]))
        return out

    def candidates(self, prints: np.ndarray, size: tuple[int, int]) -> list[tuple[int, int]]:
        """(window, item) of all fingerprints within the radius, among the items of that size."""
        values, found = block_values(prints), []
        for k, (starts, items) in enumerate(self.blocks[size]):
            lo = starts[values[:, k]]
            n = starts[values[:, k] + 1] - lo
            window = np.repeat(np.arange(len(n)), n)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            found.append(window * len(self.ids) + items[place])
        both = np.unique(np.concatenate(found))
        window, item = both // len(self.ids), both % len(self.ids)
        near = (prints[window] != self.prints[item]).sum(1) <= RADIUS
        return list(zip(window[near].tolist(), item[near].tolist()))

    def matches(self, text: bytes) -> list[tuple[int, float, int]]:
        """(item id, similarity, first word) of the best window of each item that matches."""
        words = word_hashes(words_of(text))
        best: dict[int, tuple[float, int]] = {}
        for length in self.lengths:
            if len(words) < length:
                continue
            s = shingle_hashes(words, length)
            at = np.flatnonzero(self.map[s >> np.uint64(64 - _MAP_BITS)])
            if not len(at):
                continue
            place = np.minimum(np.searchsorted(self.known, s[at]), len(self.known) - 1)
            real = self.known[place] == s[at]
            at, place = at[real], place[real]
            # the items' sizes that each of the document's shingles speaks for
            n = self.first[place + 1] - self.first[place]
            size_of = self.size_of[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[place], n)]
            at, sums = np.repeat(at, n), None
            for k, many in zip(*np.unique(size_of, return_counts=True)):
                size = self.sizes[k]
                m = min(size[1], len(s))
                # similarity = common / (m + size - common) >= LEAST
                need = LEAST * (m + size[1]) / (1 + LEAST) - 1e-9
                if size[0] != length or min(m, many) < need:
                    continue
                hits = np.zeros(len(s) + 1, np.int64)
                hits[at[size_of == k] + 1] = 1
                hits = np.cumsum(hits)
                start = np.flatnonzero(hits[m:] - hits[:-m] >= need)
                if not len(start):
                    continue
                if sums is None:
                    sums = np.r_[np.zeros((1, BITS), np.int32), np.cumsum(bits_of(s), axis=0, dtype=np.int32)]
                prints = (2 * (sums[start + m] - sums[start]) > m).astype(np.uint8)
                for w, i in self.candidates(prints, size):
                    first = int(start[w])
                    sim = weighted_similarity(self.weights[i], Counter(s[first:first + m].tolist()))
                    if sim >= LEAST and (i not in best or (-sim, first) < (-best[i][0], best[i][1])):
                        best[i] = (sim, first)
        return sorted((self.ids[i], sim, first) for i, (sim, first) in best.items())


def item_blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text", items: int = ITEMS) -> list[ItemIndex]:
    """One index for each block of about ``items`` items."""
    rows = benchmark.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("t"))
    n = max(1, -(-rows.count() // items))
    return [ItemIndex([(r.id, bytes(r.t or b"")) for r in rows.where(F.pmod(F.xxhash64("id"), F.lit(n)) == k).orderBy("id", "t").collect()]) for k in range(n)]


_FIELDS = "contaminated boolean, n_items long, items string, similarity double, matches string"


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", items: int = ITEMS) -> DataFrame:
    """``docs`` with contaminated, n_items, items (ids, comma-joined), similarity (the best, else 0)
    and matches (item:first word:similarity)."""
    out = docs.drop("_found").withColumn("_found", F.lit("").cast("string"))
    for index in item_blocks(benchmark, items=items, text="text"):
        def make(index=index):
            def run(batch: pa.RecordBatch) -> dict:
                found = [" ".join(f"{i}:{w}:{s!r}" for i, s, w in index.matches(t)) for t in texts_of(batch, text)]
                return {"_found": [" ".join(filter(None, x)) for x in zip(batch.column("_found").to_pylist(), found)]}
            return run
        out = with_columns(out, "_found string", make)

    def make_last():
        def run(batch: pa.RecordBatch) -> dict:
            rows = [sorted((int(i), int(w), float(s)) for i, w, s in (x.split(":") for x in f.split())) for f in batch.column("_found").to_pylist()]
            return {"contaminated": [bool(r) for r in rows], "n_items": [len({x[0] for x in r}) for r in rows], "items": [",".join(map(str, sorted({x[0] for x in r}))) for r in rows],
                    "similarity": [max((x[2] for x in r), default=0.0) for r in rows], "matches": [",".join(f"{i}:{w}:{s:.4f}" for i, w, s in r) for r in rows]}
        return run

    return with_columns(out, _FIELDS, make_last).drop("_found")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones, columns unchanged."""
    names = {f.split()[0] for f in _FIELDS.split(", ")}
    own = [c for c in docs.columns if c.lower() in names]
    held = docs.withColumnsRenamed({c: f"_own_{c}" for c in own})
    kept = find(held, benchmark, text).where("not contaminated").drop(*names)
    return kept.withColumnsRenamed({f"_own_{c}": c for c in own}).select(*docs.columns)
