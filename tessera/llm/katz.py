"""Language-model scoring: Katz backoff over word pairs.

P(b | a) = r*(c(ab)) / c(a) where the training documents hold the pair, else beta(a) / c(a) * P(b), and
P(b) = r*(c(b)) / N; unseen words share one outcome with the mass left. r* is the Good-Turing
count (r + 1) N(r + 1) / N(r) up to ``CUT`` and r - 1/2 above it (also where the Good-Turing count does not lie
between 0 and r). beta(a) makes every context's probabilities sum to exactly one:
beta(a) = (c(a) - sum of r* of its pairs) / (1 - sum of P(b) of its pairs). A context that
training does not know backs off with weight one. A document starts in a start context and closes
with an end token.

The counts live in tables partitioned by word, one task's group each, whose size is set by
``ENTRIES``. Tokens of a batch of documents travel as packed columns, never as one row a token:

1. every (word, context, document) with its count goes to the word's partition: word and pair counts,
   and what each document gains there (log-probabilities whose Good-Turing counts are not known
   yet are kept as numbers of tokens by count);
2. seen pairs and unseen tokens go to the context's partition: backoff weights, and what unseen
   tokens add to their documents;
3. the sums of a batch meet: one row per document.

Frequent words and pairs (at least 1/``HOT`` of a sample of distinct texts, or of the corpus by the
copies of one text that is at least 1/``SAMPLE`` of the rows, so a bounded list) are counted
exactly in a pass of their own and broadcast: the pairs are scored where the text is, and a
frequent word's other pairs are spread over all partitions by pair. So no listed word or pair
gathers its occurrences in one task; one just below the lists' share does. Copies of a row take no
place from other texts in the sample. The lists change nothing in the result.

Words are compared by 64-bit hashes.

Edge cases: null and empty texts are an end token only; rows that repeat count each time; rows
without an id are training rows; without training rows every score is 0 (one outcome).
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import fold, mix, record_batch, stage, texts_of, word_hashes

#: Counts up to here are discounted by Good-Turing.
CUT = 5
#: Frequent: at least this share of the sampled tokens; so many words and pairs at most.
HOT = 65_536
#: Distinct texts that the lists of frequent words and pairs are drawn from: so many of least hash, and
#: all that are at least this share of the rows.
SAMPLE = 4_000
#: Entries (word, context, document) of one partition.
ENTRIES = 3_500_000
#: Bytes of text that a worker turns into arrays at once (a longer text is one slice).
TEXT = 6_000_000

START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_P1, _P2 = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)
_ROW = T.StructType([T.StructField("target", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("payload", T.BinaryType())])


# ---- packed columns ----------------------------------------------------------------------

def pack(*columns: np.ndarray) -> bytes:
    """Arrays one after another; whole numbers in the least width that holds them."""
    out = [struct.pack("<I", len(columns))]
    for c in columns:
        if c.dtype.kind in "iu" and c.dtype != np.uint64:
            c = c.astype(np.min_scalar_type(int(c.max())) if len(c) else np.uint8)
        elif c.dtype.kind == "b":
            c = c.astype(np.uint8)
        out += [struct.pack("<2sI", c.dtype.str[1:].encode(), len(c)), c.tobytes()]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 4
    for _ in range(struct.unpack_from("<I", data)[0]):
        kind, n = struct.unpack_from("<2sI", data, at)
        dtype = np.dtype("<" + kind.decode())
        out.append(np.frombuffer(data, dtype, n, at + 6))
        at += 6 + n * dtype.itemsize
    return out


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _P1 + mix(b ^ _P2))


def find(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each x in the sorted values, -1 if it isn't there."""
    if not len(sorted_values):
        return np.full(len(x), -1)
    i = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return np.where(sorted_values[i] == x, i, -1)


def few(batch: pa.RecordBatch):
    """The batch in slices of about ``TEXT`` bytes of text: a worker's arrays stay small."""
    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.cumsum(size) // TEXT
    cuts = np.r_[0, np.flatnonzero(piece[1:] != piece[:-1]) + 1, batch.num_rows] if batch.num_rows else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(int(a), int(b - a))


def part(key: np.ndarray, parts: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, words, document) of all tokens of the texts, end tokens included."""
    docs = [word_hashes(t.lower().split()) for t in texts]
    a = np.concatenate([x for d in docs for x in (np.array([START]), d)]) if docs else np.empty(0, np.uint64)
    b = np.concatenate([x for d in docs for x in (d, np.array([END]))]) if docs else np.empty(0, np.uint64)
    return a, b, np.repeat(np.arange(len(docs)), [len(d) + 1 for d in docs])


# ---- the model's numbers -----------------------------------------------------------------

class Counts:
    """Counts of the frequent words and pairs, known everywhere."""

    def __init__(self, words: np.ndarray, pairs: list[tuple[int, int]]):
        self.words = np.unique(words.astype(np.uint64))
        a, b = (np.array([p[i] for p in pairs], np.uint64) for i in (0, 1))
        h, first = np.unique(pair_hash(a, b), return_index=True)
        self.pairs, self.pair_a, self.pair_b = h, a[first], b[first]
        self.word_n, self.pair_n, self.docs = np.zeros(len(self.words), np.int64), np.zeros(len(h), np.int64), 0


class Discounts:
    """Good-Turing counts from the counts of counts; ``hist`` holds N(1) to N(CUT + 1)."""

    def __init__(self, hist: np.ndarray):
        r = np.arange(1, CUT + 1)
        self.small = r - 0.5
        for i in range(CUT):
            g = (i + 2) * hist[i + 1] / hist[i] if hist[i] else 0.0
            if 0 < g < i + 1:
                self.small[i] = g

    def __call__(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > CUT, c - 0.5, self.small[np.clip(c, 1, CUT) - 1]) * (c > 0)


def hist_of(c: np.ndarray) -> np.ndarray:
    return np.bincount(c[(c > 0) & (c <= CUT + 1)], minlength=CUT + 2)[1:CUT + 2]


class Model:
    """Totals and discounts, from the partitions' sums and the frequent words and pairs."""

    def __init__(self, sums: np.ndarray, hot: Counts):
        k = CUT + 1
        words, pairs = hist_of(hot.word_n), hist_of(hot.pair_n)
        self.n, self.v = int(sums[0] + hot.word_n.sum()), int(sums[1] + (hot.word_n > 0).sum())
        n1 = sums[2:2 + k] + words
        self.word, self.pair = Discounts(n1), Discounts(sums[2 + k:2 + 2 * k] + pairs)
        big = self.v - int(n1[:CUT].sum())
        r = np.arange(1, CUT + 1)
        self.unseen = ((n1[:CUT] * (r - self.word.small)).sum() + 0.5 * big) / self.n if self.n else 1.0

    def p(self, c: np.ndarray) -> np.ndarray:
        """Probabilities of words with these training counts."""
        return np.where(c > 0, self.word(c) / max(1, self.n), self.unseen)


# ---- frequent words and pairs ------------------------------------------------------------

def frequent(train: DataFrame) -> Counts:
    """The lists from two bounded samples of distinct texts, their counts from all training documents."""
    hashed = train.select("text", F.xxhash64("text").alias("h"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    same = stage(hashed.groupBy("h").agg(F.count("*").alias("rows"), F.max("size").alias("size")), "texts")
    rows, size = same.agg(F.sum("rows"), F.sum(F.col("rows") * F.col("size"))).first()
    some = same.orderBy("h").limit(SAMPLE).select("h", F.lit(0).cast("long").alias("rows"))
    much = same.where(F.col("rows") * SAMPLE >= (rows or 0)).select("h", "rows")  # at most ``SAMPLE`` by arithmetic
    chosen = some.union(much.where("rows > 1")).groupBy("h").agg(F.min("rows").alias("low"), F.max("rows").alias("rows"))
    # one row for each text; low = 0: of the first sample, rows > 0: of the second, with its number of rows
    sample = hashed.join(F.broadcast(chosen.withColumnRenamed("h", "c")), F.col("h") == F.col("c")).groupBy("h", "low", "rows").agg(F.first("text").alias("text"))

    def count(batches):
        def found(texts, copies):
            a, b, _ = tokens(texts)
            words, n = np.unique(b, return_counts=True)
            _, first, m = np.unique(pair_hash(a, b), return_index=True, return_counts=True)
            often = m * max(1, copies) > 1
            n, m = np.r_[n, m[often]], np.zeros(len(words) + often.sum(), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.r_[np.zeros(len(words), np.uint64), a[first][often]].view(np.int64)), pa.array(np.r_[words, b[first][often]].view(np.int64)),
                                               pa.array(np.r_[np.zeros(len(words), bool), np.ones(often.sum(), bool)]), pa.array(m if copies else n), pa.array(n * copies if copies else m)],
                                              ["a", "b", "pair", "n", "copied"])

        for batch in (x for y in batches for x in few(y)):
            low, rows = batch.column("low").to_pylist(), batch.column("rows").to_pylist()
            texts = texts_of(batch, "text")
            if 0 in low:
                yield found([t for t, x in zip(texts, low) if x == 0], 0)
            for t, r in zip(texts, rows):
                if r:
                    yield found([t], r)

    counts = stage(sample.mapInArrow(count, "a long, b long, pair boolean, n long, copied long").groupBy("a", "b", "pair").agg(F.sum("n").alias("n"), F.sum("copied").alias("copied")), "frequent")
    total = counts.where("not pair").agg(F.sum("n")).first()[0] or 0
    width = same.orderBy("h").limit(SAMPLE).agg(F.sum("size")).first()[0] or 0
    everywhere = (size or 0) / max(1, width) * total  # tokens of the corpus, by its bytes
    often = (F.col("n") >= max(CUT + 1, total / HOT)) | (F.col("copied") >= max(CUT + 1, everywhere / HOT))
    rows = counts.where(often).select("a", "b", "pair").collect()
    as_u = lambda x: x & (2 ** 64 - 1)
    pairs = [(as_u(r.a), as_u(r.b)) for r in rows if r.pair]
    words = {as_u(r.b) for r in rows if not r.pair} | {b for _, b in pairs} | {a for a, _ in pairs} - {int(START)} | {int(END)}
    hot = Counts(np.array(sorted(words), np.uint64), pairs)

    def exact(batches):
        w, p, docs = np.zeros(len(hot.words), np.int64), np.zeros(len(hot.pairs), np.int64), 0
        for batch in (x for y in batches for x in few(y)):
            a, b, _ = tokens(texts_of(batch, "text"))
            i = find(hot.words, b)
            w += np.bincount(i[i >= 0], minlength=len(w))
            j = find(hot.pairs, pair_hash(a, b)[i >= 0])
            p += np.bincount(j[j >= 0], minlength=len(p))
            docs += batch.num_rows
        both = np.r_[docs, w, p]
        at = np.flatnonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(both[at])], ["i", "n"])

    sums = np.zeros(1 + len(hot.words) + len(hot.pairs), np.int64)
    for r in train.select("text").mapInArrow(exact, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        sums[r.i] = r.n
    hot.docs, hot.word_n, hot.pair_n = int(sums[0]), sums[1:1 + len(hot.words)], sums[1 + len(hot.words):]
    return hot


# ---- what a document gains ---------------------------------------------------------------

class Gains:
    """For ``size`` documents: logs known by now, and tokens counted by the counts they wait for."""

    def __init__(self, size: int):
        self.base, self.logs = np.zeros(size), np.zeros(size)
        self.known = np.zeros(size, np.int64)
        self.seen = np.zeros((CUT, size), np.int64)      # seen pairs with a count up to CUT
        self.unseen = np.zeros((CUT + 2, size), np.int64)  # tokens of unseen pairs, by the word's count: 0, up to CUT, above

    def words(self, at, n, c, context):
        """Tokens of words with training counts ``c``; ``context``: they precede another token."""
        size = len(self.base)
        self.base += np.bincount(at, n * np.log10(c + 0.5), size)
        self.known += np.bincount(at, n * (c > 0), size).astype(np.int64)
        use = context & (c > 0)
        self.logs -= np.bincount(at[use], n[use] * np.log10(c[use]), size)

    def pairs(self, at, n, c_pair, c_word):
        size = len(self.base)
        big = c_pair > CUT
        self.logs += np.bincount(at[big], n[big] * np.log10(c_pair[big] - 0.5), size)
        for r in range(CUT):
            m = c_pair == r + 1
            self.seen[r] += np.bincount(at[m], n[m], size).astype(np.int64)
        none = c_pair == 0
        for r in range(CUT + 2):
            m = none & ((c_word == r) if r <= CUT else (c_word > CUT))
            self.unseen[r] += np.bincount(at[m], n[m], size).astype(np.int64)
        m = none & (c_word > CUT)
        self.logs += np.bincount(at[m], n[m] * np.log10(c_word[m] - 0.5), size)

    def packed(self, a: int, b: int) -> bytes:
        return pack(self.base[a:b], self.logs[a:b], self.known[a:b], self.seen[:, a:b].reshape(-1), self.unseen[:, a:b].reshape(-1))

    def add(self, data: list[np.ndarray], at: slice) -> None:
        size = at.stop - at.start
        self.base[at] += data[0]
        self.logs[at] += data[1]
        self.known[at] += data[2].astype(np.int64)
        self.seen[:, at] += data[3].reshape(CUT, size).astype(np.int64)
        self.unseen[:, at] += data[4].reshape(CUT + 2, size).astype(np.int64)


def _coded(h: np.ndarray, hot: Counts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as places in the frequent list where they are there, else as hashes."""
    i = find(hot.words, h)
    return np.packbits(i >= 0), i[i >= 0], h[i < 0]


def _decoded(flags, places, hashes, n: int, hot: Counts) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places or -1)."""
    is_hot = np.unpackbits(flags, count=n).astype(bool)
    i = np.full(n, -1)
    i[is_hot] = places
    h = np.empty(n, np.uint64)
    h[is_hot] = hot.words[places]
    h[~is_hot] = hashes
    return h, i


# ---- step 1: documents to words ----------------------------------------------------------

def _spread(hot: Counts, parts: int):
    def run(batches):
        task = TaskContext.get().partitionId()
        for k, batch in enumerate(x for y in batches for x in few(y)):
            size, name = batch.num_rows, task << 32 | k
            held = np.array(batch.column("held_out").to_pylist(), bool)
            a, b, doc = tokens(texts_of(batch, "text"))
            gains = Gains(size)
            i = find(hot.words, b)
            at = np.flatnonzero(i >= 0)
            gains.words(doc[at], np.ones(len(at)), hot.word_n[i[at]], b[at] != END)
            if hot.docs:
                gains.logs -= np.log10(hot.docs)  # the start context
            h = pair_hash(a, b)
            j = find(hot.pairs, h)
            at = np.flatnonzero(j >= 0)
            gains.pairs(doc[at], np.ones(len(at)), hot.pair_n[j[at]], hot.word_n[i[at]])
            ids = batch.column("doc_id")
            head = pack(ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64), ids.is_null().to_numpy(zero_copy_only=False), held, np.bincount(doc, minlength=size))
            rows = [(name % parts, "D", name, struct.pack("<I", len(head)) + head + gains.packed(0, size))]
            left = np.flatnonzero(j < 0)
            a, b, doc, i, h = a[left], b[left], doc[left], i[left], h[left]
            del at, j, left
            # a rare word's pairs stay together, a frequent word's pairs go their own ways
            place = part(np.where(i >= 0, h, b), parts) * 2 + (i >= 0)
            order = _by(place, 2 * parts, b, h)
            a, b, doc, i, place = a[order], b[order], doc[order], i[order], place[order]
            if len(a):
                new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (doc[1:] != doc[:-1])]
                at = np.flatnonzero(new)
                n = np.diff(np.r_[at, len(a)])
                a, b, doc, i, place = a[at], b[at], doc[at], i[at], place[at]
                ends = np.searchsorted(place, np.arange(2 * parts + 1))
                for t in range(parts):
                    lo, mid, hi = ends[2 * t], ends[2 * t + 1], ends[2 * t + 2]
                    if lo < hi:
                        rare = b[lo:mid]
                        runs = np.flatnonzero(np.r_[True, rare[1:] != rare[:-1]]) if len(rare) else np.empty(0, np.int64)
                        rows.append((t, "E", name, pack(held, rare[runs], np.diff(np.r_[runs, len(rare)]), i[mid:hi], *_coded(a[lo:hi], hot), doc[lo:hi], n[lo:hi])))
            yield _batch(rows)
    return run


def _by(place: np.ndarray, places: int, b: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Order by place, word, pair; equal pairs keep the order of their documents. One key holds the
    place and the first bits of both hashes: where those collide, a pair may come in two pieces."""
    rest = 64 - (places - 1).bit_length()
    low = rest * 2 // 5
    key = place.astype(np.uint64) << np.uint64(rest) | (b >> np.uint64(64 - rest + low)) << np.uint64(low) | h >> np.uint64(64 - low)
    return np.argsort(key, kind="stable")


def _two(payload: bytes) -> tuple[bytes, bytes]:
    n = struct.unpack_from("<I", payload)[0]
    return payload[4:4 + n], payload[4 + n:]


def _batch(rows: list[tuple[int, str, int, bytes]]) -> pa.RecordBatch:
    return record_batch({f.name: [r[c] for r in rows] for c, f in enumerate(_ROW.fields)}, _ROW)


def _table(rows: list[tuple[int, str, int, bytes]]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows)])


# ---- step 2: words' partitions -----------------------------------------------------------

def _count(hot: Counts, parts: int):
    def run(table: pa.Table) -> pa.Table:
        kinds, names, data = (table.column(c).to_pylist() for c in ("kind", "batch", "payload"))
        rows = [(names[r] % parts, "D", names[r], data[r]) for r, kind in enumerate(kinds) if kind == "D"]
        entries = [(names[r], unpack(data[r])) for r, kind in enumerate(kinds) if kind == "E"]
        del data, table
        cols: dict[str, list] = {c: [] for c in ("a", "ai", "b", "bi", "at", "n", "train")}
        offsets, size = [], 0
        for _, (held, rare, runs, places, flags, hot_a, cold_a, doc, n) in entries:
            a, ai = _decoded(flags, hot_a, cold_a, len(n), hot)
            cols["a"].append(a)
            cols["ai"].append(ai.astype(np.int32))
            cols["b"].append(np.r_[np.repeat(rare, runs), hot.words[places]])
            cols["bi"].append(np.r_[np.full(int(runs.sum()), -1, np.int32), places.astype(np.int32)])
            cols["at"].append((doc.astype(np.int64) + size).astype(np.int32))
            cols["n"].append(n.astype(np.int32))
            cols["train"].append(held[doc] == 0)
            offsets.append(size)
            size += len(held)
        if not entries:
            return _table(rows)
        entries = [(name, len(held)) for name, (held, *_) in entries]
        a, ai, b, bi, at, n, train = (np.concatenate(cols.pop(c)) for c in ("a", "ai", "b", "bi", "at", "n", "train"))
        weight = n * train
        del train
        c_word = np.zeros(len(a), np.int64)
        rare = bi < 0
        words, back = np.unique(b[rare], return_inverse=True)
        counts = np.bincount(back, weight[rare], len(words)).astype(np.int64)
        c_word[rare] = counts[back]
        c_word[~rare] = hot.word_n[bi[~rare]]
        gains = Gains(size)
        gains.words(at[rare], n[rare], c_word[rare], b[rare] != END)
        del back, words, rare
        h, c_pair, seen, own, pair_hist = pair_hash(a, b), np.zeros(len(a), np.int64), [], [], np.zeros(CUT + 1, np.int64)
        for share in range(4):  # a share of the pairs at a time keeps the sorting's copies small
            some = np.flatnonzero(h & np.uint64(3) == share)
            _, first, back = np.unique(h[some], return_index=True, return_inverse=True)
            pairs = np.bincount(back, weight[some], len(first)).astype(np.int64)
            c_pair[some] = pairs[back]
            pair_hist += hist_of(pairs)
            seen.append(some[first[pairs > 0]])
            own.append(pairs[pairs > 0])
            del some, first, back, pairs
        del h, weight
        gains.pairs(at, n, c_pair, c_word)
        for (name, docs), off in zip(entries, offsets):
            rows.append((name % parts, "S", name, gains.packed(off, off + docs)))
        sums = np.r_[counts.sum(), (counts > 0).sum(), hist_of(counts), pair_hist]
        rows += [(t, "H", 0, pack(sums)) for t in range(parts)]

        seen, own = np.concatenate(seen), np.concatenate(own)
        rows += _contexts(a[seen], ai[seen], own, c_word[seen], parts, len(hot.words))
        miss = np.flatnonzero(c_pair == 0)
        to = _home(a[miss], ai[miss], parts)
        order = np.argsort(to, kind="stable")
        miss, to = miss[order], to[order]
        owner = np.searchsorted(np.array(offsets), at[miss], "right") - 1
        batch_names = np.array([name for name, _ in entries], np.int64)
        ends = np.searchsorted(to, np.arange(parts + 1))
        for t in range(parts):
            m, o = miss[ends[t]:ends[t + 1]], owner[ends[t]:ends[t + 1]]
            if len(m):
                rows.append((t, "U", 0, pack(batch_names.view(np.uint64), o, *_coded(a[m], hot), at[m] - np.array(offsets)[o], n[m])))
        return _table(rows)
    return run


def _home(a: np.ndarray, ai: np.ndarray, parts: int) -> np.ndarray:
    """The partition of a context."""
    return np.where(ai >= 0, ai % parts, part(a, parts))


_WIDE = 2 * CUT + 3


def _contexts(a, ai, c, c_word, parts: int, hot_words: int) -> list[tuple]:
    """Seen pairs for their contexts: rare contexts pair by pair, frequent ones summed by counts."""
    rows = []
    rare = np.flatnonzero(ai < 0)
    to = part(a[rare], parts)
    order = np.argsort(to, kind="stable")
    rare, to = rare[order], to[order]
    ends = np.searchsorted(to, np.arange(parts + 1))
    for t in range(parts):
        m = rare[ends[t]:ends[t + 1]]
        if len(m):
            rows.append((t, "A", 0, pack(a[m], c[m], c_word[m])))
    often = np.flatnonzero(ai >= 0)
    if len(often):
        used, at = np.unique(ai[often], return_inverse=True)
        sums = _summed(at, c[often], c_word[often], len(used))
        for t in range(parts):
            m = np.flatnonzero(used % parts == t)
            if len(m):
                rows.append((t, "B", 0, pack(used[m], sums[m].reshape(-1))))
    return rows


def _summed(at, c, c_word, size: int) -> np.ndarray:
    """For each context: pairs by count, then c - 1/2 of larger ones; the same of the words; tokens."""
    out = np.zeros((size, _WIDE))
    for col, x in ((0, c), (CUT + 1, c_word)):
        for r in range(CUT):
            out[:, col + r] = np.bincount(at, x == r + 1, size)
        out[:, col + CUT] = np.bincount(at, np.where(x > CUT, x - 0.5, 0), size)
    out[:, -1] = np.bincount(at, c, size)
    return out


# ---- step 3: contexts' partitions --------------------------------------------------------

def _back_off(hot: Counts, parts: int):
    def run(table: pa.Table) -> pa.Table:
        target = table.column("target")[0].as_py()
        kinds, names, data = (table.column(c).to_pylist() for c in ("kind", "batch", "payload"))
        rows = [(target, kind, name, x) for kind, name, x in zip(kinds, names, data) if kind in "DS"]
        sums = sum((unpack(x)[0].astype(np.int64) for kind, x in zip(kinds, data) if kind == "H"), np.zeros(2 + 2 * (CUT + 1), np.int64))
        rows.append((target, "H", 0, pack(sums)))
        model = Model(sums, hot)
        rare = [unpack(x) for kind, x in zip(kinds, data) if kind == "A"]
        logs_of_rare = np.empty(0)
        contexts = np.empty(0, np.uint64)
        if rare:
            a, c, cw = (np.concatenate([x[i] for x in rare]) for i in range(3))
            c, cw = c.astype(np.int64), cw.astype(np.int64)
            contexts, at = np.unique(a, return_inverse=True)
            free = np.bincount(at, c - model.pair(c)) / (1 - np.bincount(at, model.p(cw)))
            logs_of_rare = np.log10(free)
        often = np.zeros((len(hot.words), _WIDE))
        for kind, x in zip(kinds, data):
            if kind == "B":
                used, got = unpack(x)
                often[used.astype(np.int64)] += got.reshape(-1, _WIDE)
        known = np.flatnonzero(hot.pair_n > 0)  # the frequent pairs are no partition's rows
        ai = find(hot.words, hot.pair_a[known])
        start = hot.pair_a[known] == START
        own = (ai >= 0) & (ai % parts == target)
        often += _summed(ai[own], hot.pair_n[known][own], hot.word_n[find(hot.words, hot.pair_b[known][own])], len(hot.words))
        if part(np.array([START]), parts)[0] == target and start.any():
            # the start context is rare in this sense: it isn't a word
            c, cw = hot.pair_n[known][start], hot.word_n[find(hot.words, hot.pair_b[known][start])]
            i = find(contexts, np.array([START]))[0]
            if i < 0:
                contexts, logs_of_rare = np.r_[contexts, START], np.r_[logs_of_rare, 0.0]
                order = np.argsort(contexts)
                contexts, logs_of_rare = contexts[order], logs_of_rare[order]
                i = find(contexts, np.array([START]))[0]
                more = (np.empty(0, np.int64), np.empty(0, np.int64))
            else:
                more = tuple(np.concatenate([x[k] for x in rare])[np.concatenate([x[0] for x in rare]) == START].astype(np.int64) for k in (1, 2))
            c, cw = np.r_[c, more[0]], np.r_[cw, more[1]]
            logs_of_rare[i] = np.log10((c - model.pair(c)).sum() / (1 - model.p(cw).sum()))
        small, word_small = model.pair.small, model.word.small / max(1, model.n)
        total = often[:, -1]
        with np.errstate(divide="ignore", invalid="ignore"):
            used = often[:, :CUT] @ small + often[:, CUT]
            covered = often[:, CUT + 1:2 * CUT + 1] @ word_small + often[:, 2 * CUT + 1] / max(1, model.n)
            logs_of_often = np.where(total > 0, np.log10((total - used) / (1 - covered)), 0.0)
        for kind, x in zip(kinds, data):
            if kind != "U":
                continue
            batches, owner, flags, hot_a, cold_a, doc, n = unpack(x)
            a, ai = _decoded(flags, hot_a, cold_a, len(n), hot)
            i = find(contexts, a)
            log = np.where(ai >= 0, logs_of_often[np.maximum(ai, 0)] if len(logs_of_often) else 0.0, np.where(i >= 0, logs_of_rare[np.maximum(i, 0)] if len(logs_of_rare) else 0.0, 0.0))
            owner, doc = owner.astype(np.int64), doc.astype(np.int64)
            key, at = np.unique(owner << 32 | doc, return_inverse=True)
            value = np.bincount(at, n * log)
            cuts = np.searchsorted(key >> 32, np.arange(len(batches) + 1))
            for o in range(len(batches)):
                lo, hi = cuts[o], cuts[o + 1]
                if lo < hi:
                    name = int(batches.view(np.int64)[o])
                    rows.append((name % parts, "V", name, pack(key[lo:hi] & 0xFFFFFFFF, value[lo:hi])))
        return _table(rows)
    return run


# ---- step 4: documents -------------------------------------------------------------------

_OUT = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("held_out", T.BooleanType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()),
                                                      ("train_tokens", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType()))])


def _finish(hot: Counts):
    def run(table: pa.Table) -> pa.Table:
        kinds, names, data = (table.column(c).to_pylist() for c in ("kind", "batch", "payload"))
        sums = sum((unpack(x)[0].astype(np.int64) for kind, x in zip(kinds, data) if kind == "H"), np.zeros(2 + 2 * (CUT + 1), np.int64))
        model = Model(sums, hot)
        by: dict[int, list] = {}
        for kind, name, x in zip(kinds, names, data):
            if kind != "H":
                by.setdefault(name, []).append((kind, x))
        out: list[pa.RecordBatch] = []
        for got in by.values():
            (head, first), = [_two(x) for kind, x in got if kind == "D"]
            ids, null, held, n_tokens = unpack(head)
            size = len(held)
            gains = Gains(size)
            gains.add(unpack(first), slice(0, size))
            for kind, x in got:
                if kind == "S":
                    gains.add(unpack(x), slice(0, size))
                elif kind == "V":
                    at, value = unpack(x)
                    gains.logs[at.astype(np.int64)] += value
            unseen_known = gains.unseen[1:].sum(0)
            score = gains.logs + np.log10(model.pair.small) @ gains.seen + np.log10(model.word.small) @ gains.unseen[1:CUT + 1] - unseen_known * np.log10(max(1, model.n)) + gains.unseen[0] * np.log10(model.unseen)
            base = gains.base - n_tokens * np.log10(model.n + 0.5 * (model.v + 1))
            ids = [None if z else int(i) for i, z in zip(ids.view(np.int64), null)]
            out.append(record_batch({"doc_id": ids, "held_out": held.astype(bool).tolist(), "n_tokens": n_tokens.astype(np.int64).tolist(), "n_known": gains.known.tolist(),
                                     "train_tokens": [model.n] * size, "base_score": base.tolist(), "score": score.tolist()}, _OUT))
        return pa.Table.from_batches(out, out[0].schema if out else record_batch({f.name: [] for f in _OUT.fields}, _OUT).schema)
    return run


def score(docs: DataFrame, entries: int = ENTRIES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of
    ``docs`` (doc_id, text), learning from the rows outside fold 1."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"))
    hot = frequent(rows.where("not held_out"))
    words = rows.select((F.size(F.split(F.coalesce("text", F.lit("")), r"[ \t\n\x0B\f\r]+")) + 1).alias("n")).agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-int(words) // entries))
    step = rows.mapInArrow(_spread(hot, parts), _ROW)
    step = step.groupBy("target").applyInArrow(_count(hot, parts), _ROW)
    step = step.groupBy("target").applyInArrow(_back_off(hot, parts), _ROW)
    return step.groupBy("target").applyInArrow(_finish(hot), _OUT)
