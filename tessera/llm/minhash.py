"""Near-duplicate documents: multi-index Hamming join over b-bit MinHash signatures.

A signature has ``SYMBOLS`` minima cut to 16 bits. It is split into chunks of three symbols; a pair
that differs in at most ``RADIUS`` symbols differs in at most one symbol of some chunk (pigeonhole), so
the index enumerates the three ways to leave one symbol of each chunk out: such a pair shares a
key for certain. At a similarity of 0.75 a symbol differs with probability 1/4, and more than
``RADIUS`` of 24 differ with probability 2e-5. Pairs that share a key are screened by ``SCREEN`` minima
cut to 8 bits (at 0.75 more than ``FAR`` of them differ with probability 2e-5) and confirmed on the full
shingle sets.

No group is expanded into pairs. Equal sets are one class. The members of a key are cut into blocks of
about ``BLOCK``, and each pair of blocks is one unit of work, so no key is one task's group. A unit
screens its pairs and gives each member one row: the least id it is connected with. The components of
these rows are small clusters of texts that may be near duplicates; they are cut into units
again, now with their full shingle sets, and confirmed pairs are linked in the same way.

Classes of equal sets are numbered, and links are links of classes, so ids need not be unique.

Edge cases: null and empty texts and texts without words have no shingles and link with nothing;
fewer than five words are one shingle; very long texts are read whole, 512 shingles at a time;
repeated rows share a component; rows of one id with different texts are one document, so all that
they link with is one component; rows without an id link by their texts (their component is the least id
found, null if there is none); ``deduplicated`` leaves one row of each component, also where ids
repeat or are null (of rows equal in id and set any one), and keeps the other columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import by_ids, components, mix, record_batch, shingle_set, stage, texts_of, with_columns

SYMBOLS, CHUNK, BITS = 24, 3, 16
#: Symbols that may differ: one in each chunk, and one chunk more must stay within it.
RADIUS = 2 * (SYMBOLS // CHUNK) - 1
#: Minima of the screening signature, and how many may differ.
SCREEN, FAR = 96, 42
#: Members of a block, and the bytes and pairs of a task's units.
BLOCK, UNIT_BYTES, UNIT_PAIRS = 1024, 16_000_000, 2_000_000
#: Links need 100 * intersection >= LEAST * union.
LEAST = 75

_A = mix(np.arange(1, SCREEN + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix(np.arange(1001, SCREEN + 1001, dtype=np.uint64))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of the set under each of ``SCREEN`` hash functions, mixed again."""
    low = np.full(SCREEN, np.uint64(2 ** 64 - 1))
    for i in range(0, len(shingles), 512):
        low = np.minimum(low, (shingles[None, i:i + 512] * _A[:, None] + _B[:, None]).min(1))
    return mix(low ^ _B)


def signature(low: np.ndarray) -> np.ndarray:
    """The first ``SYMBOLS`` minima, each cut to 16 bits."""
    return (low[:SYMBOLS] >> np.uint64(64 - BITS)).astype(np.int64)


def screen(low: np.ndarray) -> np.ndarray:
    """All minima, each cut to 8 bits."""
    return (low & np.uint64(255)).astype(np.uint8)


def keys(sig: np.ndarray) -> np.ndarray:
    """Index keys: for each chunk and each symbol left out, the other two symbols."""
    s = sig.reshape(-1, CHUNK)
    out = np.stack([s[:, 1] << BITS | s[:, 2], s[:, 0] << BITS | s[:, 2], s[:, 0] << BITS | s[:, 1]], 1).reshape(-1)
    return out | np.arange(SYMBOLS, dtype=np.int64) << 2 * BITS


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, set fingerprint (f1, f2), screening signature, keys."""
    def make():
        def run(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in ("n_shingles", "f1", "f2", "sig", "keys")}
            for t in texts_of(batch, "_text"):
                s = shingle_set(t)
                f = xxhash.xxh3_128_digest(s.tobytes())
                low = minima(s)
                out["n_shingles"].append(len(s))
                out["f1"].append(int.from_bytes(f[:8], "little", signed=True))
                out["f2"].append(int.from_bytes(f[8:], "little", signed=True))
                out["sig"].append(screen(low).tobytes() if len(s) else None)
                out["keys"].append(keys(signature(low)).tolist() if len(s) else None)
            return out
        return run

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    return with_columns(rows, "n_shingles long, f1 long, f2 long, sig binary, keys array<long>", make).drop("_text")


# ---- units: pairs of blocks of a group ---------------------------------------------------

_EDGE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _units(members: DataFrame, group: str, weight: str) -> DataFrame:
    """Members (group, id, ...) of groups with several, once for each unit they belong to, with
    the unit's blocks and its ``home``: units are dealt to tasks of about ``UNIT_BYTES`` and ``UNIT_PAIRS``."""
    sizes = stage(members.groupBy(group).agg(F.count("*").alias("_n"), F.sum(weight).alias("_w")).where("_n > 1")
                  .select(group, F.ceil(F.col("_n") / BLOCK).cast("int").alias("blocks"), "_n", "_w"), "group_sizes")
    load, pairs = sizes.agg(F.sum(F.col("_w") * F.col("blocks")), F.sum(F.col("_n").cast("double") * F.col("_n") / 2)).first()
    homes = max(1, int((load or 0) / UNIT_BYTES), int((pairs or 0) / UNIT_PAIRS))
    return (members.join(sizes.drop("_n", "_w"), group).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("other", "blocks")
            .withColumn("home", F.pmod(F.xxhash64(group, "lo", "hi"), F.lit(homes))))


def _pairs(unit: np.ndarray, block: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Places (i, j) of all pairs to compare; rows of a unit stand together. Small units together,
    large ones a few rows at a time."""
    n = len(unit)
    ends = np.flatnonzero(np.r_[unit[1:] != unit[:-1], True]) + 1
    starts = np.r_[0, ends[:-1]]
    small = np.repeat(ends - starts <= 16, ends - starts)
    for step in range(1, 16):
        i = np.flatnonzero(small[:-step] & (unit[step:] == unit[:-step])) if n > step else np.empty(0, int)
        if not len(i):
            break
        yield i, i + step
    for a, b in zip(starts, ends):
        if b - a > 16:
            one, two = a + np.flatnonzero(block[a:b] == lo[a]), a + np.flatnonzero(block[a:b] == hi[a])
            for k in range(0, len(one), 64):
                i, j = (x.reshape(-1) for x in np.meshgrid(one[k:k + 64], two, indexing="ij"))
                keep = i != j if lo[a] != hi[a] else i < j
                yield i[keep], j[keep]


def _allowed(i: np.ndarray, j: np.ndarray, n: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs whose sizes and screening signatures allow the similarity, and their distances."""
    fit = 100 * np.minimum(n[i], n[j]) >= LEAST * np.maximum(n[i], n[j])
    i, j = i[fit], j[fit]
    far = np.concatenate([(sig[i[k:k + 65536]] != sig[j[k:k + 65536]]).sum(1) for k in range(0, len(i), 65536)] or [np.empty(0, int)])
    near = far <= FAR
    return i[near], j[near], far[near]


class _Forest:
    """Least members of connected places."""

    def __init__(self, ids: np.ndarray):
        _, self.at = np.unique(ids, return_inverse=True)  # one id may stand in several units
        self.ids, self.up = np.unique(ids), list(range(int(self.at.max()) + 1))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, i: int, j: int) -> None:
        a, b = self.find(self.at[i]), self.find(self.at[j])
        self.up[max(a, b)] = min(a, b)

    def edges(self) -> pa.Table:
        root = np.array([self.find(x) for x in range(len(self.up))])
        some = np.flatnonzero(root != np.arange(len(root)))
        return pa.Table.from_batches([record_batch({"a": self.ids[root[some]].tolist(), "b": self.ids[some].tolist()}, _EDGE)])


def _read(table: pa.Table, group: str):
    """(ids, sizes, signatures, unit numbers, blocks, lo, hi) with the rows of a unit together."""
    cols = [table.column(c).to_numpy() for c in (group, "lo", "hi", "block", "id", "n")]
    order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
    key, lo, hi, block, ids, n = (c[order] for c in cols)
    unit = np.cumsum(np.r_[False, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(ids), SCREEN)[order]
    return order, ids, n, sig, unit, block, lo, hi


def _screened(table: pa.Table) -> pa.Table:
    """Connects the members of each unit whose signatures are near."""
    _, ids, n, sig, unit, block, lo, hi = _read(table, "key")
    forest = _Forest(ids)
    for i, j in _pairs(unit, block, lo, hi):
        i, j, _ = _allowed(i, j, n, sig)
        for x, y in zip(i.tolist(), j.tolist()):
            forest.join(x, y)
    return forest.edges()


def _linked(table: pa.Table) -> pa.Table:
    """Connects the members of each unit whose full sets reach the similarity. Pairs that are
    connected already need no look; near ones come first."""
    order, ids, n, sig, unit, block, lo, hi = _read(table, "cluster")
    sets = table.column("shingles")
    sets = [np.frombuffer(sets[int(k)].as_py(), np.uint64) for k in order]
    forest = _Forest(ids)
    for i, j in _pairs(unit, block, lo, hi):
        i, j, far = _allowed(i, j, n, sig)
        for k in np.argsort(far, kind="stable").tolist():
            x, y = int(i[k]), int(j[k])
            if forest.find(forest.at[x]) != forest.find(forest.at[y]):
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * common >= LEAST * (int(n[x]) + int(n[y]) - common):
                    forest.join(x, y)
    return forest.edges()


_SET = ["n_shingles", "f1", "f2"]


def _components(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): doc_id and set of every row; set, number, group (least class number reachable)
    and least id of every class of equal sets."""
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    rows = stage(signatures(docs, key, text), "signatures")
    real = rows.where("n_shingles > 0")
    # numbered once and written, so that a lost task cannot number again
    classes = stage(real.groupBy(*_SET).agg(F.min("doc_id").alias("low")).withColumn("id", F.monotonically_increasing_id()), "classes")

    def same(left: DataFrame, right: DataFrame) -> DataFrame:
        """Rows of ``left`` with the class that they are the least id of."""
        right = right.select(*[F.col(c).alias(f"_{c}") for c in _SET], F.col("low"), "id")
        return left.join(right, F.col("doc_id").eqNullSafe(F.col("low")) & (F.col("f1") == F.col("_f1")) & (F.col("f2") == F.col("_f2")) & (F.col("n_shingles") == F.col("_n_shingles")))

    members = stage(same(real, classes).select("id", F.col("n_shingles").alias("n"), "sig", "keys").dropDuplicates(["id"]), "representatives")
    postings = members.select(F.explode("keys").alias("key"), "id", F.lit(SCREEN + 64).alias("bytes"))
    units = _units(postings, "key", "bytes").join(members.drop("keys"), "id")  # signatures only where a key has several
    near = stage(units.groupBy("home").applyInArrow(_screened, _EDGE), "near")
    clusters = stage(components(near), "clusters")

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            sets = [shingle_set(t).tobytes() for t in texts_of(batch, "_text")]
            prints = [xxhash.xxh3_128_digest(s) for s in sets]
            return {"shingles": sets, "n_shingles": [len(s) // 8 for s in sets], "f1": [int.from_bytes(f[:8], "little", signed=True) for f in prints],
                    "f2": [int.from_bytes(f[8:], "little", signed=True) for f in prints]}
        return run

    listed = clusters.select("id").unionByName(clusters.select(F.col("component").alias("id"))).distinct()
    listed = stage(listed.join(clusters, "id", "left").select("id", F.coalesce("component", "id").alias("cluster")).join(classes, "id"), "cluster_ids")
    named = by_ids(texts, listed.select("low").where("low is not null").distinct(), "doc_id", "left_semi")
    unnamed = by_ids(texts.where("doc_id is null").withColumn("_none", F.lit(0)), listed.where("low is null").select(F.lit(0)).distinct(), "_none", "left_semi").drop("_none")
    sets = same(with_columns(named.union(unnamed).distinct(), "shingles binary, n_shingles long, f1 long, f2 long", make).drop("_text"), listed)
    inside = (sets.select("id", "shingles").join(listed.select("id", "cluster"), "id").join(members.drop("keys"), "id")
              .withColumn("bytes", F.octet_length("shingles") + SCREEN + 64))
    inside = stage(inside, "cluster_members")
    links = stage(_units(inside, "cluster", "bytes").groupBy("home").applyInArrow(_linked, _EDGE), "links")

    # an id on rows of several classes links them
    own = real.where("doc_id is not null").select("doc_id", *_SET)
    mixed = own.groupBy("doc_id").agg(*[(F.min(c) < F.max(c)).alias(c) for c in _SET]).where(" or ".join(_SET)).select("doc_id")
    several = own.join(mixed, "doc_id", "left_semi").distinct().join(classes.select("id", *_SET), _SET).select("doc_id", "id")
    several = several.join(several.groupBy("doc_id").agg(F.min("id").alias("b")), "doc_id").where("id <> b").select(F.col("id").alias("a"), "b")
    final = stage(components(links.union(several)), "components")
    grouped = classes.join(final, "id", "left").withColumn("component", F.coalesce("component", "id"))
    lows = grouped.groupBy("component").agg(F.min("low").alias("component_id"))
    return rows.select("doc_id", *_SET), stage(grouped.join(lows, "component"), "class_components")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    rows, classes = _components(docs, key, text)
    out = rows.join(classes.select(*_SET, "component", F.col("component_id").alias("least")), _SET, "left")
    own = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least"))  # without a set: itself
    return out.withColumn("component_id", own).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one of least id."""
    rows, classes = _components(docs, key, text)
    placed = rows.join(classes.select(*_SET, "component", "component_id"), _SET, "left")
    dropped = stage(placed.where("component is not null and doc_id <> component_id").select("doc_id").distinct(), "dropped")
    # ids on several rows, and null: a fingerprint decides which row stays
    repeated = stage(rows.groupBy("doc_id").count().where("count > 1 or doc_id is null").select("doc_id"), "repeated_ids")
    left = by_ids(docs, dropped, key, "left_anti")
    if not repeated.limit(1).count():
        return left
    once = by_ids(left, repeated, key, "left_anti").where(F.col(key).isNotNull())
    first = classes.groupBy("component").agg(F.min(F.struct(F.col("low").isNull().alias("none"), "low", *_SET)).alias("first")).select("first.*").drop("none")
    whole = left.select(F.struct("*").alias("_doc"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    many = by_ids(whole, repeated, "doc_id", "left_semi").unionByName(whole.where("doc_id is null"))

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            sets = [shingle_set(t) for t in texts_of(batch, "_text")]
            prints = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            return {"n_shingles": [len(s) for s in sets], "f1": [int.from_bytes(f[:8], "little", signed=True) for f in prints],
                    "f2": [int.from_bytes(f[8:], "little", signed=True) for f in prints]}
        return run

    many = with_columns(many, "n_shingles long, f1 long, f2 long", make)
    first = first.select(F.col("low"), *[F.col(c).alias(f"_{c}") for c in _SET])
    firsts = many.where("n_shingles > 0").dropDuplicates(["doc_id", *_SET]).join(
        first, F.col("doc_id").eqNullSafe(F.col("low")) & (F.col("f1") == F.col("_f1")) & (F.col("f2") == F.col("_f2")) & (F.col("n_shingles") == F.col("_n_shingles")), "left_semi")
    chosen = many.where("n_shingles = 0").unionByName(firsts).select("_doc.*")
    return once.unionByName(chosen.select(*once.columns))
