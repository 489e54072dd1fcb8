"""Helpers shared by the training-data operators.

Texts reach Python as Arrow batches of UTF-8 bytes: ``bytes.lower`` changes exactly A-Z and
``bytes.split`` cuts at exactly U+0020 and U+0009-U+000D, as the word definitions ask.
Staged tables go to the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ensure_checkpoint_dir

#: Share classes of crc32(doc_id as text); learners leave one of five classes out.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, what: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts the lineage
    (a lost executor loses nothing) and lets several consumers share one computation."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(col: str = "doc_id"):
    """crc32 of the id as text, modulo five."""
    return F.crc32(F.col(col).cast("string")) % FOLDS


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's texts as UTF-8 bytes; null gives an empty text."""
    col = batch.column(column)
    return [t or b"" for t in col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()]


#: Bytes of a record batch that a worker turns into Python objects at once.
SLICE = 3_000_000


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``SLICE`` bytes (a larger row is one part), in order."""
    if batch.num_rows:
        rows = max(1, int(SLICE * batch.num_rows / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: Bytes of a record batch between the JVM and Python workers, where the session leaves Spark's default of 64 MB.
BATCH = 4 << 20
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def bounded_batches(spark: SparkSession) -> None:
    """Both sides hold a batch at a time, in every task: smaller ones keep long texts from adding up."""
    if spark.conf.get(_BATCH_KEY) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, f"{BATCH}b")


def release() -> None:
    """Returns freed memory to the system: Python workers are reused by later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def with_columns(df: DataFrame, fields: str, make: Callable[[], Callable[[pa.RecordBatch], dict]]) -> DataFrame:
    """``df`` plus computed columns. ``make()`` runs once per task and gives a function from a
    record batch to ``{name: values}``. Columns of ``df`` with the same names are replaced."""
    new = T._parse_datatype_string(fields)
    kept = [f for f in df.schema.fields if f.name.lower() not in {x.name.lower() for x in new.fields}]
    schema = T.StructType(kept + new.fields)
    names = [f.name for f in kept]
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for whole in batches:
            for batch in slices(whole):
                got = fn(batch)
                cols = [batch.column(n) for n in names] + [_array(got[f.name], f.dataType) for f in new.fields]
                yield pa.RecordBatch.from_arrays(cols, names + [f.name for f in new.fields])
        del fn
        release()

    return df.mapInArrow(run, schema)


_ARROW = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(),
          T.StringType(): pa.string(), T.BooleanType(): pa.bool_(), T.BinaryType(): pa.binary()}


def arrow_type(t: T.DataType) -> pa.DataType:
    return pa.list_(arrow_type(t.elementType)) if isinstance(t, T.ArrayType) else _ARROW[t]


def _array(values, t: T.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, arrow_type(t))


def record_batch(columns: dict, schema: T.StructType) -> pa.RecordBatch:
    """Rows for ``mapInArrow`` / ``applyInArrow`` from a dict of value lists."""
    return pa.RecordBatch.from_arrays([_array(columns[f.name], f.dataType) for f in schema.fields], schema.names)


# ---- word and shingle hashes -------------------------------------------------------------

#: Odd multipliers, one for each place in a shingle (fixed so that all tasks agree).
_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                   0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """One 64-bit hash for every run of ``size`` word hashes, in text order. Fewer words give
    one shingle of the whole sequence (its length is part of the hash); none give none."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    k = min(n, size)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h += words[i:n - k + 1 + i] * _PLACE[i]
    return mix(h)


def shingle_set(text: bytes, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of a text (lower-cased A-Z, words cut at white space)."""
    return np.unique(shingle_hashes(word_hashes(text.lower().split()), size))


# ---- connected components ----------------------------------------------------------------

def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for every node of ``links`` (a, b): the smallest id reachable.

    Alternating large-star and small-star steps: every step is an aggregate (combined on the
    map side) and an equi-join, so a hub with many links is no single task's group. Each round
    is staged in the shared folder; the number of rounds grows with the logarithm of the graph.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    mark = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))


# ---- joins with lists of ids -------------------------------------------------------------

#: Ids (16 bytes each) up to which a list is broadcast; longer lists are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def by_ids(df: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of ``df`` with the staged id list ``ids`` (one column).
    The list's size is counted first: within ``BROADCAST_IDS`` the rows of ``df`` stay where
    they are, beyond it both sides are shuffled."""
    name = "_listed_" + uuid.uuid4().hex[:8]
    ids = ids.toDF(name)
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, F.col(key) == F.col(name), how)
