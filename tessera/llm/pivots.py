"""Near-duplicate vectors: a pivot-permutation index.

Each vector is described by its ``NEAREST`` nearest pivots (reference vectors, a bounded sample, no two
within ``CROWD`` plus the link's angle). Under each of its pivots it stands in the inverted list of
(label, pivot); two vectors of a list that share at least ``SHARED`` pivots are candidates, and their
cosine in double precision decides. A pair is counted once, in the list of its least shared pivot.

A vector within the angle ``CROWD`` of its nearest pivot is crowded: neighbours there are many and their
other pivots say little. Its home is that pivot's cell, and all its links are found exactly: angles are
a metric, so a vector linked to it lies within the link's angle more of the home, and at most twice the
link's angle further from the home than from its own nearest pivot. All such vectors visit the cell, where
every pair with a home vector is compared; a pair of two homes counts in the lesser one.

Equal vectors are one class. A long list is cut into blocks of about ``BLOCK`` vectors, and each
pair of blocks is a task's group, so no list is one group; a group gives each of its linked vectors
one row (links counted, least id it is connected with), never its pairs.

The number of pivots grows with the square root of the vectors up to ``MOST`` (a bounded table);
recall against brute force is measured in the tests (at least 0.99 of links on the test tables, all
links of crowded vectors).

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components, and vectors without
a label, link with nothing and are their own component; vectors of unequal length don't link;
repeated rows are vectors of their own; rows without an id count as links but name no component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import components, record_batch, stage, with_columns

LEAST_COSINE = 0.98
NEAREST, SHARED = 12, 3
LEAST, MOST = 64, 1024
BLOCK = 1024
#: Vectors drawn for each pivot wanted; those too close to a chosen pivot are passed over.
DRAWN = 8
#: The largest angle of a link, with slack for rounding, and the angle round a pivot that is searched exactly.
LINK = float(np.arccos(LEAST_COSINE)) + 1e-6
CROWD = 2 * LINK


def _unit(packed: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def packed(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """vec_id, label and the components as bytes of doubles; null if the vector can't link."""
    def make():
        def run(batch: pa.RecordBatch) -> dict:
            out = []
            for v, known in zip(batch.column("_v").to_pylist(), batch.column("_label").is_valid().to_pylist()):
                x = np.array(v, np.float64) if known and v and None not in v else np.empty(0)
                good = len(x) and np.isfinite(x).all() and 0 < np.linalg.norm(x) < np.inf
                out.append((x + 0.0).tobytes() if good else None)
            return {"vec": out}
        return run

    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).alias("_label"), F.col(vector).cast("array<double>").alias("_v"))
    return with_columns(rows, "vec binary", make).drop("_v")


def _spread(drawn: list[bytes], many: int) -> list[bytes]:
    """At most ``many`` of the vectors, in order, without those close to one chosen before."""
    chosen: list[bytes] = []
    held: dict[int, np.ndarray] = {}  # unit vectors chosen, by length
    for v in drawn:
        x = _unit([v])
        if len(v) not in held or (held[len(v)] @ x[0]).max() < np.cos(CROWD + LINK):
            held[len(v)] = np.r_[held[len(v)], x] if len(v) in held else x
            chosen.append(v)
            if len(chosen) == many:
                break
    return chosen


def _tile(groups_schema: T.StructType, shared: int):
    """For one pair of blocks of one list: links of each vector and what it is connected with."""
    def run(table: pa.Table) -> pa.Table:
        mult, vec, ids = table.column("mult").to_numpy(), table.column("vec").to_pylist(), table.column("rep").to_numpy()
        block, pivot, lo, hi = table.column("block").to_numpy(), table.column("pivot")[0].as_py(), table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        x = _unit(vec)
        a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        close = x[a] @ x[b].T >= LEAST_COSINE
        if table.column("cell")[0].as_py():
            home = table.column("home").to_numpy()  # -1: not crowded
            i, j = np.nonzero(close)
            i, j = a[i], b[j]
            once = (home[i] == pivot) & ((home[j] < 0) | (home[j] >= pivot)) | (home[j] == pivot) & ((home[i] < 0) | (home[i] >= pivot))
            if lo == hi:
                once &= i < j
            i, j = i[once], j[once]
        else:
            near = np.array(table.column("near").to_pylist())
            names, at = np.unique(near, return_inverse=True)
            has = np.zeros((len(ids), len(names)), np.float32)
            has[np.arange(len(ids))[:, None], at.reshape(near.shape)] = 1
            i, j = np.nonzero((has[a] @ has[b].T >= shared) & close)
            i, j = a[i], b[j]
            if lo == hi:
                i, j = i[i < j], j[i < j]
            first = names[(has[i] * has[j]).argmax(1)] == pivot if len(i) else np.zeros(0, bool)
            i, j = i[first], j[first]
        links = np.bincount(i, mult[j], len(ids)) + np.bincount(j, mult[i], len(ids))
        root = ids.copy()
        while len(i):  # least id over links, until it settles
            low = np.minimum(root[i], root[j])
            new = root.copy()
            np.minimum.at(new, i, low)
            np.minimum.at(new, j, low)
            if (new == root).all():
                break
            root = new
        some = np.flatnonzero(links)
        return pa.Table.from_batches([record_batch({"id": ids[some].tolist(), "links": links[some].astype(np.int64).tolist(), "root": root[some].tolist()}, groups_schema)])
    return run


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``."""
    rows = stage(packed(vectors, key, vector, label), "vectors")
    classes = stage(rows.where("vec is not null").groupBy("_label", "vec").agg(F.min("vec_id").alias("least"), F.count("*").alias("mult"))
                    # a class without an id gets a stand-in above all ids, so that it names no component
                    .withColumn("rep", F.coalesce("least", F.xxhash64("vec").bitwiseAND(F.lit(2 ** 62 - 1)) + F.lit(2 ** 62))).drop("least"), "vector_classes")
    n = classes.count()
    many = int(min(MOST, max(LEAST, 4 * n ** 0.5)))
    pivots = _spread([r.vec for r in classes.orderBy(F.xxhash64("vec"), "vec").limit(DRAWN * many).select("vec").collect()], many)

    def make():
        held: dict[int, np.ndarray] = {}

        def reference(size: int) -> np.ndarray:
            """The pivots, cut or filled with zeros to the length of the vectors."""
            if size not in held:
                held[size] = np.stack([np.resize(np.r_[v, np.zeros(max(0, size - len(v)))], size) for v in (np.frombuffer(p, np.float64) for p in pivots)])
                held[size] /= np.linalg.norm(held[size], axis=1, keepdims=True) + 1e-300
            return held[size]

        def run(batch: pa.RecordBatch) -> dict:
            vec = batch.column("vec").to_pylist()
            near: list = [None] * len(vec)
            home, visits = [-1] * len(vec), [[] for _ in vec]
            size = np.array([len(v) for v in vec])
            for s in np.unique(size):
                at = np.flatnonzero(size == s)
                for part in np.array_split(at, -(-len(at) // 4096)):
                    angle = np.arccos(np.clip(_unit([vec[i] for i in part]) @ reference(s // 8).T, -1, 1))
                    orders = np.argsort(angle, axis=1, kind="stable")[:, :NEAREST]
                    least = angle.min(1)
                    for i, order, d in zip(part, orders, least):
                        near[i] = order.tolist() if d > CROWD else []
                        home[i] = -1 if d > CROWD else int(order[0])
                    for i, p in zip(*np.nonzero(angle <= np.minimum(least + 2 * LINK, CROWD + LINK)[:, None])):
                        visits[part[i]].append(int(p))
            return {"near": near, "size": (size // 8).tolist(), "home": home, "visits": visits}
        return run

    index = stage(with_columns(classes, "near array<int>, size int, home int, visits array<int>", make), "pivot_index")
    listing = ["_label", "size", "cell", "pivot"]
    postings = (index.select("*", F.lit(False).alias("cell"), F.explode("near").alias("pivot"))
                .union(index.select("*", F.lit(True).alias("cell"), F.explode("visits").alias("pivot"))).drop("visits"))
    blocks = (postings.groupBy(*listing).agg(F.count("*").alias("n"), F.max(F.col("home") == F.col("pivot")).alias("lived")).where("n > 1 and (lived or not cell)")
              .select(*listing, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    tiles = (postings.join(blocks, listing).withColumn("block", F.pmod(F.xxhash64("vec"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}))
    schema = T._parse_datatype_string("id long, links long, root long")
    found = stage(tiles.groupBy(*listing, "lo", "hi").applyInArrow(_tile(schema, min(SHARED, len(pivots))), schema), "vector_links")

    linked = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = (classes.join(linked, F.col("rep") == F.col("id"), "left").drop("id").join(groups, F.col("rep") == F.col("id"), "left")
             .select("_label", "vec", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("component")))
    out = rows.join(named, ["_label", "vec"], "left")
    return (out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
