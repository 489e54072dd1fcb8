"""Conversation prefix trie from ternary search trees over range shards.

Every distinct turn (role, text) gets a number from a dictionary, so a conversation becomes a
sequence of numbers. Equal sequences are counted together; the distinct ones are dealt to shards
by range, so a shard holds neighbours in lexicographic order. A shard builds one ternary search
tree: turn numbers are compared less, equal, greater, and sequences are inserted median first, so
the search among siblings stays shallow. One backward pass over the nodes, which are numbered
parent first, sums members, leaves and savings; nothing recurses, so depth is no limit.

Nodes that two shards share lie on a shard's first or last sequence. A shard knows how deep its
first sequence agrees with the shard before it and its last one with the shard after it. It counts
what is shared only where it stands first, so the shards' figures for one node simply add up: only
those boundary nodes are merged, by an aggregate.

Edge cases: rows without a conversation id belong to no conversation and are left out; a null role
or text is empty; a null turn comes first, rows of one turn number follow by the SHA-256 of role
and text; repeated rows are repeated turns; very long texts are hashed and counted whole; an empty
table gives no node; other columns, clashing names included, are not read. A conversation's turn
numbers (eight bytes each) must fit one row, texts need not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import record_batch, slices, stage

#: Turns of distinct sequences that one shard's tree holds, about.
SHARD_TURNS = 100_000
#: Conversation ids joined into one piece of text before a digest reads them.
RUN_IDS = 4_096

RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


# ---- conversations as sequences of turn numbers --------------------------------------------

def coded(conversations: DataFrame) -> DataFrame:
    """(conv_id, codes, sizes): each conversation's turn numbers in order, and the code points of
    each turn's text. Only ids, hashes and sizes are shuffled, never texts."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    spoken = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.unhex(F.sha2(spoken.cast("binary"), 256)).alias("said"), F.char_length(text).cast("long").alias("size"))
    # numbers are written before use: a lost executor must not number the turns anew
    dictionary = stage(turns.select("said").distinct().withColumn("code", F.monotonically_increasing_id()), "turn_codes")
    # the join may meet a first turn that a third of all rows share: both sides are shuffled for
    # it alone, so adaptive execution splits that partition
    rows = turns.join(dictionary, "said")
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "said", "code", "size"))).alias("t"))
    return listed.select("conv_id", F.col("t.code").alias("codes"), F.col("t.size").alias("sizes"))


def rebuilt(convs: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Every conversation c with its first h turns replaced by those of conversation c - c % block
    (all if fewer, none if absent), h = crc32(c as text) % most."""
    convs = stage(convs, "conversations")
    heads = convs.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("_head"), *(F.slice(c, 1, most - 1).alias(f"_{c}") for c in ("codes", "sizes")))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    both = convs.join(heads, F.col("conv_id") - F.col("conv_id") % block == F.col("_head"), "left").withColumn("_h", h)
    none = F.array().cast("array<long>")
    return both.select("conv_id", *(
        F.concat(F.slice(F.coalesce(f"_{c}", none), F.lit(1), F.col("_h")), F.slice(c, F.col("_h") + 1, F.size(c))).alias(c) for c in ("codes", "sizes")))


# ---- distinct sequences ------------------------------------------------------------------

def _struct(fields: str) -> T.StructType:
    kinds = {"long": T.LongType(), "longs": T.ArrayType(T.LongType()), "string": T.StringType(), "binary": T.BinaryType(), "int": T.IntegerType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (f.split(":") for f in fields.split())])


_SEQUENCE = _struct("codes:longs sizes:longs conv_id:long n:long ends:string")
_RUNS = _struct("codes:longs sizes:longs conv_id:long n:long ids:string")
#: Rows that a task returns at once.
_ROWS = 500


def _batches(rows: Iterator[tuple], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, _ROWS)):
        yield record_batch(dict(zip(schema.names, zip(*some))), schema)


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for whole in batches:
        for batch in slices(whole):
            yield from zip(*(batch.column(x).to_pylist() for x in names))


def _runs(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Neighbouring rows of one sequence as one row for each ``RUN_IDS`` ids, ids joined by commas."""
    codes, sizes, ids = None, None, []
    for c, s, i in rows:
        if ids and (c != codes or len(ids) == RUN_IDS):
            yield codes, sizes, ids[0], len(ids), ",".join(map(str, ids))
            ids = []
        codes, sizes = c, s
        ids.append(i)
    if ids:
        yield codes, sizes, ids[0], len(ids), ",".join(map(str, ids))


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One row for each sequence: its digest reads the runs one after another, none is kept."""
    now, digest = None, None
    for codes, sizes, conv, n, ids in rows:
        if now and now[0] == codes:
            now[3] += n
            digest.update(b"," + ids.encode())
        else:
            if now:
                yield *now, digest.hexdigest()
            now, digest = [codes, sizes, conv, n], hashlib.sha256(ids.encode())
    if now:
        yield *now, digest.hexdigest()


def sequences(convs: DataFrame) -> DataFrame:
    """(codes, sizes, conv_id, n, ends) for each distinct sequence: smallest id, number of
    conversations and the SHA-256 of their ids, ascending and comma-joined.

    Conversations are sorted by (sequence, id) over the whole cluster, so one sequence that a third
    of them share spreads over many tasks; each makes texts of thousands of ids, and only those
    (one row for ``RUN_IDS`` conversations) meet in the task that hashes them in order.
    """
    def runs(batches):
        return _batches(_runs(_rows(batches, "codes", "sizes", "conv_id")), _RUNS)

    def digests(batches):
        return _batches(_digests(_rows(batches, *_RUNS.names)), _SEQUENCE)

    made = convs.repartitionByRange("codes", "conv_id").sortWithinPartitions("codes", "conv_id").mapInArrow(runs, _RUNS)
    return made.repartition("codes").sortWithinPartitions("codes", "conv_id").mapInArrow(digests, _SEQUENCE)


# ---- one shard's tree --------------------------------------------------------------------

class TernaryTree:
    """Trie of integer sequences whose children are found by ternary search. Nodes are numbered
    in the order of insertion, the root is 0, so a parent's number is below its children's."""

    def __init__(self):
        self.code, self.less, self.more, self.below = [-1], [-1], [-1], [-1]
        self.parent, self.depth, self.size = [-1], [0], [0]

    def _add(self, code: int, parent: int, size: int) -> int:
        for column, value in ((self.code, code), (self.less, -1), (self.more, -1), (self.below, -1),
                              (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.size, size)):
            column.append(value)
        return len(self.code) - 1

    def insert(self, codes: list[int], sizes: list[int]) -> int:
        """The node of a sequence, made where it is missing."""
        code, less, more, below, at = self.code, self.less, self.more, self.below, 0
        for c, size in zip(codes, sizes):
            links, j = below, at
            while (k := links[j]) >= 0:
                if code[k] == c:
                    break
                links, j = (less, k) if c < code[k] else (more, k)
            else:
                k = links[j] = self._add(c, at, size)
            at = k
        return at

    def path(self, node: int) -> list[int]:
        """Nodes from the root to ``node``."""
        out = [node]
        while out[-1]:
            out.append(self.parent[out[-1]])
        return out[::-1]


def median_first(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of every range before its halves."""
    ranges = [(0, n)]
    while ranges:
        low, high = ranges.pop()
        if low < high:
            mid = (low + high) // 2
            yield mid
            ranges += [(mid + 1, high), (low, mid)]


def chained_keys(codes: list[int]) -> list[bytes]:
    """A key for every prefix, the empty one first; each is made from the one before it."""
    keys = [hashlib.blake2b(b"", digest_size=16).digest()]
    for c in codes:
        keys.append(hashlib.blake2b(keys[-1] + c.to_bytes(8, "little"), digest_size=16).digest())
    return keys


def shard_nodes(shard: int, rows: list[tuple], before: int, after: int) -> dict[str, list]:
    """Columns of the nodes of one shard. ``rows``: sorted (codes, sizes, conv_id, n, ends);
    ``before``, ``after``: turns that the first sequence shares with the shard before, and the
    last one with the shard after it (-1: there is none)."""
    tree, node_of = TernaryTree(), [0] * len(rows)
    for i in median_first(len(rows)):
        node_of[i] = tree.insert(rows[i][0], rows[i][1])
    count = len(tree.code)
    n, least, ends = [0] * count, [None] * count, [None] * count
    children, leaves, saved, parted = [0] * count, [0] * count, [0] * count, [False] * count
    for at, (_, _, conv, members, digest) in zip(node_of, rows):
        n[at], least[at], ends[at] = members, conv, digest
    first, last = tree.path(node_of[0]), tree.path(node_of[-1])
    counted = set(first[:before + 1])  # stand in an earlier shard, which counts them once
    shared = counted | set(last[:after + 1])
    parted[node_of[-1]] = after == len(last) - 1  # then its children stand in the next shard
    for at in range(count - 1, -1, -1):
        leaves[at] += not parted[at]
        saved[at] += (n[at] - (at not in counted)) * tree.size[at]
        if at:
            up = tree.parent[at]
            parted[up] = True
            n[up] += n[at]
            saved[up] += saved[at]
            leaves[up] += leaves[at]
            children[up] += at not in counted
            least[up] = least[at] if least[up] is None else min(least[up], least[at])
    key: list[bytes | None] = [None] * count
    for path, codes in ((first, rows[0][0]), (last, rows[-1][0])):
        if path and path[0] in shared:
            deep = max(before, after)
            for at, k in zip(path, chained_keys(codes[:deep])):
                key[at] = k if at in shared else None
    up = tree.parent
    return {"shard": [shard] * count, "depth": tree.depth, "conv_id": least, "parent_conv_id": [least[p] if p >= 0 and key[p] is None else None for p in up],
            "n_convs": n, "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "ends": ends,
            "own_key": key, "parent_key": [key[p] if p >= 0 else None for p in up]}


_NODE = _struct("shard:int depth:long conv_id:long parent_conv_id:long n_convs:long n_children:long n_leaves:long saved_tokens:long "
                "ends:string own_key:binary parent_key:binary")


# ---- all shards --------------------------------------------------------------------------

def _common(x: str, y: str):
    """Leading elements that two arrays share; -1 if one is missing."""
    same = F.zip_with(x, y, lambda p, q: p.eqNullSafe(q))
    at = F.array_position(same, False)
    return F.when(F.col(x).isNull() | F.col(y).isNull(), -1).when(at == 0, F.size(same)).otherwise(at - 1).cast("int")


def trie(distinct: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie of ``distinct`` sequences (as ``sequences`` gives them): ``RESULT`` and
    ``ends``, the digest of the sequence that ends there (null: none)."""
    distinct = stage(distinct, "sequences")
    turns = distinct.agg(F.sum(F.size("codes") + 1)).first()[0] or 0
    ranged = distinct.repartitionByRange(max(1, -(-turns // shard_turns)), "codes").withColumn("shard", F.spark_partition_id())
    ranged = stage(ranged, "shards")
    # one row a shard from here: its ends, those of its neighbours, and how deep they agree
    at = Window.orderBy("shard")
    bounds = ranged.groupBy("shard").agg(F.min("codes").alias("first"), F.max("codes").alias("last")).select(
        "shard", "first", "last", F.lag("last").over(at).alias("prev"), F.lead("first").over(at).alias("next"))
    bounds = bounds.select("shard", _common("prev", "first").alias("before"), _common("last", "next").alias("after"))
    def build(rows: pa.Table, bound: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.Table.from_batches([record_batch({f: [] for f in _NODE.names}, _NODE)])
        b = bound.to_pylist()[0]
        cols = [rows.column(c).to_pylist() for c in _SEQUENCE.names]
        order = sorted(range(rows.num_rows), key=cols[0].__getitem__)
        got = shard_nodes(b["shard"], [tuple(c[i] for c in cols) for i in order], b["before"], b["after"])
        return pa.Table.from_batches([record_batch(got, _NODE)])

    nodes = stage(ranged.groupBy("shard").cogroup(bounds.groupBy("shard")).applyInArrow(build, _NODE), "shard_nodes")
    edge = nodes.where("own_key IS NOT NULL")
    merged = edge.groupBy("own_key").agg(
        F.max("parent_key").alias("up"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *(F.sum(c).alias(c) for c in RESULT[3:]), F.max("ends").alias("ends"))
    ids = merged.select(F.col("own_key").alias("id_key"), F.col("conv_id").alias("id_conv"))
    # a merged parent's id goes to its children by shard, so no node's children meet in one task
    by_shard = edge.select(F.col("shard").alias("id_shard"), "own_key").join(ids, F.col("own_key") == F.col("id_key")).drop("own_key")
    inner = nodes.where("own_key IS NULL")
    known = inner.where("parent_key IS NULL").select(*RESULT, "ends")
    under = inner.where("parent_key IS NOT NULL").join(by_shard, (F.col("shard") == F.col("id_shard")) & (F.col("parent_key") == F.col("id_key"))).select(
        *(F.col("id_conv" if c == "parent_conv_id" else c).alias(c) for c in RESULT), "ends")
    tops = merged.join(ids, F.col("up") == F.col("id_key"), "left").select(
        *(F.col("id_conv" if c == "parent_conv_id" else c).alias(c) for c in RESULT), "ends")
    return known.unionByName(under).unionByName(tops)


def ends_digest(nodes: DataFrame) -> DataFrame:
    """``ends_sha256`` instead of ``ends``: nodes at which no conversation ends get the hash of
    nothing."""
    return nodes.select(*RESULT, F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
