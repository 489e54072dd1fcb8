"""Filter interaction audit with decision diagrams.

A document's failures form a mask, one bit a filter. Masks are counted per part in Spark; each
part's counts (at most 2^filters rows) become one count-weighted decision diagram: a level tests
a filter, the low edge leads to documents that pass it, the high edge to those that fail it, every
node carries the counts below it, and equal nodes of a level are one. Two neighbouring levels are
swapped in place, so a chain of swaps (plain changes) visits every order of the filters without
building anew. An order's all-pass path (low edges from the root) gives its steps: what the low
node holds is kept, what the high node holds is removed.

Edge cases: a null text is empty; a null part is the empty string; a document without an id is
never a copy of a smaller id, nor does it make another one a copy; rows of one id and one text are
no copies of each other; a document is labelled 1 if any of its label rows says so, null labels
count as 0; ties do not occur, as rows are only counted; texts are counted whole however long; an
empty table gives no part and no row; other columns, clashing names included, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import record_batch

#: The filters, in the order of their bits.
FILTERS = "ABCDE"

_COUNTS = ("n", "good", "toxic")
_STEPS = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


# ---- failure masks -----------------------------------------------------------------------

def text_failures(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """(id, part, mask, print) for each document: failures of A to D by its text alone, and the
    text's SHA-256, by which equal texts are found."""
    named = docs.select(F.col(key).alias("id"), F.coalesce(F.col(source), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    words = named.withColumn("words", F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), ""))
    n = F.size("words")
    fails = [n < 200, 100 * F.size(F.array_distinct("words")) < 50 * n,
             100 * F.regexp_count("t", F.lit("[A-Z]")) > 2 * F.char_length("t"), F.col("t").rlike(r"[#$%&*|]")]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return words.select("id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("print"))


def mask_counts(failures: DataFrame, labels: DataFrame, copy_bit: int = FILTERS.index("E")) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part with each mask, after the filter that
    fails copies of a smaller id's text.

    Every step is an aggregate combined on the map side, so a text or a part that a third of the
    rows share moves as one row a task. Copies need no join back to the documents: rows of one
    text, part and label either hold its smallest id or are all copies.
    """
    flags = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"), F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"))
    rows = failures.groupBy("id", "part", "mask", "print").agg(F.count("*").alias("n"))
    rows = rows.join(flags, "id", "left").na.fill(0, ["good", "toxic"])
    texts = rows.groupBy("print", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", "id").alias("n_least"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    # one row for each text, part and label is left: its smallest id over all of them
    least = F.expr("min(least) OVER (PARTITION BY print)")
    firsts = F.col("n_null") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    both = texts.withColumn("first", least).select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), firsts.alias("n")),
        F.struct(F.col("mask").bitwiseOR(1 << copy_bit).alias("mask"), (F.col("n") - firsts).alias("n")))).alias("m"))
    n = F.col("m.n")
    return both.where(n > 0).groupBy("part", F.col("m.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


# ---- the diagram -------------------------------------------------------------------------

class Node:
    """Documents below: ``low`` pass this level's filter, ``high`` fail it."""

    __slots__ = ("low", "high", "weight")

    def __init__(self, low, high, weight: tuple[int, ...]):
        self.low, self.high, self.weight = low, high, weight


def _sum(x: tuple[int, ...], y: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(map(int.__add__, x, y))


class Diagram:
    """Count-weighted decision diagram over masks. ``order`` names the filter of each level;
    ``levels[i]`` holds the nodes of level i by their children. Empty sets are one node."""

    def __init__(self, counts: dict[int, tuple[int, ...]], filters: int):
        zero = (0,) * len(next(iter(counts.values()), (0,)))
        self.empty = Node(None, None, zero)
        self.empty.low = self.empty.high = self.empty
        self.order = list(range(filters))
        self.levels: list[dict] = [{} for _ in range(filters)]
        ends: dict[tuple, Node] = {}
        below = {m: ends.setdefault(w, Node(self.empty, self.empty, w)) for m, w in counts.items() if any(w)}
        for level in reversed(range(filters)):
            bit = 1 << level
            below = {m: self._node(level, below.get(m, self.empty), below.get(m | bit, self.empty)) for m in {m & ~bit for m in below}}
        self.root = below.get(0, self.empty)

    def _node(self, level: int, low: Node, high: Node) -> Node:
        if low is self.empty and high is self.empty:
            return self.empty
        known = self.levels[level]
        if (at := (id(low), id(high))) not in known:
            known[at] = Node(low, high, _sum(low.weight, high.weight))
        return known[at]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one. Nodes of ``level`` keep their
        identity and weight, so nothing above changes; nodes of the next level are made anew."""
        upper = list(self.levels[level].values())
        self.levels[level], self.levels[level + 1] = {}, {}
        for u in upper:
            a, b = u.low, u.high
            u.low, u.high = self._node(level + 1, a.low, b.low), self._node(level + 1, a.high, b.high)
            self.levels[level][id(u.low), id(u.high)] = u
        o = self.order
        o[level], o[level + 1] = o[level + 1], o[level]

    def steps(self) -> list[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, kept, removed) along the all-pass path of the present order."""
        out, node = [], self.root
        for f in self.order:
            out.append((f, node.low.weight, node.high.weight))
            node = node.low
        return out


def plain_changes(n: int) -> Iterator[int]:
    """Places whose swaps (i, i + 1), one after another, run through all orders of n things."""
    if n < 2:
        return
    down = True
    for at in [*plain_changes(n - 1), None]:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if at is not None:
            yield at + down
        down = not down


def audit_part(counts: dict[int, tuple[int, ...]], filters: str = FILTERS) -> list[dict]:
    """Steps of all orders for one part's mask counts (documents, good ones, toxic ones)."""
    diagram, k = Diagram(counts, len(filters)), len(filters)
    paths = {tuple(diagram.order): diagram.steps()}
    for at in plain_changes(k):
        diagram.swap(at)
        paths[tuple(diagram.order)] = diagram.steps()
    assert len(paths) == factorial(k)
    total, alone, shapley = [0] * k, [0] * k, [0] * k
    for path in paths.values():
        total[path[0][0]] = path[0][2][0]
        alone[path[-1][0]] = path[-1][2][0]
        for f, _, removed in path:
            shapley[f] += removed[0]
    return [{"filter_order": "".join(filters[f] for f in order), "step": i, "kept": kept[0], "removed": removed[0], "redundant": total[f] - removed[0],
             "unique_fails": alone[f], "good_lost": removed[1], "toxic_lost": removed[2], "shapley": shapley[f]}
            for order, path in paths.items() for i, (f, kept, removed) in enumerate(path, 1)]


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every order's steps for every part of ``counts`` (part, mask, n, good, toxic). A part is
    at most 2^filters rows; the result has filters! * filters rows a part."""
    schema = T._parse_datatype_string(_STEPS)

    def run(part: pa.Table) -> pa.Table:
        cols = part.to_pydict()
        rows = audit_part(dict(zip(cols["mask"], zip(*(cols[c] for c in _COUNTS)))), filters)
        out = {c: [r[c] for r in rows] for c in rows[0]} | {"part": [cols["part"][0]] * len(rows)}
        out["step"] = pa.array(out["step"], pa.int32())
        return pa.Table.from_batches([record_batch(out, schema)])

    return counts.groupBy("part").applyInArrow(run, schema)
