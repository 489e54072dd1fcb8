"""Conversation prefix trie against a trie of whole prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tessera.llm import prefix_trie as pt
from tessera.llm import queries as q

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = [*pt.RESULT, "ends_sha256"]


def said_hash(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    """Rows of the contract from whole prefixes as dictionary keys."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append(((t is not None, t or 0), said_hash(role, text), (role, text)))
    own = {c: tuple(x[2] for x in sorted(v)) for c, v in turns.items()}
    nodes = defaultdict(list)
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        seq = own.get(base, ())[:h] + seq[h:]
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append((c, d == len(seq)))
    kids, out = defaultdict(int), set()
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, members in nodes.items():
        s = (len(members) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += s
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c, e in members if e))
        out.add((min(c for c, _ in members), len(p), min(c for c, _ in nodes[p[:-1]]) if p else None, len(members), kids[p], leaves[p], saved[p],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out, len(nodes)


def run(spark, rows, shard_turns=pt.SHARD_TURNS):
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in pt.ends_digest(pt.trie(pt.sequences(pt.rebuilt(pt.coded(df))), shard_turns)).select(*COLUMNS).collect()]
    want, n = brute(rows)
    assert len(got) == n
    assert set(got) == want


def conversations(rng, n, words, ids=400):
    rows = []
    for c in rng.sample(range(ids), n):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(words) if rng.random() < 0.8 else f"x{rng.random()}"))
    return rows


@pytest.mark.parametrize("shard_turns", [3, 40, 100_000])
def test_equals_whole_prefixes(spark, shard_turns):
    """Shards so small that most nodes are boundary nodes, and one shard only."""
    rng = random.Random(shard_turns)
    run(spark, conversations(rng, 150, ["a", "b", "ü" * 5]), shard_turns)


@pytest.mark.parametrize("shard_turns", [2, 15, 100_000])
def test_shared_and_nested_sequences(spark, shard_turns):
    """Many equal conversations, and each a prefix of the next."""
    rows = [(c, t, "u", "same") for c in range(50) for t in range(4)] + [(c, t, "u", "same") for c in range(50, 80) for t in range(c - 45)]
    run(spark, rows, shard_turns)


def test_runs_of_ids_are_cut(spark, monkeypatch):
    monkeypatch.setattr(pt, "RUN_IDS", 3)
    run(spark, [(c, t, "u", "same") for c in range(0, 900, 7) for t in range(6)], 10)


def test_edge_rows(spark):
    rows = [(None, 0, "u", "lost"), (1, None, "u", "first"), (1, 3, None, None), (1, 3, "u", "tie"), (1, 3, "u", "tie"), (1, -2, "", ""),
            (107, 0, "u", "only"), (205, 0, "u", "gone"), (206, 0, "u", "gone"), (-150, 0, "u", "minus"), (-100, 0, "u", "base"), (-100, 1, "u", "base"),
            (2**62, 0, "u", "far"), (5, 0, "u:", "x"), (6, 0, "u", ":x"), (300, 0, "u", "y" * 2_000_000)]
    for shard_turns in (1, 100_000):
        run(spark, rows, shard_turns)
    assert pt.trie(pt.sequences(pt.rebuilt(pt.coded(spark.createDataFrame([], SCHEMA))))).collect() == []


def test_turnless_conversations_are_members_of_the_root(spark):
    """Ids whose head is absent and whose own turns all stand in the replaced part."""
    ids = [c for c in range(100, 300) if c % 100 and zlib.crc32(str(c).encode()) % 6 > 1][:20]
    run(spark, [(c, 0, "u", "t") for c in ids], 1)


def test_long_conversations(spark):
    """Depth far beyond Python's recursion limit, shared over shards."""
    rows = [(c, t, "u", f"t{t if t < 1950 else t * c}") for c in (100, 200, 300) for t in range(2000)]
    got = pt.trie(pt.sequences(pt.rebuilt(pt.coded(spark.createDataFrame(rows, SCHEMA)))), 2000).select(*pt.RESULT).collect()
    at = {(r["depth"], r["conv_id"]): tuple(r)[2:] for r in got}
    assert len(at) == len(got) == 1951 + 150
    length = [len(f"t{t}") for t in range(1950)]
    for d in (0, 1, 700, 1949, 1950):
        assert at[d, 100] == (100 if d else None, 3, 3 if d == 1950 else 1, 3, 2 * sum(length[max(d - 1, 0):]))
    for c in (100, 200, 300):
        assert at[1951, c] == (100, 1, 1, 1, 0) and at[2000, c] == (c, 1, 0, 1, 0)


def test_extra_and_clashing_columns(spark):
    df = spark.createDataFrame([(7, 0, "u", "x", 1, "k")], SCHEMA + ", codes long, said string")
    assert len(pt.trie(pt.sequences(pt.rebuilt(pt.coded(df)))).collect()) <= 2


def test_median_first():
    for n in range(40):
        assert sorted(pt.median_first(n)) == list(range(n))
    tree = pt.TernaryTree()
    for i in pt.median_first(1023):
        tree.insert([i], [1])
    depth, deepest, todo = 0, 0, [(tree.below[0], 1)]
    while todo:
        at, depth = todo.pop()
        if at >= 0:
            deepest = max(deepest, depth)
            todo += [(tree.less[at], depth + 1), (tree.more[at], depth + 1)]
    assert deepest == 10


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r) for r in q.QUERIES["op12_ternary_prefix_trie"](spark, sf).select(*COLUMNS).collect()]
    want, n = brute(rows)
    assert len(got) == n and set(got) == want
