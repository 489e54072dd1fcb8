"""Filter interaction audit against enumeration of all orders."""

import random
import re
from itertools import permutations

from tessera.llm import filter_audit as fa
from tessera.llm import queries as q

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(docs, labels):
    """Rows of the contract, document by document and order by order."""
    marks = {}
    for i, quality, toxic in labels:
        good, bad = marks.get(i, (0, 0))
        marks[i] = (int(good or quality == 1), int(bad or toxic == 1))
    rows = []
    for i, text, source in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)}
        rows.append((source or "", {f for f, x in fails.items() if x}, marks.get(i, (0, 0)) if i is not None else (0, 0)))
    out = set()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order, 1):
                gone, left = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                steps.append((part, "".join(order), k, len(left), len(gone), sum(f in r[1] for r in own) - len(gone),
                              sum(r[1] == {f} for r in own), sum(r[2][0] for r in gone), sum(r[2][1] for r in gone)))
        out |= {(*s, shapley[s[1][s[2] - 1]]) for s in steps}
    return out


def run(spark, docs, labels):
    d = spark.createDataFrame([(i, t, None, s, 0) for i, t, s in docs], SCHEMA)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = fa.audit(fa.mask_counts(fa.text_failures(d), lab))
    assert got.columns == "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_plain_changes_visit_every_order():
    for n in range(1, 7):
        order, seen = list(range(n)), {tuple(range(n))}
        for i in fa.plain_changes(n):
            order[i], order[i + 1] = order[i + 1], order[i]
            assert tuple(order) not in seen
            seen.add(tuple(order))
        assert len(seen) == len(list(permutations(range(n))))


def test_swaps_keep_the_counts_and_share_nodes():
    rng = random.Random(3)
    for _ in range(30):
        k = rng.randint(1, 5)
        counts = {m: (rng.choice([1, 1, 2]), rng.randint(0, 1)) for m in range(1 << k) if not m or rng.random() < 0.6}
        d = fa.Diagram(counts, k)
        for _ in range(40):
            if k > 1:
                d.swap(rng.randrange(k - 1))
            for m in range(1 << k):
                node = d.root
                for f in d.order:
                    node = node.high if m >> f & 1 else node.low
                assert node.weight == counts.get(m, (0, 0))
            assert all(len({id(x) for x in level.values()}) == len(level) <= 1 << i for i, level in enumerate(d.levels))


def test_equal_masks_share_one_node_a_level():
    d = fa.Diagram({m: (1, 0, 0) for m in range(32)}, 5)
    for i in fa.plain_changes(5):
        d.swap(i)
        assert [len(x) for x in d.levels] == [1] * 5


def test_equals_enumeration(spark):
    rng = random.Random(5)
    long = " ".join(f"w{i}" for i in range(210))
    texts = [long, long + " $", "the " * 220, "A B C", "", None, "x", "x\x0by\x0cz\tq\nr\rs", "É" * 9, long.upper(), "a|b", "é" * 30 + "AB"]
    docs = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice([None, "", "s1", "s1", "s1", "s2"])) for _ in range(120)]
    labels = [(rng.choice([None, *range(40)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_edge_rows(spark):
    """One text on many rows, ids repeated, very long texts, extra columns, empty tables."""
    huge = " ".join(str(i) for i in range(300_000))
    docs = [(9, "same", "s"), (9, "same", "s"), (10, "same", "t"), (None, "same", "s"), (1, huge, "s"), (2, huge, None)]
    assert run(spark, docs, [(9, 1, 1), (9, 0, 0)]) == brute(docs, [(9, 1, 1), (9, 0, 0)])
    assert run(spark, [], []) == set()
    extra = spark.createDataFrame([(1, "a b", "s", 7, "x", 3)], "doc_id long, text string, source string, mask int, part string, n long")
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["part"] for r in fa.audit(fa.mask_counts(fa.text_failures(extra), lab)).collect()} == {"s"}


def test_query_equals_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert {tuple(r) for r in q.QUERIES["op13_filter_diagrams"](spark, sf).collect()} == brute(docs, labels)
