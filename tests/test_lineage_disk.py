"""Run lineage (A5, V12): light columns go along with the runs, and runs are dealt by their root once."""

import random

import pytest
from conftest import rows

from tessera.operators.lineage import nest_runs, resolve_roots


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _runs(spark):
    """Chains, trees, circles, links that lead nowhere; null and repeated keys."""
    rnd = random.Random(4)
    data = []
    for org in ("a", "b", None):
        for i in range(60):
            row = (org, i if rnd.random() < 0.95 else None, rnd.choice([None, i - 1, i // 3, i, rnd.randrange(70)]), float(rnd.randrange(9)), rnd.randrange(5))
            data += [row] * rnd.choice([1, 1, 2])
            if rnd.random() < 0.1:  # the same key with another link
                data.append((org, i, rnd.randrange(70), 7.0, 9))
    return spark.createDataFrame(data, "org string, run_id long, parent long, cost double, seq int")


def test_runs_with_their_columns_resolve_as_joined_ones(spark):
    runs = _runs(spark)
    cols = ["org", "run_id", "cost", "seq", "root", "top", "depth", "orphan"]
    joined = resolve_roots(runs.selectExpr("*", "cast(seq AS string) AS note"), "run_id", ["parent"], ["org"])
    kept = resolve_roots(runs, "run_id", ["parent"], ["org"], keep=["cost", "seq"])
    assert kept.columns == cols and rows(kept) == rows(joined, *cols) and kept.count() == runs.count()
    assert {r["depth"] for r in kept.collect()} >= {0, 1, 2, 3, 4}


def test_kept_columns_are_dealt_no_more_at_the_end(spark, no_broadcast):
    got = resolve_roots(_runs(spark), "run_id", ["parent"], ["org"], keep=["cost", "seq"])
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_nesting_deals_runs_by_their_root_once(spark, no_broadcast):
    got = resolve_roots(_runs(spark), "run_id", ["parent"], ["org"], keep=["cost", "seq"])
    nested = nest_runs(got, "run_id", ["seq"], ["org"])
    assert nested._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 2  # those below a root, and the roots
    flat = rows(got)
    for r in nested.where("org IS NOT NULL AND run_id IS NOT NULL").collect():
        of = [x for x in flat if x[0] == r["org"] and x[4] == r["run_id"]]
        near = sorted((x[3], x[1]) for x in of if x[6] == 1)
        assert [(c["seq"], c["run_id"]) for c in r["children"] or []] == near
        for c in r["children"] or []:
            far = sorted((x[3], x[1]) for x in of if x[6] > 1 and x[5] == c["run_id"])
            assert [(w["seq"], w["run_id"]) for w in c["workflow_children"] or []] == far and (far or c["workflow_children"] is None)


def test_short_chains_take_over_what_their_parents_found(spark, monkeypatch):
    """Three levels, with parents that are not there: the second round meets the parents only."""
    from tessera.operators import lineage
    data = [(f"o{i}", None) for i in range(6)] + [(f"l{i}", f"o{i % 9}") for i in range(20)] + [(f"p{i}", f"l{i % 25}") for i in range(60)] + [("p1", "l3"), ("o0", None)]
    runs = spark.createDataFrame(data, "run_id string, parent string").selectExpr("*", "1.0 AS cost")
    written, write = [], lineage.persist_and_reload
    monkeypatch.setattr(lineage, "persist_and_reload", lambda df: written.append(write(df)) or written[-1])
    got = sorted(tuple(r) for r in resolve_roots(runs, "run_id", ["parent"], keep=["cost"]).select("run_id", "root", "depth", "orphan").distinct().collect())
    want = set()
    for i in range(60):
        line, order = i % 25 if i != 1 else 1, None
        order = line % 9 if line < 20 else None
        want.add((f"p{i}", f"p{i}", 0, True) if order is None else (f"p{i}", f"o{order}", 2, False) if order < 6 else (f"p{i}", f"l{line}", 1, True))
    want |= {(f"l{i}", f"o{i % 9}", 1, False) if i % 9 < 6 else (f"l{i}", f"l{i}", 0, True) for i in range(20)} | {(f"o{i}", f"o{i}", 0, False) for i in range(6)}
    assert got == sorted(want)
    assert [len(x.where("next IS NOT NULL").take(1)) for x in written] == [1, 0] and written[1].count() == sum(d.startswith("p") and p is not None and int(p[1:]) < 20 for d, p in data)
