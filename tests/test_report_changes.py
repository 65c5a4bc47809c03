"""The report kept by changes equals a full one after every batch of random changes on all three sides."""

import random

from conftest import rows
from strata.operators.cdc import diff_snapshots
from strata.operators.dims import apply_changes
from strata.operators.reports import ReportJoin, report_changes, report_table
from test_plans import plan

FACT, DIM = "id bigint, st string, a bigint, b bigint, x int", "sk bigint, name string, more string"
KEPT = {"status_col": "st", "fact_cols": ["x"]}


def joins(a, b):
    return [ReportJoin(a, "sk", "a", {"name": "a_name", "more": "a_more"}), ReportJoin(b, "sk", "b", {"name": "b_name"})]


def changed(rng, table, make):
    return {k: make(rng, k) if rng.random() < 0.3 else v for k, v in table.items() if rng.random() > 0.1} | {
        k: make(rng, k) for k in rng.sample(range(40), 5) if k not in table}


def fact_row(rng, k):
    return k, rng.choice(["P", "P", "F", None]), rng.choice([0, 1, 2, 3, 4, None]), rng.randrange(6), rng.randrange(3)


def dim_row(rng, k):
    return k, rng.choice(["n", "m", None]), rng.choice("pq")


def test_kept_report_equals_a_full_one(spark):
    rng = random.Random(3)
    fact, a, b = {}, {}, {}
    frames = lambda f, a, b: (spark.createDataFrame(list(f.values()), FACT), spark.createDataFrame(list(a.values()), DIM), spark.createDataFrame(list(b.values()), DIM))
    old = frames(fact, a, b)
    report = report_table(old[0], "P", joins(*old[1:]), "id", **KEPT)
    seen = set()
    for step in range(4):
        fact = changed(rng, fact, fact_row)
        a, b = ({k: v for k, v in changed(rng, d, dim_row).items() if k < 6} | {step: dim_row(rng, step)} for d in (a, b))
        new = frames(fact, a, b)
        feeds = [diff_snapshots(o, n, k) for o, n, k in zip(old, new, ("id", "sk", "sk"))]
        changes = report_changes(report, feeds[0], {0: feeds[1], 1: feeds[2]}, "P", joins(*new[1:]), "id", **KEPT).checkpoint()
        seen |= {r["_op"] for r in changes.collect()}
        assert changes.select("id").distinct().count() == changes.count()
        report = apply_changes(report, changes, "id").checkpoint()
        assert rows(report) == rows(report_table(new[0], "P", joins(*new[1:]), "id", **KEPT))
        old = new
    assert seen == {"INSERT", "UPDATE", "DELETE"}


def test_plan_does_not_read_the_fact(spark, tmp_path):
    fact, dim = spark.createDataFrame([(1, "P", 1, 1, 1)], FACT), spark.createDataFrame([(1, "n", "p")], DIM)
    fact.write.parquet(str(tmp_path / "whole_fact"))
    kept = spark.read.parquet(str(tmp_path / "whole_fact"))
    report_table(kept, "P", joins(dim, dim), "id", **KEPT).write.parquet(str(tmp_path / "report"))
    feed = diff_snapshots(dim, spark.createDataFrame([(1, "new", "p")], DIM), "sk")
    none = diff_snapshots(fact, fact, "id")
    c = report_changes(spark.read.parquet(str(tmp_path / "report")), none, {0: feed}, "P", joins(spark.createDataFrame([(1, "new", "p")], DIM), dim), "id", **KEPT)
    assert "whole_fact" not in plan(c)
    assert rows(c, "id", "a_name", "b_name", "_op") == [(1, "new", "n", "UPDATE")]
