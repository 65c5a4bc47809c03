"""Late batches: any order, and any cut of the log into batches, ends in the history of the whole log."""

import datetime as dt
import random

import pytest

from conftest import rows
from strata.operators.dims import apply_changes, scd2_from_history
from strata.operators.late import SEEN, scd2_late

LOG = "k bigint, v string, w int, ts timestamp_ntz, id bigint"


def log_rows(seed, n=90):
    rng = random.Random(seed)
    out = [(rng.choice([1, 1, 1, 2, 3]), rng.choice("ab") if rng.random() < 0.9 else None, rng.choice([0, 0, 1]),
            dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 25)), i) for i in range(n)]
    return out + [(None, "a", 1, dt.datetime(2024, 1, 1), n), (2, "a", 1, None, n + 1)]


def run(spark, batches, check=None):
    dim = spark.createDataFrame([], "sk bigint, k bigint, v string, w int, effective_date date, expiry_date date, current_flag boolean")
    obs = spark.createDataFrame([], f"k bigint, effective_date date, v string, w int, {SEEN} struct<ts: timestamp_ntz, id: bigint>")
    for b in batches:
        changes, splits = scd2_late(dim, obs, spark.createDataFrame(b, LOG), "k", ["v", "w"], "ts", ["id"], "sk")
        changes = changes.checkpoint()
        if check:
            check(dim, changes)
        dim = apply_changes(dim, changes, "sk").checkpoint()
        obs = apply_changes(obs, splits, ["k", "effective_date"]).checkpoint()
    return dim


def whole(spark, log):
    return rows(scd2_from_history(spark.createDataFrame(log, LOG).filter("k is not null and ts is not null"), "k", ["v", "w"], "ts", ["id"]),
                "k", "v", "w", "effective_date", "expiry_date", "current_flag")


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 2, 0)])
def test_any_order_of_batches(spark, order):
    log = log_rows(7)
    log.sort(key=lambda r: (r[3] is None, r[3]))
    batches = [log[:30], log[30:60], log[60:]]
    dim = run(spark, [batches[i] for i in order])
    assert rows(dim.drop("sk")) == whole(spark, log)
    assert dim.select("sk").distinct().count() == dim.count()


def test_overlapping_batches_and_replays(spark):
    log = log_rows(8)
    random.Random(1).shuffle(log)

    def keeps_keys(dim, changes):
        """A version that still starts where it did keeps its surrogate key; no other row changes."""
        was = {(r["k"], r["effective_date"]): r["sk"] for r in dim.collect()}
        for r in changes.collect():
            old = was.get((r["k"], r["effective_date"]))
            assert (old is None) == (r["_op"] == "INSERT") and (old is None or old == r["sk"])

    dim = run(spark, [log[:40], log[20:70], log[60:], log[:40], []], keeps_keys)
    assert rows(dim.drop("sk")) == whole(spark, log)


def test_split_goes_on_after_the_late_change(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    dim = run(spark, [[(1, "a", 0, day(1), 1), (1, "a", 0, day(5), 2), (1, "a", 0, day(9), 3)], [(1, "b", 0, day(7), 4)]])
    assert rows(dim, "sk", "v", "effective_date", "expiry_date") == rows(spark.createDataFrame(
        [(1, "a", day(1).date(), day(7).date()), (2, "b", day(7).date(), day(9).date()), (3, "a", day(9).date(), None)], "sk bigint, v string, e date, x date"))
