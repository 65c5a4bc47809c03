"""A gold step that fails mid-batch is audited, publishes nothing, and the replay publishes once."""

import pytest
from pyspark.sql import functions as F

import strata.plans.pipeline as pl
from strata.plans.pipeline import AIRLINE_COLUMNS, Pipeline
from strata.session import scratch_path
from strata.sources.csv import read_raw

ROWS = [
    "1,P1,Ann,Lee,Female,30,EG,Cairo Intl,EG,Egypt,AF,Africa,3/9/2022,LHR,Bob Ray,Delayed,Business,On Time",
    "2,P2,Tom,\"O'Neil, Jr\",Male,12.7,FR,Orly,FR,France,EU,Europe,2022-03-10,JFK,Sue Kay,On Time,Business,On Time",
    "3,P3,Eve,Fox,Female,abc,US,JFK,US,United States,NAM,North America,13/9/2022,0,Al Dee,Cancelled,Business,On Time",
    "4,P4,bad row",
]


def write(path, lines):
    with open(path, "w") as f:
        f.write(",".join(AIRLINE_COLUMNS) + "\n" + "\n".join(lines) + "\n")


def test_gold_failure_then_replay(spark, tmp_path, monkeypatch):
    d1, d2 = tmp_path / "a1", tmp_path / "a2"
    d1.mkdir(), d2.mkdir()
    write(d1 / "f1.csv", ROWS)
    write(d2 / "f2.csv", [ROWS[0].replace("3/9/2022", "4/1/2022").replace("Delayed", "On Time")])
    p = Pipeline(spark, scratch_path(spark, "t-replay"))
    p.run_batch(read_raw(spark, str(d1), AIRLINE_COLUMNS), "b1", "2024-02-01 00:00:00", "2024-02-01")
    assert p.table("bronze").count() == 3 and p.table("bronze_rejects").count() == 1
    silver = {r.passenger_id: (r.age, r.departure_date) for r in p.table("silver").collect()}
    assert silver["P2"][0] == 13 and silver["P3"] == (None, None)
    assert p.table("fact_flight_data").count() == 3

    real = pl.fact_merge

    def boom(*a, **k):
        raise RuntimeError("gold crashed")

    monkeypatch.setattr(pl, "fact_merge", boom)
    raw2 = read_raw(spark, str(d2), AIRLINE_COLUMNS)
    with pytest.raises(RuntimeError):
        p.run_batch(raw2, "b2", "2024-02-02 00:00:00", "2024-02-02")
    assert p.table("fact_flight_data").count() == 3                      # nothing of gold published
    assert p.table("silver").filter(F.col("passenger_id") == "P1").first().flight_status == "On Time"
    failed = p.audit_log().filter("status = 'FAILED'").collect()
    assert len(failed) == 1 and "gold crashed" in failed[0].error_message

    monkeypatch.setattr(pl, "fact_merge", real)
    p.run_batch(raw2, "b2", "2024-02-02 00:00:00", "2024-02-02")          # replay: bronze/silver no-ops
    assert p.table("bronze").count() == 4
    fact = p.table("fact_flight_data")
    assert fact.count() == 4                                             # rescheduled flight: a new row (literal)
    p.run_batch(raw2, "b2", "2024-02-02 00:00:00", "2024-02-02")          # second replay: nothing new
    assert p.table("fact_flight_data").count() == 4
