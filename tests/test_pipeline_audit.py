"""The success audit is part of the data commit; rescheduling updates the fact; reads by role."""

from strata.plans.gold import StarConfig
from strata.plans.pipeline import AIRLINE_COLUMNS, Pipeline, PipelineConfig
from strata.session import scratch_path
from strata.sources.csv import read_raw
from test_pipeline_replay import ROWS, write


def test_audit_in_the_data_commit_and_reads_by_role(spark, tmp_path):
    d1, d2 = tmp_path / "a1", tmp_path / "a2"
    d1.mkdir(), d2.mkdir()
    write(d1 / "f1.csv", ROWS[:3])
    write(d2 / "f2.csv", [ROWS[0].replace("3/9/2022", "4/1/2022")])
    p = Pipeline(spark, scratch_path(spark, "t-commit"), PipelineConfig(star=StarConfig(reschedule=True)))
    p.run_batch(read_raw(spark, str(d1), AIRLINE_COLUMNS), "b1", "2024-02-01 00:00:00", "2024-02-01")
    p.run_batch(read_raw(spark, str(d2), AIRLINE_COLUMNS), "b2", "2024-02-02 00:00:00", "2024-02-02")

    together = {}
    for r in p.vt.commits().collect():
        together.setdefault(r.batch_id, set()).add(r.table_name)
    assert set(together) == {f"{layer}:b{i}" for layer in ("bronze", "silver", "gold") for i in (1, 2)}
    assert together["silver:b2"] == {"silver", "audit_log"} and {"fact_flight_data", "audit_log"} <= together["gold:b2"]
    log = [(r.id, r.proc_name, r.affected_rows, r.status) for r in p.audit_log().orderBy("id").collect()]
    assert log == [(1, "load_silver", 3, "SUCCESS"), (2, "load_gold", 3, "SUCCESS"),
                   (3, "load_silver", 1, "SUCCESS"), (4, "load_gold", 1, "SUCCESS")]

    fact = p.table("fact_flight_data")
    assert fact.count() == 3  # matched by passenger and airport: the later date updates the row
    moved = fact.filter("original_departure_date <> current_departure_date").collect()
    assert [(str(r.original_departure_date), str(r.current_departure_date)) for r in moved] == [("2022-03-09", "2022-04-01")]

    assert p.table("fact_flight_data", role="AIRLINE_ROLE").count() == 3
    assert p.table("fact_flight_data", role="DATA_ANALYST").count() == 0  # let through by the policy, not granted the layer
    gold = [("DATA_ANALYST", "gold"), ("PUBLIC", "gold")]
    assert p.table("fact_flight_data", role="DATA_ANALYST", grants=gold).count() == 3
    assert p.table("fact_flight_data", role="PUBLIC", grants=gold).count() == 0  # granted, not let through
    assert p.table("dim_passenger", role="PUBLIC", grants=gold).count() == 3
    assert p.table("silver", role="PUBLIC", grants=gold).count() == 0
