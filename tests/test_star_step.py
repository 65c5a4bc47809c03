"""The star step: batches joined once, facts that a batch can't match left where they lie, lookups that come out reused."""

from datetime import date

import pytest
from conftest import SF, rows
from test_plans import plan

from strata.operators.fact import fact_merge
from strata.plans import q_star
from strata.plans.gold import FACT_SKS, empty_state, merge_fact
from strata.plans.testdata import STAR_CFG, star_batches, star_rows, ts

SCHEMA = ", ".join(f"{c} long" for c in FACT_SKS) + ", departure_date date, flight_status string, passenger_id long"


def looked(spark, batch):
    return spark.createDataFrame([(p, a, 1, pilot, 1, 1, d and date.fromisoformat(d), s, p) for p, a, d, pilot, s in batch], SCHEMA)


FIRST = [(1, 1, "2024-01-01", 1, "F"), (2, 1, "2024-01-05", 1, "F"), (2, 1, "2024-01-05", 2, "O"), (3, 2, None, 1, "F"), (None, 1, "2024-01-02", 1, "F")]
LATER = [(1, 1, "2024-02-01", 1, "P"), (2, 1, "2024-02-05", 1, "F"), (None, 1, "2024-02-02", 1, "F")]
MEETS = [(2, 1, "2024-01-05", 3, "P"), (4, 1, "2024-01-01", 1, "F"), (3, 2, None, 1, "F"), (None, 1, "2024-01-02", 1, "F"), (1, 1, "2024-01-09", 1, "F")]


@pytest.mark.parametrize("second", [LATER, MEETS, []])
def test_fact_step_equals_the_whole_merge(spark, tmp_path, second):
    state = empty_state(spark, star_rows(spark, SF).schema, STAR_CFG)
    fact = state["fact_flight_data"]
    keys = {"passenger_id": "passenger_id", "departure_airport_sk": "departure_airport_sk", "original_departure_date": "departure_date"}
    for i, batch in enumerate([FIRST, second]):
        b = looked(spark, batch)
        state, merged = merge_fact(state, b, STAR_CFG, ts(i), f"{tmp_path}/v{i}")
        whole = fact_merge(fact, b.distinct(), keys, "departure_date", ts(i), carry=[*FACT_SKS, "passenger_id"])
        assert rows(merged, *whole.columns) == rows(whole)
        fact = whole.drop("_op")
    assert rows(state["fact_flight_data"], *fact.columns) == rows(fact)


def test_facts_that_cannot_match_are_neither_joined_nor_written_again(spark, tmp_path):
    state = empty_state(spark, star_rows(spark, SF).schema, STAR_CFG)
    for i, batch in enumerate([FIRST, LATER]):
        state, merged = merge_fact(state, looked(spark, batch), STAR_CFG, ts(i), f"{tmp_path}/v{i}")
    merged.collect()
    assert "Join" not in plan(merged) and "Window" not in plan(merged)
    assert not list(tmp_path.glob("v*/fact_flight_data"))


def test_batches_are_joined_once(spark):
    got = star_batches(spark, SF)
    assert all("Join" not in plan(b) for b in got)
    for i, b in enumerate(got):
        assert rows(b.drop("batch")) == rows(star_rows(spark, SF, i + 1))


def test_star_lookup_reuses_its_lookups(spark):
    assert "Join" not in plan(q_star.q_star_lookup(spark, SF))
