"""The airline pipeline on files of our own: two deliveries with repeats, changes and bad rows, counted by plain Python."""

import csv

from conftest import rows
from strata.operators.access import read_as
from strata.plans.pipeline import AIRLINE_COLUMNS, Pipeline
from strata.sources.csv import read_raw

STATUSES = ["Delayed", "On Time", "Cancelled"]


def line(i, passenger, day=1, **changes):
    row = {"id": str(i), "passenger_id": f"P{passenger}", "first_name": f"Zoë{passenger % 9}", "last_name": "De'Vere - Hunt", "gender": "Female", "age": str(20 + passenger % 50),
           "nationality": "Perú", "airport_name": f"Airport {passenger % 13}", "airport_country_code": "IR", "country_name": "Iran, Islamic Republic of",
           "airport_continent": "AS", "continent": "Asia", "departure_date": f"{1 + passenger % 12}/{day}/2022", "arrival_airport": f"A{passenger % 7}",
           "pilot_name": f"Pilot {passenger % 11}", "flight_status": STATUSES[passenger % 3], "ticket_type": "Business", "passenger_status": "On Time"} | changes
    return [row[c] for c in AIRLINE_COLUMNS]


FIRST = [line(100 + i, i) for i in range(60)] + [line(300, 7), line(301, 8, pilot_name="Pilot 99"), line(302, 70, age="12.7", departure_date="13/40/2022"), line(303, 71, age="NULL")]
BAD = [["1", "2"], [*line(400, 80), "one too many"], line(401, 81, gender="far too long a word")]
SECOND = [line(500 + i, i, day=9) for i in range(50, 66)] + [line(520, 3, nationality="Chile")]


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(["", *AIRLINE_COLUMNS[1:]])
        w.writerows(lines)


def test_two_deliveries(spark, tmp_path):
    write(tmp_path / "a", "one.csv", FIRST[:30])
    write(tmp_path / "a", "two.csv", FIRST[30:] + BAD)
    write(tmp_path / "b", "three.csv", SECOND)
    p = Pipeline(spark, str(tmp_path / "tables"))
    raw = [read_raw(spark, str(tmp_path / x), AIRLINE_COLUMNS) for x in "ab"]
    p.run_batch(raw[0], "b1", "2024-02-01 00:00:00", "2024-02-01")
    p.run_batch(raw[1], "b2", "2024-02-02 00:00:00", "2024-02-02")

    def latest(lines):
        out = {}
        for r in sorted(lines, key=lambda r: r[0]):
            out[r[1]] = dict(zip(AIRLINE_COLUMNS, r, strict=True))
        return out

    one, two = latest(FIRST), latest(SECOND)
    silver = one | two
    both = [*one.values(), *two.values()]
    flight = lambda r: (r["passenger_id"], r["airport_name"], r["departure_date"])
    new = [r for r in two.values() if flight(r) not in {flight(x) for x in one.values()}]
    facts = [*one.values(), *new]  # another date is another flight (Q1)
    counts = {t: p.table(t).count() for t in ["bronze", "bronze_rejects", "silver", "dim_passenger", "dim_airport", "dim_arrival_airport", "dim_pilot",
                                              "dim_ticket_type", "dim_passenger_status", "fact_flight_data"]}
    assert counts == {"bronze": len(FIRST) + len(SECOND), "bronze_rejects": len(BAD), "silver": len(silver),
                      "dim_passenger": len(silver) + 1, "dim_airport": len({r["airport_name"] for r in both}),
                      "dim_arrival_airport": len({r["arrival_airport"] for r in both}), "dim_pilot": len({r["pilot_name"] for r in both}),
                      "dim_ticket_type": 1, "dim_passenger_status": 1, "fact_flight_data": len(facts)}
    assert rows(p.table("silver"), "passenger_id", "pilot_name") == sorted((k, r["pilot_name"]) for k, r in silver.items())
    odd = {r["passenger_id"]: (r["age"], r["departure_date"]) for r in p.table("silver").filter("passenger_id in ('P70', 'P71')").collect()}
    assert odd["P70"] == (13, None) and odd["P71"][0] is None and str(odd["P71"][1]) == "2022-12-01"
    changed = p.table("dim_passenger").filter("passenger_id = 'P3'")
    assert rows(changed, "nationality", "current_flag") == [("Chile", True), ("Perú", False)]
    # the same flight again: the fact is not written anew and keeps the version that was current when it was (D-6)
    assert rows(p.table("fact_flight_data").filter("passenger_id = 'P3'").join(changed, "passenger_sk"), "nationality") == [("Perú",)]

    # the audit counts what the silver and the fact writes saw
    audit = rows(p.audit_log().filter("status = 'SUCCESS'"), "proc_name", "affected_rows")
    assert audit == sorted([("load_silver", len(one)), ("load_silver", len(two)), ("load_gold", len(one)), ("load_gold", len(new))], key=str)

    # the report, and the same as a view with the row policy
    delayed = [r for r in facts if r["flight_status"] == "Delayed"]
    assert rows(p.report(), "passenger_id", "departure_airport", "arrival_airport") == sorted((r["passenger_id"], r["airport_name"], r["arrival_airport"]) for r in delayed)
    p.secure_report("delayed_flights")
    assert read_as(spark, "delayed_flights", "DATA_ANALYST").count() == len(delayed)
    assert read_as(spark, "delayed_flights", "PUBLIC").count() == 0

    # replaying a batch publishes nothing new
    head = p.vt.head()
    p.run_batch(raw[1], "b2", "2024-02-02 00:00:00", "2024-02-02")
    assert p.vt.head() == head
