"""Gold load (the star schema): six dimensions and one fact from a batch of silver rows.

Order that must hold: dimensions before the fact (the fact looks up the keys
just assigned), SCD2 expire before insert (inside :func:`scd2`).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dims import lookup_dim, scd1, scd2
from ..operators.fact import Lookup, fact_merge, star_lookup
from ..operators.latest import latest_per_key
from ..sources.tables import run_concurrently, write_table


@dataclass
class StarConfig:
    """Column names of the batch and of the star; the airline names are the default."""
    passenger_key: str = "passenger_id"
    passenger_attrs: list = field(default_factory=lambda: [
        "first_name", "last_name", "gender", "age", "nationality"])
    airport_key: str = "airport_name"
    airport_attrs: list = field(default_factory=lambda: [
        "airport_country_code", "country_name", "airport_continent", "continent"])
    arrival_key: str = "arrival_airport"
    pilot_key: str = "pilot_name"
    ticket_key: str = "ticket_type"
    status_key: str = "passenger_status"
    date_col: str = "departure_date"
    flight_status: str = "flight_status"
    # literal ON clause of the fact MERGE; reschedule=True uses (passenger, airport) so the
    # update branch is reachable
    reschedule: bool = False
    null_keys: str = "literal"


SK = {"passenger": "passenger_sk", "airport": "airport_sk", "arrival": "arrival_airport_sk",
      "pilot": "pilot_sk", "ticket": "ticket_sk", "status": "pass_status_sk"}


def empty_state(spark, batch_schema, cfg: StarConfig) -> dict:
    """Empty gold tables whose column types follow the batch schema."""
    t = {f.name: f.dataType.simpleString() for f in batch_schema.fields}

    def mk(cols):
        # empty to the planner as well, which then leaves out joins with it
        return spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {ty}) AS `{c}`" for c, ty in cols) + " WHERE FALSE")

    return {
        "dim_passenger": mk([(SK["passenger"], "bigint"), (cfg.passenger_key, t[cfg.passenger_key])]
                            + [(a, t[a]) for a in cfg.passenger_attrs]
                            + [("effective_date", "date"), ("expiry_date", "date"), ("current_flag", "boolean")]),
        "dim_airport": mk([(SK["airport"], "bigint"), (cfg.airport_key, t[cfg.airport_key])]
                          + [(a, t[a]) for a in cfg.airport_attrs]),
        "dim_arrival_airport": mk([(SK["arrival"], "bigint"), ("airport_code", t[cfg.arrival_key])]),
        "dim_pilot": mk([(SK["pilot"], "bigint"), (cfg.pilot_key, t[cfg.pilot_key])]),
        "dim_ticket_type": mk([(SK["ticket"], "bigint"), (cfg.ticket_key, t[cfg.ticket_key])]),
        "dim_passenger_status": mk([(SK["status"], "bigint"), (cfg.status_key, t[cfg.status_key])]),
        "fact_flight_data": mk([("passenger_sk", "bigint"), ("departure_airport_sk", "bigint"),
                                ("arrival_airport_sk", "bigint"), ("pilot_sk", "bigint"),
                                ("ticket_sk", "bigint"), ("pass_status_sk", "bigint"),
                                (cfg.passenger_key, t[cfg.passenger_key]), (cfg.flight_status, t[cfg.flight_status]),
                                ("original_departure_date", "date"), ("current_departure_date", "date"),
                                ("update_count", "int"), ("last_record_update", "timestamp_ntz")]),
    }


def load_dims(state: dict, batch: DataFrame, cfg: StarConfig, run_date,
              root: str | None = None, changes_only: bool = False, starts: dict | None = None) -> dict:
    """The six dimension loads of one batch.

    They do not depend on one another, so they run as concurrent Spark jobs
    from driver threads; with ``root`` each new dimension is also written there
    (and read back) before the fact looks keys up in it.  ``changes_only``
    returns each dimension's changed rows with ``_op`` instead of its new state.
    ``starts`` are the largest keys so far by dimension, where they are known.
    """
    arr = batch.select(F.col(cfg.arrival_key).alias("airport_code"))
    def kw(name):
        return {"null_keys": cfg.null_keys, "changes_only": changes_only, "start": (starts or {}).get(name)}

    tasks = {
        "dim_airport": lambda: scd1(state["dim_airport"], batch, cfg.airport_key, cfg.airport_attrs,
                                    SK["airport"], **kw("dim_airport")),
        "dim_arrival_airport": lambda: lookup_dim(state["dim_arrival_airport"], arr, "airport_code",
                                                  SK["arrival"], **kw("dim_arrival_airport")),
        "dim_passenger": lambda: scd2(state["dim_passenger"], batch, cfg.passenger_key, cfg.passenger_attrs,
                                      run_date, SK["passenger"], **kw("dim_passenger")),
    }
    for name, key, sk in (("dim_pilot", cfg.pilot_key, SK["pilot"]),
                          ("dim_ticket_type", cfg.ticket_key, SK["ticket"]),
                          ("dim_passenger_status", cfg.status_key, SK["status"])):
        tasks[name] = (lambda name=name, key=key, sk=sk: lookup_dim(state[name], batch, key, sk, **kw(name)))
    if root is not None:
        tasks = {k: (lambda k=k, f=f: write_table(f(), f"{root}/{k}")) for k, f in tasks.items()}
    s = dict(state)
    s.update(run_concurrently(tasks))
    return s


def fact_source(state: dict, batch: DataFrame, cfg: StarConfig, keep=()) -> DataFrame:
    """Star lookups of the batch (J-1; passenger via its current SCD2 row, J-2/D-6).

    The passengers, of which there are most, come last: by then the other names are keys, and the rows that move are narrow.
    """
    lookups = [
        Lookup(state["dim_airport"], {cfg.airport_key: cfg.airport_key}, SK["airport"],
               alias="departure_airport_sk"),
        Lookup(state["dim_arrival_airport"], {cfg.arrival_key: "airport_code"}, SK["arrival"]),
        Lookup(state["dim_pilot"], {cfg.pilot_key: cfg.pilot_key}, SK["pilot"]),
        Lookup(state["dim_ticket_type"], {cfg.ticket_key: cfg.ticket_key}, SK["ticket"]),
        Lookup(state["dim_passenger_status"], {cfg.status_key: cfg.status_key}, SK["status"]),
        Lookup(state["dim_passenger"], {cfg.passenger_key: cfg.passenger_key}, SK["passenger"],
               current_only="current_flag"),
    ]
    looked = star_lookup(batch, lookups)
    return looked.select(*keep, "passenger_sk", "departure_airport_sk", "arrival_airport_sk", "pilot_sk",
                         "ticket_sk", "pass_status_sk", cfg.date_col, cfg.flight_status, cfg.passenger_key)


FACT_SKS = ["passenger_sk", "departure_airport_sk", "arrival_airport_sk", "pilot_sk", "ticket_sk",
            "pass_status_sk"]


def fact_keys(src: DataFrame, cfg: StarConfig) -> tuple[DataFrame, dict, bool]:
    """The rows to merge into the fact, the keys {fact column: source column} to match on, and whether these are unique."""
    keys = {cfg.passenger_key: cfg.passenger_key, "departure_airport_sk": "departure_airport_sk"}
    if cfg.reschedule:
        return latest_per_key(src, list(keys.values()), cfg.date_col, [cfg.flight_status] + FACT_SKS), keys, True
    # a key may come with several pilots or tickets: a matched fact row stays one row
    return src, keys | {"original_departure_date": cfg.date_col}, False


def load_fact(state: dict, batch: DataFrame | None, cfg: StarConfig, run_ts,
              src: DataFrame | None = None) -> DataFrame:
    """Fact MERGE of one batch (D-5); returns the merged fact with ``_op``.

    ``src`` may pass a (persisted) :func:`fact_source` ``.distinct()`` of the batch.
    """
    if src is None:
        src = fact_source(state, batch, cfg).distinct()
    src, keys, unique = fact_keys(src, cfg)
    return fact_merge(state["fact_flight_data"], src, keys, cfg.date_col, run_ts,
                      carry=FACT_SKS + [cfg.passenger_key], status_col=cfg.flight_status,
                      source_unique=unique)


def may_match(fact: DataFrame, src: DataFrame, keys: dict) -> Column:
    """True on the rows of ``fact`` whose keys {fact column: source column} all lie between the smallest and the largest ones of ``src``;
    no row of ``src`` matches another row (nor one with a null key).  One pass over the key columns of ``src``, a written table."""
    types = {f.name: f.dataType for f in src.schema.fields}
    ends = src.agg(*[f(c).cast("string").alias(f"{n}_{c}") for c in keys.values() for n, f in (("lo", F.min), ("hi", F.max))]).first()
    within = F.lit(True)
    for k, c in keys.items():
        within &= F.col(k).between(*[F.lit(ends[f"{n}_{c}"]).cast(types[c]) for n in ("lo", "hi")])
    return F.coalesce(within, F.lit(False))


def merge_fact(state: dict, looked: DataFrame, cfg: StarConfig, run_ts, root: str | None = None) -> tuple[dict, DataFrame]:
    """The fact step of :func:`load_gold` from the batch's star lookups (:func:`fact_source`).

    With ``root`` the distinct lookups are written.  Facts that can't match (:func:`may_match`) stay in the tables where they lie, and
    where none can, the merge only adds facts: these are read from the written lookups and not written again.
    """
    src = looked.distinct()
    if root is None:
        merged = load_fact(state, None, cfg, run_ts, src=src.persist())  # one batch's lookups: computed once
        return state | {"fact_flight_data": merged.drop("_op")}, merged
    src = write_table(src, f"{root}/fact_source")
    fact = state["fact_flight_data"]
    _, keys, unique = fact_keys(src, cfg)
    rest = None
    if not fact.isEmpty():
        near = may_match(fact, src, keys)
        rest, fact = fact.filter(~near), fact.filter(near)
    grows = fact.isEmpty()
    if grows:
        fact = fact.limit(0)  # empty to the planner as well
    merged = load_fact(state | {"fact_flight_data": fact}, None, cfg, run_ts, src=src)
    if unique or not grows:
        merged = write_table(merged, f"{root}/fact_flight_data")
    if rest is not None:
        merged = rest.withColumn("_op", F.lit(None).cast("string")).unionByName(merged)
    return state | {"fact_flight_data": merged.drop("_op")}, merged


def load_gold(state: dict, batch: DataFrame, cfg: StarConfig, run_ts, run_date,
              root: str | None = None) -> tuple[dict, DataFrame]:
    """One gold batch: the batch's INSERT images -> six dimensions -> fact.

    Returns the new state (fact without ``_op``) and the merged fact with ``_op``
    (its counts are the affected rows of the audit record).  With ``root`` every
    table of the new state is, or is read from, written tables under it and the state's own.
    """
    s = load_dims(state, batch, cfg, run_date, root)
    return merge_fact(s, fact_source(s, batch, cfg), cfg, run_ts, root)
