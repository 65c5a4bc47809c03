"""The layered pipeline over versioned tables: bronze -> silver -> gold (S-1).

Each layer consumes the change feed of the layer below from the offset stored
with its own last commit (B-3) and publishes all its tables, with the new
offset, as one commit (G-3).  A batch id already committed makes the step a
no-op, so a replayed micro-batch publishes once.  A successful step's SUCCESS
audit row is part of that commit (G-1), so neither is there without the other;
a failing step writes a FAILED row of its own and re-raises (G-2).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType, TimestampNTZType

from ..functions.casts import try_cast_date, try_cast_int
from ..operators.access import LAYER_GRANTS, create_policy, grants_frame, layer_access, row_access, secure_view, use_role
from ..operators.audit import AUDIT_SCHEMA, audit_failure, audit_success
from ..operators.cdc import after_images
from ..functions.rows import row_changed
from ..operators.fact import fact_merge
from ..operators.keys import assign_keys
from ..operators.latest import latest_per_key
from ..operators.reports import ReportJoin, status_report
from ..operators.merge import OP, S, T
from ..operators.touched import BUCKET, Buckets, merge_touched
from ..sources.csv import FILE, classify, good_rows, reject_rows, shape_raw, stamp
from ..session import scratch_path
from ..sources.tables import run_concurrently, write_table
from ..sources.versioned import ROW_ID, VersionedTables
from .gold import FACT_SKS, StarConfig, empty_state, fact_keys, fact_source, load_dims

# The bronze contract -- column order of the delimited files and
# the declared widths of the raw table (VARCHAR(n); unlisted columns are unbounded).
AIRLINE_COLUMNS = ["id", "passenger_id", "first_name", "last_name", "gender", "age", "nationality",
                   "airport_name", "airport_country_code", "country_name", "airport_continent", "continent",
                   "departure_date", "arrival_airport", "pilot_name", "flight_status", "ticket_type",
                   "passenger_status"]
AIRLINE_WIDTHS = {"passenger_id": 50, "first_name": 50, "last_name": 50, "gender": 10, "nationality": 50,
                  "airport_name": 100, "airport_country_code": 10, "country_name": 50,
                  "airport_continent": 50, "continent": 50, "departure_date": 50, "arrival_airport": 100,
                  "pilot_name": 100, "flight_status": 50, "ticket_type": 50, "passenger_status": 50}


@dataclass
class PipelineConfig:
    columns: list = field(default_factory=lambda: list(AIRLINE_COLUMNS))
    widths: dict = field(default_factory=lambda: dict(AIRLINE_WIDTHS))
    key: str = "passenger_id"
    drop_in_silver: tuple = ("id",)
    int_columns: tuple = ("age",)
    date_columns: tuple = ("departure_date",)
    date_formats: tuple = ("M/d/yyyy", "yyyy-MM-dd")
    tie_break: tuple = ("id",)          # total order inside one load (Q14)
    star: StarConfig = field(default_factory=StarConfig)
    run_by: str = "etl_user"
    skip_unchanged: bool = False       # literal: a matched row is rewritten even when equal (Q13)
    buckets: int = 16                  # folders of silver and the fact by a hash of the key; a batch reads those it touches


class Pipeline:
    """Bronze/silver/gold tables under one versioned root."""

    def __init__(self, spark: SparkSession, root: str, cfg: PipelineConfig | None = None):
        self.spark, self.cfg = spark, cfg or PipelineConfig()
        self.vt = VersionedTables(spark, root)
        self._audit_id = 0

    # ---- helpers -------------------------------------------------------------
    def _exists(self, table: str) -> bool:
        return self.vt.has_table(table)

    def _next_audit_id(self) -> int:
        return self.vt.max_row_id("audit_log") + 1  # the row id of a record is its id: no job

    @staticmethod
    def _audit_rows(df: DataFrame) -> dict:
        return {"audit_log": df.withColumn(ROW_ID, F.col("id")).withColumn(OP, F.lit("INSERT"))}

    def success(self, counts: dict, proc: str, ts) -> dict:
        """The SUCCESS record, to be written by the commit that publishes the data it tells of (G-1)."""
        counts = self.spark.createDataFrame([(counts["rows"],)], "affected bigint")
        return self._audit_rows(audit_success(counts, proc, self.cfg.run_by, ts, self._next_audit_id()))

    def audited(self, proc: str, batch_id: str, ts, fn):
        """Run ``fn()``, whose own commit holds its :meth:`success` record; on an exception audit FAILED, then re-raise."""
        try:
            return fn()
        except Exception as e:
            audit_id = self._next_audit_id()  # each failure is a record of its own
            self.vt.commit(f"audit:{proc}:{batch_id}:failed:{audit_id}", self._audit_rows(audit_failure(
                self.spark, proc, self.cfg.run_by, ts, f"{type(e).__name__}: {e}", audit_id)), ts)
            raise

    # ---- bronze --------------------------------------------------------------
    def load_bronze(self, raw: DataFrame, batch_id: str, ts) -> int:
        """Append one load of raw rows (A-1 ... A-6, A-9): good rows to bronze, the
        rest to bronze_rejects, in one commit."""
        # parsed once: both steps read it twice (ranges, rows), the rejects only where a file's statistics tell of some
        cl = write_table(classify(raw, self.cfg.widths), scratch_path(self.spark, "bronze-batch"))
        good = stamp(good_rows(cl), ts)
        rej = stamp(reject_rows(cl), ts)
        writes = {"bronze": self.vt.new_rows("bronze" if self._exists("bronze") else None, good,
                                             [FILE] + list(self.cfg.tie_break) + [self.cfg.key])}
        writes["bronze_rejects"] = self.vt.new_rows(
            "bronze_rejects" if self._exists("bronze_rejects") else None, rej, [FILE, "_corrupt_record", *self.cfg.columns])  # over-width rows of a file have no raw text to order by
        return self.vt.commit(f"bronze:{batch_id}", writes, ts)

    # ---- silver --------------------------------------------------------------
    def _typed(self, df: DataFrame) -> DataFrame:
        c = self.cfg
        out = []
        for col in df.columns:
            if col in c.int_columns:
                out.append(try_cast_int(col).alias(col))
            elif col in c.date_columns:
                out.append(try_cast_date(col, c.date_formats).alias(col))
            else:
                out.append(F.col(col))
        return df.select(*out)

    def load_silver(self, batch_id: str, ts):
        """Bronze feed since the silver offset -> typed -> latest per key -> MERGE (stage 2)."""
        c = self.cfg

        def step():
            if self.vt.committed_batch(f"silver:{batch_id}") is not None:
                return None
            head = self.vt.head()
            start = self.vt.offsets("silver").get("bronze", 0)
            if not self.vt.has_changes_since("bronze", start):  # B-2 from the commit log: no job
                return None
            feed = after_images(self.vt.changes("bronze", start, head))
            if feed.limit(1).count() == 0:  # B-2 / G-4: "NO DATA"
                return None
            src = latest_per_key(feed, c.key, "_ingested_at", list(c.tie_break))
            src = self._typed(src.drop(*c.drop_in_silver, ROW_ID, "_action", "_is_update", FILE,
                                       "_corrupt_record", "_reject_reason"))
            # the batch is written: it is read twice, and its size tells whether it may be broadcast
            src = write_table(src.drop("_ingested_at"), scratch_path(self.spark, "silver-batch"))
            cols = src.columns
            buckets = Buckets((c.key,), c.buckets)
            if self._exists("silver"):
                target = self.vt.read("silver")
            else:
                target = self.spark.createDataFrame(
                    [], StructType(src.schema.fields + [StructField("_last_updated", TimestampNTZType()),
                                                        StructField(ROW_ID, LongType()), StructField(BUCKET, IntegerType())]))
            now = F.lit(ts).cast("timestamp_ntz")
            upd_if = None
            if c.skip_unchanged:
                upd_if = row_changed([T(x) for x in cols if x != c.key], [S(x) for x in cols if x != c.key])
            merged = merge_touched(target, src, c.key, buckets=buckets, update_if=upd_if, source_unique=True,
                                   set_on_update={"_last_updated": now}, set_on_insert={"_last_updated": now})
            upd = merged.filter(F.col(OP) == "UPDATE")
            ins = merged.filter(F.col(OP) == "INSERT").drop(ROW_ID)
            ins = assign_keys(ins, ROW_ID, c.key, start=self.vt.max_row_id("silver"))
            return self.vt.commit(f"silver:{batch_id}", {"silver": upd.unionByName(ins)}, ts, offsets={"bronze": head},
                                  then=lambda counts: self.success(counts["silver"], "load_silver", ts))

        return self.audited("load_silver", batch_id, ts, step)

    # ---- gold ----------------------------------------------------------------
    def _gold_state(self, batch_schema) -> dict:
        base = empty_state(self.spark, batch_schema, self.cfg.star)
        out = {}
        for name, empty in base.items():
            out[name] = self.vt.read(name).drop(ROW_ID) if self._exists(name) else empty
        if self._exists("fact_flight_data"):
            out["fact_flight_data"] = self.vt.read("fact_flight_data")
        else:
            out["fact_flight_data"] = base["fact_flight_data"].withColumns({ROW_ID: F.lit(None).cast("bigint"), BUCKET: F.lit(0)})
        return out

    def load_gold(self, batch_id: str, ts, run_date):
        """Silver feed since the gold offset -> six dimensions -> fact, one commit (stage 3)."""
        c, sc = self.cfg, self.cfg.star

        def step():
            if self.vt.committed_batch(f"gold:{batch_id}") is not None:
                return None
            head = self.vt.head()
            start = self.vt.offsets("fact_flight_data").get("silver", 0)
            if not self.vt.has_changes_since("silver", start):  # B-2 from the commit log: no job
                return None
            batch = after_images(self.vt.changes("silver", start, head)).drop(BUCKET).persist()
            try:
                if batch.limit(1).count() == 0:
                    return None
                state = self._gold_state(batch.schema)
                rd = F.lit(run_date).cast("date")
                dims = {k: v for k, v in state.items() if k.startswith("dim_")}
                # a dimension's row id is its key, so the log knows the largest
                starts = {k: self.vt.max_row_id(k) if self._exists(k) else 0 for k in dims}
                changed = load_dims(dims, batch, sc, rd, changes_only=True, starts=starts)
                # fixed before the fact reads them (checkpoint in the shared folder)
                dim_changes = run_concurrently({k: (lambda v=v: v.checkpoint(eager=True))
                                                for k, v in changed.items() if k.startswith("dim_")})
                # new dimension states for the fact lookups: old rows overlaid with the changes
                new_state = dict(state)
                for name, ch in dim_changes.items():
                    sk = [x for x in ch.columns if x.endswith("_sk")][0]
                    new_state[name] = (state[name].join(ch.select(sk), sk, "left_anti")
                                       .unionByName(ch.drop(OP)))
                src = fact_source(new_state, batch, sc).distinct()
                rows, keys, unique = fact_keys(src, sc)
                rows = write_table(rows, scratch_path(self.spark, "fact-batch"))
                merged = fact_merge(state["fact_flight_data"], rows, keys, sc.date_col, ts,
                                    carry=FACT_SKS + [sc.passenger_key], status_col=sc.flight_status, source_unique=unique,
                                    touched_only=True, buckets=Buckets((sc.passenger_key,), c.buckets))
                upd = merged.filter(F.col(OP) == "UPDATE")
                ins = assign_keys(merged.filter(F.col(OP) == "INSERT").drop(ROW_ID), ROW_ID,
                                  ["passenger_sk", "departure_airport_sk", "original_departure_date",
                                   "arrival_airport_sk", "pilot_sk", "ticket_sk", "pass_status_sk",
                                   sc.flight_status],
                                  start=self.vt.max_row_id("fact_flight_data"))
                writes = {k: v.withColumn(ROW_ID, F.col([x for x in v.columns if x.endswith("_sk")][0]))
                          for k, v in dim_changes.items()}
                writes["fact_flight_data"] = upd.unionByName(ins)
                return self.vt.commit(f"gold:{batch_id}", writes, ts, offsets={"silver": head},
                                      then=lambda counts: self.success(counts["fact_flight_data"], "load_gold", ts))
            finally:
                batch.unpersist()

        return self.audited("load_gold", batch_id, ts, step)

    def run_batch(self, raw: DataFrame, batch_id: str, ts, run_date):
        """Bronze, silver, gold in order for one arrival of files."""
        self.load_bronze(raw, batch_id, ts)
        self.load_silver(batch_id, ts)
        self.load_gold(batch_id, ts, run_date)

    def report(self, status: str = "Delayed") -> DataFrame:
        """The status report (D-8) over the pipeline's own tables, each key joined to its own dimension."""
        sc = self.cfg.star
        joins = [ReportJoin(self.vt.data("dim_airport"), "airport_sk", "departure_airport_sk",
                            {sc.airport_key: "departure_airport", **({"country_name": "country_name"} if "country_name" in sc.airport_attrs else {})}),
                 ReportJoin(self.vt.data("dim_arrival_airport"), "arrival_airport_sk", "arrival_airport_sk", {"airport_code": "arrival_airport"})]
        return status_report(self.vt.data("fact_flight_data"), status, joins, status_col=sc.flight_status,
                             fact_cols=[sc.passenger_key, "ticket_sk", "original_departure_date", "current_departure_date"])

    def secure_report(self, name: str, status: str = "Delayed") -> None:
        """Registers :meth:`report` as the view ``name`` with the row policy attached (G-7); see ``access.read_as``."""
        use_role(self.spark, "PUBLIC")
        create_policy(self.spark, f"{name}_policy")
        secure_view(self.spark, name, self.report(status), f"{name}_policy", self.cfg.star.passenger_key)

    def audit_log(self) -> DataFrame:
        if not self._exists("audit_log"):
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return self.vt.read("audit_log").drop(ROW_ID)

    def table(self, name: str, role: str | None = None, grants=LAYER_GRANTS) -> DataFrame:
        """A table's current rows; with ``role`` those that it may see: of layers granted to it (G-8), and of the
        fact what the row policy lets through as well (G-7).  Without one the job's own, unrestricted read."""
        df = self.vt.data(name)
        if role is None:
            return df
        layer = "gold" if name == "fact_flight_data" or name.startswith("dim_") else name.removesuffix("_rejects")
        df = layer_access(df, role, layer, grants_frame(self.spark, grants))
        return row_access(df, role) if name == "fact_flight_data" else df


def shape_batch(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Raw micro-batch of the file source -> the bronze contract's columns."""
    return shape_raw(df, cfg.columns)
