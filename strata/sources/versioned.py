"""Versioned tables on plain Parquet (G-3, T-1 ... T-4, B-1, B-3).

Layout under ``root`` (a directory in the shared folder)::

    <table>/attempt=ID/version=N/part-*.parquet   changed rows only: data, _row_id, _op
    commits/N/part-*.json              one row per table of batch N

The commit record is written last, by one Spark job whose output becomes
visible only when the job commits; it is at once the all-or-nothing publish
(G-3), the consumer offsets (B-3), the time-travel index (T-1) and the feed
boundary (B-1).  Each attempt at a batch writes to folders of its own, which
its commit record names; readers open only those, so what a failed attempt
left is never read.  One writer at a time; a second one raises CommitConflict.

Current state = last image per ``_row_id`` over committed versions, minus
deletes (a window with a partial top-1 before the shuffle).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from ..operators.cdc import ACTION, IS_UPDATE, diff_snapshots
from ..operators.keys import assign_keys
from ..operators.latest import latest_per_key
from ..operators.merge import observed_counts
from ..operators.touched import BUCKET

ROW_ID, OP, VERSION, ATTEMPT = "_row_id", "_op", "version", "attempt"
COMMIT_SCHEMA = ("version int, batch_id string, committed_at timestamp_ntz, table_name string, rows bigint, "
                 "schema_json string, clone_of string, clone_version int, offsets_json string, snapshot boolean, attempt string, "
                 "ops string, max_row_id bigint")
SNAPSHOT = "SNAPSHOT"


class CommitConflict(RuntimeError):
    pass


class VersionedTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._log = None

    # ---- commit log -------------------------------------------------------
    def commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.root}/commits/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # only a root without a commit is empty
                raise
            return self.spark.createDataFrame([], COMMIT_SCHEMA)

    def _entries(self) -> list:
        """The commit log as a list of small metadata rows (one per table and
        version), read once and kept until the next commit or :meth:`refresh`:
        the analogue of a table format's log replay.  It holds no table data."""
        if self._log is None:
            self._log = [r.asDict() for r in self.commits().collect()]
        return self._log

    def refresh(self) -> None:
        """Forget the cached commit log (another writer may have committed)."""
        self._log = None

    def head(self) -> int:
        """Last committed version (0 when empty)."""
        return max((e[VERSION] for e in self._entries()), default=0)

    def version_at(self, ts, before: bool = False) -> int:
        """Last version committed at or before ``ts`` (strictly before with ``before``)."""
        t = ts if isinstance(ts, dt.datetime) else dt.datetime.fromisoformat(str(ts))
        ok = [e[VERSION] for e in self._entries()
              if e["committed_at"] is not None and (e["committed_at"] < t if before else e["committed_at"] <= t)]
        return max(ok, default=0)

    def _of(self, table: str) -> list:
        return sorted((e for e in self._entries() if e["table_name"] == table), key=lambda e: e[VERSION])

    def _table_meta(self, table: str):
        es = self._of(table)
        if not es:
            raise KeyError(f"no committed table {table!r} under {self.root}")
        clone = next((e for e in es if e["clone_of"] is not None), None)
        src = (clone["clone_of"], clone["clone_version"], clone[VERSION]) if clone else (None, None, 0)
        return StructType.fromJson(json.loads(es[-1]["schema_json"])), src

    def committed_batch(self, batch_id: str):
        return next((e[VERSION] for e in self._entries() if e["batch_id"] == batch_id), None)

    def offsets(self, consumer_table: str) -> dict:
        """Offsets recorded with the last commit that wrote ``consumer_table`` (B-3)."""
        es = self._of(consumer_table)
        return json.loads(es[-1]["offsets_json"]) if es and es[-1]["offsets_json"] else {}

    def has_table(self, table: str) -> bool:
        return bool(self._of(table))

    def last_version(self, table: str) -> int:
        """Last version that wrote ``table`` (0 if none): metadata only."""
        es = self._of(table)
        return es[-1][VERSION] if es else 0

    def max_row_id(self, table: str, upto: int | None = None) -> int:
        """The largest row id that ``table`` ever had, also of rows deleted since (0 if none): metadata only."""
        es = [e for e in self._of(table) if upto is None or e[VERSION] <= upto]
        top = max((e["max_row_id"] or 0 for e in es), default=0)
        return max([top, *[self.max_row_id(e["clone_of"], e["clone_version"]) for e in es if e["clone_of"] is not None]])

    def has_changes_since(self, table: str, offset: int) -> bool:
        """B-2 from metadata alone: was ``table`` written after ``offset``?"""
        return self.last_version(table) > offset

    def commit(self, batch_id: str, writes: dict, ts, offsets: dict | None = None,
               clones: dict | None = None, fail_before_commit: bool = False, snapshots=(), then=None) -> int:
        """Publish ``writes`` {table: change rows with _row_id and _op} as one version.

        A batch id already in the log makes the call a no-op (replay after a
        crash); the version's data is written first, the commit record last.
        ``then`` gives more writes of the same commit from what those before counted, {table: {op: rows}} (G-1).
        """
        done = self.committed_batch(batch_id)
        if done is not None:
            return done
        v = self.head() + 1
        attempt = uuid.uuid4().hex  # a failed attempt's folder is never read and never used again
        meta = []
        counts = {}

        def write(name: str, df: DataFrame) -> None:
            path = f"{self.root}/{name}/{ATTEMPT}={attempt}/{VERSION}={v}"
            out, seen = observed_counts(df)
            top = Observation()
            out = out.observe(top, F.max(F.col(ROW_ID).cast("bigint")).alias("top"))
            (out.write if BUCKET not in df.columns else out.write.partitionBy(BUCKET)).parquet(path)
            counts[name] = n = seen.get
            src = (clones or {}).get(name, (None, None))
            # what the write itself saw: the feed and the next row ids need no look at the files
            ops = ",".join(x for x in ("DELETE", "INSERT", "UPDATE") if n[x]) or ("" if not n["rows"] else SNAPSHOT)
            meta.append((name, StructType(df.schema.fields).json(), src[0], src[1], attempt, n["rows"], ops, top.get["top"]))

        for name, df in writes.items():
            write(name, df)
        for name, df in (then(counts) if then else {}).items():
            write(name, df)
            writes = writes | {name: df}
        for name, (parent, pv) in (clones or {}).items():
            if name not in writes:
                schema, _ = self._table_meta(parent)
                meta.append((name, schema.json(), parent, pv, None, 0, "", None))
        if fail_before_commit:
            raise RuntimeError(f"simulated crash before commit of version {v}")
        self.refresh()
        if self.head() >= v:
            raise CommitConflict(f"version {v} was committed by another writer")
        rows = [(v, batch_id, name, sj, co, cv, json.dumps(offsets or {}), name in snapshots, at, n, ops, top)
                for name, sj, co, cv, at, n, ops, top in meta]
        rec = self.spark.createDataFrame(
            rows, "version int, batch_id string, table_name string, schema_json string, clone_of string, "
                  "clone_version int, offsets_json string, snapshot boolean, attempt string, rows bigint, ops string, max_row_id bigint")
        rec = rec.select(VERSION, "batch_id", F.lit(ts).cast("timestamp_ntz").alias("committed_at"),
                         "table_name", "rows", "schema_json",
                         "clone_of", "clone_version", "offsets_json", "snapshot", "attempt", "ops", "max_row_id")
        rec.coalesce(1).write.mode("overwrite").json(f"{self.root}/commits/{v}")
        self._log = None
        return v

    # ---- reads ------------------------------------------------------------
    def _last_snapshot(self, table: str, upto: int) -> int:
        return max((e[VERSION] for e in self._of(table) if e["snapshot"] and e[VERSION] <= upto), default=0)

    def _scan(self, table: str, lo: int, hi: int, with_base: bool = True) -> DataFrame:
        """Committed change rows of versions lo..hi (partition pruning on ``version``)."""
        schema, (parent, pv, since) = self._table_meta(table)
        full = StructType(schema.fields + [StructField(VERSION, IntegerType())])
        # only the folders that the log names: what a failed batch left behind is never part of a table
        paths = [f"{self.root}/{table}/{ATTEMPT}={e[ATTEMPT]}/{VERSION}={e[VERSION]}" for e in self._of(table)
                 if e[ATTEMPT] and lo <= e[VERSION] <= hi]
        own = (self.spark.read.schema(full).option("basePath", f"{self.root}/{table}").parquet(*paths).select(*full.names)
               if paths else self.spark.createDataFrame([], full))
        if parent is not None and with_base and hi >= since:  # before its own first version a clone is empty
            # the parent's state at the clone version, as version 0 (no data copied)
            base = self.read(parent, pv, keep_meta=True).withColumn(VERSION, F.lit(0))
            own = base.unionByName(own)
        return own

    def log(self, table: str, upto: int | None = None) -> DataFrame:
        """Committed change rows of ``table`` needed for its state at ``upto``: from
        its last snapshot (see :meth:`compact`) on; a clone without one of its own
        starts with its parent's state at the clone version, as version 0.
        Versions above the head are unfinished attempts and never read."""
        head = self.head()
        upto = head if upto is None else min(upto, head)
        snap = self._last_snapshot(table, upto)
        return self._scan(table, snap, upto, with_base=snap == 0)

    def compact(self, table: str, batch_id: str, ts) -> int:
        """Write the current state as a snapshot version: later reads scan the
        snapshot and the versions after it only."""
        cur = self.read(table).withColumn(OP, F.lit(SNAPSHOT))
        return self.commit(batch_id, {table: cur}, ts, snapshots=(table,))

    def read(self, table: str, version: int | None = None, ts=None, before: bool = False,
             keep_meta: bool = False, seconds_ago: float | None = None, now=None) -> DataFrame:
        """State of ``table`` as of a version, a commit time or an offset in seconds back from ``now`` (default: the clock) (T-1)."""
        if seconds_ago is not None:
            at = dt.datetime.now(dt.UTC).replace(tzinfo=None) if now is None else dt.datetime.fromisoformat(str(now))
            ts = at - dt.timedelta(seconds=seconds_ago)
        if ts is not None:
            version = self.version_at(ts, before)
        lg = self.log(table, version)
        # a row stays in its bucket: with it in the window's key, a filter on buckets reaches the folders
        cur = latest_per_key(lg, [c for c in (BUCKET, ROW_ID) if c in lg.columns], VERSION, [OP])
        cur = cur.filter(F.col(OP) != "DELETE")
        return cur if keep_meta else cur.drop(OP, VERSION)

    def data(self, table: str, version: int | None = None, ts=None, before: bool = False, **offset) -> DataFrame:
        """As :meth:`read` without the row id and the bucket."""
        return self.read(table, version, ts, before, **offset).drop(ROW_ID, BUCKET)

    def changes(self, table: str, from_version: int, to_version: int | None = None) -> DataFrame:
        """Net change feed of ``table`` between two versions (B-1), keyed by row id.

        Where the log says that the versions in between only inserted, their files are the feed; only
        updates and deletes need the images before them.  To a consumer from before a clone was made, all its rows are new."""
        hi = self.head() if to_version is None else min(to_version, self.head())
        _, (parent, _, since) = self._table_meta(table)
        if parent is not None and from_version < since <= hi:
            return self.read(table, hi).withColumns({ACTION: F.lit("INSERT"), IS_UPDATE: F.lit(False)})
        if all(e["ops"] in ("", "INSERT", SNAPSHOT) for e in self._of(table) if from_version < e[VERSION] <= hi):
            new = self._scan(table, from_version + 1, hi, with_base=False).filter(F.col(OP) == "INSERT")
            return new.drop(OP, VERSION).withColumns({ACTION: F.lit("INSERT"), IS_UPDATE: F.lit(False)})
        lg = self._scan(table, from_version + 1, hi, with_base=False).filter(F.col(OP) != SNAPSHOT)
        row = [c for c in (BUCKET, ROW_ID) if c in lg.columns]
        touched = lg.select(*row).distinct()
        if BUCKET in row:  # always true; a side without any condition prunes no folders of the other
            touched = touched.filter(F.col(BUCKET) >= 0)
        last = latest_per_key(lg, ROW_ID, VERSION, [OP])
        after = last.filter(F.col(OP) != "DELETE").drop(OP, VERSION)
        before = self.read(table, from_version).join(touched, row, "left_semi").select(*after.columns)
        return diff_snapshots(before, after, ROW_ID)

    # ---- DML that returns the change rows to commit -----------------------
    def new_rows(self, table: str | None, df: DataFrame, order_by) -> DataFrame:
        """INSERT rows with row ids that ``table`` never had (D-4)."""
        start = 0 if table is None else self.max_row_id(table)
        return assign_keys(df, ROW_ID, order_by, start=start).withColumn(OP, F.lit("INSERT"))

    def delete_rows(self, table: str, pred) -> DataFrame:
        """DELETE WHERE pred (null keeps the row): the delete images to commit (M-7)."""
        cur = self.read(table)
        return cur.filter(F.coalesce(pred, F.lit(False))).withColumn(OP, F.lit("DELETE"))

    def update_rows(self, table: str, set_cols: dict, where=None) -> DataFrame:
        """UPDATE SET ... [WHERE] (M-6): the after images of the updated rows."""
        cur = self.read(table)
        if where is not None:
            cur = cur.filter(F.coalesce(where, F.lit(False)))
        return cur.select(*[set_cols[c].cast(t.dataType).alias(c) if c in set_cols else F.col(c)
                            for c, t in ((f.name, f) for f in cur.schema.fields)]).withColumn(OP, F.lit("UPDATE"))
