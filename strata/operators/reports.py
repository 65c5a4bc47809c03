"""Status report view (D-8): fact filtered to one status, left-joined to dimensions (J-6), and the same kept by changes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cdc import ACTION
from .merge import OP


@dataclass
class ReportJoin:
    dim: DataFrame
    dim_sk: str       # key column of the dimension
    fact_fk: str      # fact column joined to it
    columns: dict     # {dimension column: output name}


def _named(rows: DataFrame, joins) -> DataFrame:
    """``rows`` with the columns of the dimensions; a missing dimension row gives nulls."""
    for i, j in enumerate(joins):
        k = f"__k{i}"
        d = j.dim.select(F.col(j.dim_sk).alias(k), *[F.col(c).alias(a) for c, a in j.columns.items()])
        rows = rows.join(d, rows[j.fact_fk] == F.col(k), "left").drop(k)
    return rows


def _names(joins) -> list:
    return [a for j in joins for a in j.columns.values()]


def status_report(fact: DataFrame, status: str, joins, *, status_col: str = "flight_status",
                  fact_cols=()) -> DataFrame:
    """Rows of ``fact`` with ``status`` named through dimensions (left joins: a
    missing dimension row gives nulls, the fact row stays)."""
    return _named(fact.filter(F.col(status_col) == status), joins).select(*_names(joins), *fact_cols)


def _stored(joins, row_id: str, fact_cols) -> list:
    return list(dict.fromkeys([row_id, *(j.fact_fk for j in joins), *fact_cols]))


def report_table(fact: DataFrame, status: str, joins, row_id: str, *, status_col: str = "flight_status", fact_cols=()) -> DataFrame:
    """The report as a table to be kept by :func:`report_changes`: with the fact's row id and foreign keys."""
    return status_report(fact, status, joins, status_col=status_col, fact_cols=_stored(joins, row_id, fact_cols))


def report_changes(report: DataFrame, fact_feed: DataFrame, dim_feeds: dict, status: str, joins, row_id: str, *,
                   status_col: str = "flight_status", fact_cols=()) -> DataFrame:
    """The rows of ``report`` that a batch changes, with ``_op``, from the change feeds of its sources (B-1).

    report     the :func:`report_table` before the batch.
    fact_feed  net changes of the fact, at most one image before and one after a row.
    dim_feeds  {index of a join: net changes of its dimension}.
    joins      on the dimensions as they are after the batch.

    The view is s(F) left-joined to each D.  Its change has two parts.  Rows whose fact changed: they enter, leave or
    stay by the status of their two images, and are named anew.  Rows whose fact did not change, but a dimension row they
    refer to did (also one that came or went): the report itself has their fact columns, so the fact isn't read; they come
    out where a name is another one.  A row under both rules is one of the first.
    """
    names, stored = _names(joins), _stored(joins, row_id, fact_cols)
    held = F.coalesce(F.col(status_col) == status, F.lit(False))
    after = F.col(ACTION) == "INSERT"
    f = fact_feed.groupBy(row_id).agg(F.max(~after & held).alias("__was"), F.max(after & held).alias("__is"),
                                      F.max_by(F.struct(*[c for c in stored if c != row_id]), after).alias("__row"))
    op = F.when(F.col("__was") & F.col("__is"), "UPDATE").when(F.col("__is"), "INSERT").when(F.col("__was"), "DELETE")
    first = _named(f.select(row_id, "__row.*", op.alias(OP)).filter(f"{OP} is not null"), joins).select(*names, *stored, OP)
    if not dim_feeds:
        return first
    met, hits = report, []
    for i, feed in dim_feeds.items():
        j = joins[i]
        keys = feed.select(F.col(j.dim_sk).alias(f"__c{i}")).distinct()
        met = met.join(keys, met[j.fact_fk] == F.col(f"__c{i}"), "left")
        hits.append(F.col(f"__c{i}").isNotNull())
    met = met.filter(reduce(lambda a, b: a | b, hits)).join(fact_feed.select(row_id).distinct(), row_id, "left_anti")
    old = [F.col(a).alias(f"__old_{a}") for a in names]
    second = _named(met.select(*stored, *old), joins)
    other = ~F.struct(*names).eqNullSafe(F.struct(*[F.col(f"__old_{a}").alias(a) for a in names]))
    return first.unionByName(second.filter(other).select(*names, *stored, F.lit("UPDATE").alias(OP)))
