"""The date layout of a column, decided by all of its values (P-4).

A value such as 3/4/2022 doesn't tell whether the day or the month comes first, and trying layouts in a fixed order reads half
of a day-first column wrongly and the rest not at all.  One aggregation collects evidence over the whole column: how many
values each layout can read, and how many have a first or a second part above 12, which only one order of day and
month can have.  The cast then uses the column's own order; year-first values can be read in any column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH_FIRST, DAY_FIRST = "month first", "day first"
# Layouts of either order and those that need no decision.
ORDERED = {MONTH_FIRST: ("M/d/yyyy", "M-d-yyyy", "M.d.yyyy"), DAY_FIRST: ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy")}
YEAR_FIRST = ("yyyy-M-d", "yyyy/M/d", "yyyy.M.d")
_TWO_PARTS = r"^(\d{1,2})[/.-](\d{1,2})[/.-]\d{4}$"


def _read(s: Column, layouts) -> Column:
    return F.coalesce(*[F.try_to_date(s, x) for x in layouts])


def date_evidence(df: DataFrame, columns) -> DataFrame:
    """A row for each of ``columns``: ``column_name``, ``filled`` (not null or blank), ``year_first``, ``month_first`` and ``day_first`` (values
    that these layouts read), ``first_over_12`` and ``second_over_12``, ``unread`` (by any) and the ``layout`` that follows.

    The order of day and month is the one that parts above 12 speak for; where they speak for both, the one that reads more
    values; without any, month first, as the pipeline's own files have it.  One pass with map-side sums, whatever the number of columns.
    """
    def counts(c: str) -> Column:
        s = F.trim(F.col(c))
        part = lambda i: F.regexp_extract(s, _TWO_PARTS, i).try_cast("int")
        month, day, year = (_read(s, x).isNotNull() for x in (ORDERED[MONTH_FIRST], ORDERED[DAY_FIRST], YEAR_FIRST))
        n = {"filled": s != "", "year_first": year, "month_first": month, "day_first": day, "first_over_12": part(1) > 12, "second_over_12": part(2) > 12,
             "unread": (s != "") & ~(month | day | year)}
        return F.struct(F.lit(c).alias("column_name"), *[F.count_if(x).alias(k) for k, x in n.items()])

    rows = df.agg(F.array(*[counts(c) for c in columns]).alias("__e")).select(F.inline("__e"))
    one_sided = (F.col("first_over_12") > 0) != (F.col("second_over_12") > 0)
    day = F.when(one_sided, F.col("first_over_12") > 0).otherwise(F.col("day_first") > F.col("month_first"))
    return rows.withColumn("layout", F.when(day, DAY_FIRST).otherwise(MONTH_FIRST))


def cast_dates(df: DataFrame, columns) -> DataFrame:
    """``df`` with ``columns`` cast to dates, each in the layout that :func:`date_evidence` finds; what it can't read becomes null."""
    layouts = {r["column_name"]: r["layout"] for r in date_evidence(df, columns).collect()}  # a row a column
    return df.withColumns({c: _read(F.trim(F.col(c)), ORDERED[layouts[c]] + YEAR_FIRST) for c in columns})
