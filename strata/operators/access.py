"""Row access by role (G-7) and layer entitlements (G-8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Roles the original row access policy lets see every row.
POLICY_ROLES = ("SYSADMIN", "ACCOUNTADMIN", "AIRLINE_ROLE", "DATA_ANALYST")
# Read grants per layer (role, layer) of the original set-up.
LAYER_GRANTS = (("AIRLINE_ROLE", "bronze"), ("AIRLINE_ROLE", "silver"), ("AIRLINE_ROLE", "gold"))


def grants_frame(spark, grants=LAYER_GRANTS):
    return spark.createDataFrame(list(grants), "role string, table_name string")


def role_policy(role: str, allowed=POLICY_ROLES) -> Column:
    """``CASE WHEN role IN (...) THEN TRUE ELSE FALSE END``; a literal role folds
    to a constant, so a denied role plans as an empty scan."""
    return F.when(F.lit(role).isin(*allowed), F.lit(True)).otherwise(F.lit(False))


def row_access(df: DataFrame, role: str, policy=role_policy) -> DataFrame:
    """Rows of ``df`` visible to ``role`` under ``policy(role) -> Column``."""
    return df.filter(policy(role))


def row_access_by_entitlement(df: DataFrame, role: str, entitlements: DataFrame, key: str,
                              role_col: str = "role") -> DataFrame:
    """General row-level form: ``entitlements(role, key)`` lists the keys each role
    may see; a semi join keeps the visible rows (entitlements of one role are
    de-duplicated first, so a hot role cannot fan rows out)."""
    ent = entitlements.filter(F.col(role_col) == role).select(key).distinct()
    return df.join(ent, key, "left_semi")


def entitled_tables(grants: DataFrame, role: str, role_col: str = "role", table_col: str = "table_name") -> DataFrame:
    """Tables (layers) ``role`` may read (the data part of the grants, G-8)."""
    return grants.filter(F.col(role_col) == role).select(table_col).distinct()


def layer_access(df: DataFrame, role: str, layer: str, grants: DataFrame, role_col: str = "role",
                 table_col: str = "table_name") -> DataFrame:
    """Rows of the table ``layer`` when ``role`` has a grant on it, else none.

    The grant lookup is a semi join of the data against the role's grant row
    for this layer (both sides keyed by the constant layer name), so the
    decision stays inside the plan; no driver-side branch.
    """
    g = (grants.filter((F.col(role_col) == role) & (F.col(table_col) == layer))
         .select(F.col(table_col).alias("__layer")).distinct())
    return df.withColumn("__layer", F.lit(layer)).join(g, "__layer", "left_semi").drop("__layer")


ROLE_VARIABLE = "strata_role"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_policy(spark: SparkSession, name: str, allowed=POLICY_ROLES, key_type: str = "string") -> None:
    """The row access policy as a SQL function ``name(key, role)``, which the optimizer inlines where it is called (G-7).

    As in the original, the key is an argument that the rule doesn't use: views pass it, so that a policy that does can take its place.
    """
    roles = ", ".join(_text(r) for r in allowed)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(key {key_type}, role STRING) RETURNS BOOLEAN RETURN CASE WHEN role IN ({roles}) THEN TRUE ELSE FALSE END")


def use_role(spark: SparkSession, role: str) -> None:
    """Sets the session's role, a SQL variable; views with a policy show what this role may see from now on."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE_VARIABLE} STRING DEFAULT {_text(role)}")


def secure_view(spark: SparkSession, name: str, rows: DataFrame, policy: str, key: str) -> None:
    """Registers ``rows`` as the view ``name`` with the policy attached: whoever reads the view, in SQL or as a table, reads it
    through the policy under the role of :func:`use_role` (D-8, G-7).  For a role without access the plan is an empty scan."""
    rows.createOrReplaceTempView(f"{name}_unfiltered")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT * FROM {name}_unfiltered WHERE {policy}(`{key}`, {ROLE_VARIABLE})")


def read_as(spark: SparkSession, view: str, role: str) -> DataFrame:
    """The view as ``role`` sees it; the role is part of the plan from here on, whatever role the session takes later."""
    use_role(spark, role)
    return spark.table(view)
