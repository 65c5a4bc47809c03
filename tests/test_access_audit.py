import pytest
from pyspark.sql import functions as F

from conftest import rows, srt
from strata.operators.access import POLICY_ROLES, layer_access, row_access, row_access_by_entitlement
from strata.operators.audit import audit_success
from strata.plans.pipeline import Pipeline
from strata.session import scratch_path


def test_roles(spark):
    df = spark.createDataFrame([(1,), (2,)], "k bigint")
    for r in POLICY_ROLES:
        assert row_access(df, r).count() == 2
    assert row_access(df, "PUBLIC").count() == 0
    ent = spark.createDataFrame([("ANALYST", 1)], "role string, k bigint")
    assert rows(row_access_by_entitlement(df, "ANALYST", ent, "k")) == srt([(1,)])
    grants = spark.createDataFrame([("ANALYST", "gold")], "role string, table_name string")
    assert layer_access(df, "ANALYST", "gold", grants).count() == 2
    assert layer_access(df, "ANALYST", "silver", grants).count() == 0


def test_failure_is_audited_then_reraised(spark):
    p = Pipeline(spark, scratch_path(spark, "t-audit"))

    def boom():
        raise ValueError("bad batch")

    with pytest.raises(ValueError):
        p.audited("load_silver", "b1", "2024-01-01 00:00:00", boom)
    log = p.audit_log().collect()
    assert [(r.status, r.affected_rows, r.error_message) for r in log] == [("FAILED", 0, "ValueError: bad batch")]
    counts = spark.createDataFrame([(3,)], "affected bigint")
    assert audit_success(counts, "p", "u", "2024-01-01 00:00:00").first().message == "SUCCESS | Rows merged: 3"


def test_view_with_a_policy(spark):
    from strata.operators.access import create_policy, read_as, secure_view, use_role
    from test_plans import plan
    use_role(spark, "PUBLIC")
    create_policy(spark, "test_policy", allowed=("O'Brien", "back\\slash"), key_type="bigint")
    secure_view(spark, "test_secure", spark.range(5).withColumnRenamed("id", "passenger_id"), "test_policy", "passenger_id")
    assert spark.table("test_secure").count() == 0
    seen = read_as(spark, "test_secure", "O'Brien")
    assert seen.count() == 5 and read_as(spark, "test_secure", "back\\slash").count() == 5
    denied = read_as(spark, "test_secure", "o'brien")
    assert denied.count() == 0 and seen.count() == 5  # a plan keeps the role it was made under
    assert "LocalTableScan <empty>" in plan(denied) and "test_policy" not in plan(seen)  # inlined
    assert spark.sql("SELECT count(*) AS n FROM test_secure").first()["n"] == 0
