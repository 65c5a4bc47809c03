"""The point-in-time lookup against a plain comparison with every version of the key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows, srt
from strata.operators.asof import point_in_time_lookup
from test_plans import plan

D = dt.date(2024, 1, 1)


def made(seed):
    rng = random.Random(seed)
    versions, facts = [], []
    for k in range(12):
        day, sk = rng.randrange(60), k * 100
        for _ in range(rng.randrange(9)):
            length = rng.choice([0, 1, 3, 20, 70])
            gap = rng.choice([0, 0, 0, 5])
            versions.append((sk, k, D + dt.timedelta(day), D + dt.timedelta(day + length), f"v{sk}"))
            day, sk = day + length + gap, sk + 1
        if rng.random() < 0.7:
            versions.append((sk, k, D + dt.timedelta(day), None, f"v{sk}"))
    for i in range(600):
        facts.append((i, rng.choice([0] * 8 + list(range(14)) + [None]), D + dt.timedelta(rng.randrange(-40, 400)) if rng.random() < 0.97 else None))
    return versions, facts + facts[:5] + [(-1, 0, D)]


def expected(versions, facts):
    out = []
    for i, k, d in facts:
        hit = [(sk, n) for sk, vk, e, x, n in versions if k == vk and d is not None and e <= d and (x is None or d < x)]
        assert len(hit) <= 1
        out.append((i, k, d, *(hit[0] if hit else (None, None))))
    return srt(out)


@pytest.mark.parametrize("seed, days", [(1, 28), (2, 1), (3, 400), (4, 7)])
def test_equals_plain_comparison(spark, seed, days):
    versions, facts = made(seed)
    dim = spark.createDataFrame(versions, "sk bigint, id int, effective_date date, expiry_date date, name string").repartition(3)
    f = spark.createDataFrame(facts, "i int, k bigint, d date").repartition(4)
    got = point_in_time_lookup(f, dim, {"k": "id"}, "d", {"sk": "sk", "name": "who"}, days=days)
    assert got.columns == ["i", "k", "d", "sk", "who"]
    assert rows(got) == expected(versions, facts)


def test_timestamps_and_empty_sides(spark):
    dim = spark.createDataFrame([(1, 7, dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 2, 6)), (2, 7, dt.datetime(2024, 1, 2, 6), None)],
                                "sk bigint, k bigint, effective_date timestamp_ntz, expiry_date timestamp_ntz")
    f = spark.createDataFrame([(7, dt.datetime(2024, 1, d, h)) for d, h in ((1, 11), (1, 12), (2, 5), (2, 6), (9, 0))], "k bigint, t timestamp_ntz")
    got = point_in_time_lookup(f, dim, {"k": "k"}, "t", {"sk": "sk"}, days=1)
    assert [r["sk"] for r in got.orderBy("t").collect()] == [None, 1, 1, 2, 2]
    assert [r["sk"] for r in point_in_time_lookup(f, dim.limit(0), {"k": "k"}, "t", {"sk": "sk"}).collect()] == [None] * 5
    assert point_in_time_lookup(f.limit(0), dim, {"k": "k"}, "t", {"sk": "sk"}).count() == 0


def test_hot_key_is_cut_by_dates(spark):
    f = spark.range(3000).select((F.col("id") % 3 == 0).cast("bigint").alias("k"), F.expr("date_add(date'2020-01-01', cast(id % 1500 as int))").alias("d"))
    dim = spark.createDataFrame([(1, 0, D, None)], "sk bigint, k bigint, effective_date date, expiry_date date")
    out = point_in_time_lookup(f, dim, {"k": "k"}, "d", {"sk": "sk"})
    p = plan(out)
    assert "Join" not in p and "hashpartitioning(k" in p and "__range" in p, p
    assert out.filter("sk is not null").count() == f.filter("k = 0 and d >= date'2024-01-01'").count()
