"""Only hot series are split; tied times are split by the key."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.functions.exprs import order_micros
from strainmeter.operators import windows as W
from strainmeter.operators.features import feature_table
from strainmeter.operators.monitor import failure_label, sustained_alerts
from strainmeter.operators.ranking import ranked
from strainmeter.fixtures import fixture_score


def _rows(df):
    return df.orderBy(S.KEY).toPandas().reset_index(drop=True)


def _hot(metrics):
    return metrics.withColumn(S.HOST, F.when(F.col(S.KEY) % 3 == 0, F.lit(0)).otherwise(F.col(S.KEY) % 200 + 1))


def test_a_fleet_without_a_hot_host_is_not_split(spark, metrics_small):
    fleet = metrics_small.withColumn(S.HOST, F.col(S.KEY) % 200)
    assert [n for _, n in W.by_series_size(fleet, [S.HOST], 50)] == [None]
    plan = feature_table(fleet, rows_per_bucket=50)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "Generate" not in plan


def test_only_the_hot_host_is_split(spark, metrics_small):
    m = _hot(metrics_small)
    (rest, whole), (hot, bound) = W.by_series_size(m, [S.HOST], 50)
    assert whole is None and bound == 50
    assert hot.select(S.HOST).distinct().count() == 1 and rest.filter(F.col(S.HOST) == 0).count() == 0
    assert rest.count() + hot.count() == m.count()
    pd.testing.assert_frame_equal(_rows(feature_table(m, rows_per_bucket=50)), _rows(feature_table(m, n_buckets=1)), check_exact=False, rtol=1e-12)


def test_null_series_is_kept(spark, metrics_small):
    m = _hot(metrics_small).withColumn(S.HOST, F.expr("CASE WHEN host_id <> 0 THEN host_id END"))
    assert sum(d.count() for d, _ in W.by_series_size(m, [S.HOST], 50)) == m.count()


@pytest.mark.parametrize("tied", ["constant", "coarse"])
def test_tied_times_spread_and_keep_values(spark, metrics_small, tied):
    at = "TIMESTAMP_NTZ'2024-01-01 00:00:00'" if tied == "constant" else "CAST(date_trunc('DAY', ts) AS TIMESTAMP_NTZ)"
    m = metrics_small.withColumn(S.TS, F.expr(at))
    n, k = m.count(), 64
    sizes = W.series_ranges(m, [], order_micros(S.TS), -(-n // k), F.col(S.KEY)).groupBy(W.BUCKET).count()
    assert sizes.agg(F.max("count")).first()[0] <= 2 * n / k + 1
    assert k / 2 <= sizes.count() <= 2 * k
    pd.testing.assert_frame_equal(_rows(feature_table(m, n_buckets=k)), _rows(feature_table(m, n_buckets=1)), check_exact=False, rtol=1e-12)
    r = ranked(m.select(S.KEY, S.TS), [S.TS, S.KEY], order_micros(S.TS), out="pos", n_buckets=k, tie=F.col(S.KEY))
    assert [x["pos"] for x in r.orderBy(S.TS, S.KEY).collect()] == list(range(1, n + 1))


def test_alerts_and_labels_of_a_hot_host(spark, metrics_small):
    m = fixture_score(_hot(metrics_small))
    a = sustained_alerts(m, above=0.5, rows_per_bucket=50)
    b = sustained_alerts(m, above=0.5, n_buckets=1)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and b.count() > 0
    la = failure_label(m, F.col("error_count") > 5, rows_per_bucket=50, out="y")
    lb = failure_label(m, F.col("error_count") > 5, n_buckets=1, out="y")
    assert sorted(map(tuple, la.select(S.KEY, "y").collect())) == sorted(map(tuple, lb.select(S.KEY, "y").collect()))


def test_ks_takes_every_shared_number(spark, metrics_small):
    from strainmeter.operators.monitor import ks_drift

    ref = metrics_small.withColumn("extra", F.rand(1))
    cur = metrics_small.withColumn("extra", F.rand(1) + 5)
    found = {r["column_name"]: r["ks_statistic"] for r in ks_drift(ref, cur).collect()}
    assert found["extra"] == 1.0 and set(S.METRIC_COLS) <= set(found)


def _sizes(df, part, bound):
    cut = W.series_ranges(df, part, order_micros(S.TS), bound, F.col(S.KEY))
    sizes = cut.groupBy(*part, W.BUCKET).agg(F.count(F.lit(1)).alias("n"), F.min(S.TS).alias("lo"), F.max(S.TS).alias("hi"), F.min(S.KEY).alias("klo"), F.max(S.KEY).alias("khi")).collect()
    # the range number follows (ts, key) in every series
    for g in {tuple(r[c] for c in part) for r in sizes}:
        own = sorted((r for r in sizes if tuple(r[c] for c in part) == g), key=lambda r: r[W.BUCKET])
        for a, b in zip(own, own[1:]):
            assert a.hi < b.lo or (a.hi == b.lo and a.lo == a.hi and b.lo == b.hi and a.khi < b.klo) or (a.hi == b.lo and (a.lo == a.hi or b.lo == b.hi))
    return sizes


def test_every_series_gets_the_ranges_its_rows_need(spark):
    """40 hosts of 250 rows, each with its own stretch of time, and one of
    2,000: no host is cut by another's times."""
    rows = spark.range(12_000).select(F.col("id").alias(S.KEY), F.when(F.col("id") < 10_000, F.floor(F.col("id") / 250)).otherwise(99).cast("long").alias(S.HOST))
    rows = rows.withColumn(S.TS, F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, event_id * 7)"))
    by_host = {}
    for r in _sizes(rows, [S.HOST], 100):
        by_host.setdefault(r[S.HOST], []).append(r.n)
    assert all(2 <= len(n) <= 4 and max(n) <= 150 for h, n in by_host.items() if h != 99)
    assert 15 <= len(by_host[99]) <= 40 and max(by_host[99]) <= 150


@pytest.mark.parametrize("times", ["day", "hot", "constant"])
def test_heavy_times_get_the_tie_ranges_their_rows_need(spark, times):
    """Keys unrelated to time: ranges made are at most twice those needed."""
    at = {"day": "id % 31 * 86400", "hot": "CASE WHEN id % 2 = 0 THEN 777777 ELSE id * 13 % 2000000 END", "constant": "5"}[times]
    rows = spark.range(10_000).select(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias(S.KEY), F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, {at})").alias(S.TS))
    sizes = _sizes(rows, [], 50)
    assert sum(r.n for r in sizes) == 10_000
    assert 100 <= len(sizes) <= 400 and max(r.n for r in sizes) <= 100


def test_deep_trees_and_labels_of_one_hot_time(spark):
    rows = spark.range(20_000).select(F.col("id").alias(S.KEY), F.lit(1).cast("long").alias(S.HOST), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, CASE WHEN id % 2 = 0 THEN 50000 ELSE id * 5 END)").alias(S.TS), (F.pmod(F.xxhash64("id"), F.lit(97)) == 0).alias("failed"))
    sizes = _sizes(rows, [S.HOST], 3)  # three levels
    assert len(sizes) >= 20_000 / 4.5 and max(r.n for r in sizes) <= 8
    a = failure_label(rows, F.col("failed"), horizon_seconds=40, rows_per_bucket=150, out="y")
    b = failure_label(rows, F.col("failed"), horizon_seconds=40, n_buckets=1, out="y")
    assert sorted(map(tuple, a.select(S.KEY, "y").collect())) == sorted(map(tuple, b.select(S.KEY, "y").collect()))
    assert 0 < b.filter("y = 1").count() < 20_000


def test_one_series_is_cut_without_a_nested_loop(spark, metrics_small):
    cut = W.series_ranges(metrics_small, [], order_micros(S.TS), 20, F.col(S.KEY))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Exchange SinglePartition" not in plan
    assert cut.count() == metrics_small.count()


def test_one_long_series_is_cut_for_every_core(spark):
    """Beyond a million rows a series without a host isn't three tasks' work;
    a short one, or one within a small bound, stays whole."""
    (_, bound), = W.by_series_size(spark.range(1_200_000), [], 2_000_000)
    assert bound == 250_000
    assert [b for _, b in W.by_series_size(spark.range(900_000), [], 2_000_000)] == [None]
    assert [b for _, b in W.by_series_size(spark.range(900), [], 50)] == [50]
