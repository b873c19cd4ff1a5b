"""Plan shapes that the scale design relies on, and a hot-host fixture."""

import pandas as pd
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.functions.exprs import order_micros
from strainmeter.operators.features import feature_table
from strainmeter.operators.windows import BUCKET, range_bounds, with_range_bucket


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_table_is_one_exchange_one_window(spark, metrics_small):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = _plan(feature_table(metrics_small, n_buckets=1))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("Exchange hashpartitioning") == 1
    assert p.count("Window [") == 1
    assert "props" not in p  # the JSON column is never read


def test_bucketed_features_gather_nothing_in_one_task(spark, metrics_small):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = _plan(feature_table(metrics_small, n_buckets=6))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SinglePartition" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def _hot_host(metrics):
    """One host holds every third row (more than a third of the table)."""
    return metrics.withColumn(S.HOST, F.when(F.col(S.KEY) % 3 == 0, F.lit(0)).otherwise(F.col(S.HOST)))


def test_hot_host_is_split_over_ranges(spark, metrics_small):
    m = _hot_host(metrics_small)
    n = m.count()
    hot = m.filter(F.col(S.HOST) == 0).count()
    assert hot > n / 3
    k = 10
    plan = range_bounds(m, order_micros(S.TS), k)
    per = with_range_bucket(m, order_micros(S.TS), plan).groupBy(S.HOST, BUCKET).count()
    biggest = per.agg(F.max("count")).first()[0]
    assert biggest <= 1.5 * hot / k  # the hot host's rows spread over all ranges
    a = feature_table(m, n_buckets=1).orderBy(S.KEY).toPandas()
    b = feature_table(m, n_buckets=k).orderBy(S.KEY).toPandas()
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-12)
