"""Edge cases: empty input, single-class labels, threshold-equal values."""

from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.fixtures import fixture_score
from strainmeter.operators import evaluate as EV
from strainmeter.operators import split as SP
from strainmeter.operators.features import feature_table
from strainmeter.operators.monitor import ks_drift, latency_quantile, sustained_alerts
from strainmeter.plans.score import batch_summary, score_readings


def test_empty_input_everywhere(spark, metrics_small):
    empty = metrics_small.limit(0)
    assert feature_table(empty).count() == 0
    assert feature_table(empty, n_buckets=3).count() == 0
    assert SP.stratified_split(empty).count() == 0
    assert SP.time_split(empty).count() == 0
    assert EV.roc_auc(fixture_score(empty)).first()["auc"] is None
    assert sustained_alerts(fixture_score(empty)).count() == 0
    assert latency_quantile(empty, "response_time_ms").count() == 0
    preds = score_readings(fixture_score(empty), as_of="2024-02-01 00:00:00")
    assert batch_summary(preds).count() == 0


def test_single_class(spark, metrics_small):
    one = metrics_small.withColumn(S.LABEL, F.lit(1))
    s = SP.stratified_split(one, n_buckets=3)
    n = one.count()
    assert s.filter("is_test").count() == -(-n * 2 // 10)
    conf = EV.confusion_metrics(fixture_score(one).withColumn("prediction", F.lit(0)))
    r = conf.first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["f1"] == 0.0


def test_ks_identical_samples_no_drift(spark, metrics_small):
    res = ks_drift(metrics_small, metrics_small, S.METRIC_COLS).collect()
    assert all(r["ks_statistic"] == 0.0 and r["p_value"] == 1.0 and not r["drift_detected"] for r in res)


def test_threshold_equal_probabilities(spark):
    rows = [(i, float(p)) for i, p in enumerate([0.2, 0.4, 0.6, 0.8, 0.7, 0.70000001])]
    df = spark.createDataFrame(rows, "event_id long, failure_probability double")
    for c in S.METRIC_COLS:
        df = df.withColumn(c, F.lit(0).cast("double"))
    out = {r[S.KEY]: (r["failure_risk"], r["recommendation_codes"]) for r in score_readings(df, as_of="2024-01-01 00:00:00", model_used="fixture").collect()}
    assert out[0][0] == "LOW" and out[1][0] == "MEDIUM" and out[2][0] == "HIGH" and out[3][0] == "CRITICAL"
    assert out[4][1] == ["HEALTHY"]  # 0.7 is not above 0.7
    assert out[5][1] == ["URGENT"]


def test_cluster_settings_scale_with_input():
    from strainmeter.session import cluster_settings

    big = cluster_settings(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)  # 409,600 pieces of 256 MiB
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert "spark.checkpoint.dir" not in big
    small = cluster_settings(10 << 20, 16)
    assert int(small["spark.sql.shuffle.partitions"]) == 32  # two waves of tasks at least


def test_cluster_without_shared_folder_is_refused():
    """Off a local master, no machine-local scratch folder is made up."""
    from unittest import mock

    from strainmeter.session import ensure_checkpoint_dir

    sc = mock.Mock(master="spark://head:7077")
    sc.getCheckpointDir.return_value = None
    sc.getConf.return_value.get.return_value = None
    spark = mock.Mock(sparkContext=sc)
    spark.conf.get.return_value = None
    import pytest

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(spark)
    sc.setCheckpointDir.assert_not_called()


def test_table_fingerprint_follows_rewrites(spark):
    """The model registry key changes when data is rewritten at one path."""
    from strainmeter.session import shared_path
    from strainmeter.sources.io import table_fingerprint

    path = shared_path(spark, "fp")
    spark.range(10).write.parquet(path)
    a = table_fingerprint(spark, path)
    spark.range(1000).write.mode("overwrite").parquet(path)
    b = table_fingerprint(spark, path)
    assert a != b and a.split(":")[0] != b.split(":")[0]


def test_nan_readings_are_missing(spark, metrics_small):
    from strainmeter.operators import clean as C
    from strainmeter.operators import features as FE

    nan = metrics_small.withColumn("response_time_ms", F.when(F.col(S.KEY) % 9 == 4, float("nan")).otherwise(F.col("response_time_ms")))
    nan = nan.withColumn("cpu_usage", F.when(F.col(S.KEY) % 11 == 3, float("nan")).otherwise(F.col("cpu_usage")))
    null = nan.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("response_time_ms", "cpu_usage")})
    a, b = FE.feature_table(nan), FE.feature_table(null)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    codes = {c for r in C.validate_readings(nan).select("violations").collect() for c in r["violations"]}
    assert "response_time_ms:missing" in codes and "cpu_usage:missing" in codes and "cpu_usage:above" not in codes
