"""Scoring rules on the sample readings and threshold-equal values."""

import pytest
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.functions import exprs as X

READING_COLS = "name string, cpu_usage double, memory_usage double, disk_usage double, network_latency_ms double, error_count int, response_time_ms double, active_connections int"
SAMPLES = [
    ("normal", 30.0, 40.0, 25.0, 50.0, 0, 200.0, 25),
    ("critical", 95.0, 92.0, 88.0, 300.0, 15, 2500.0, 200),
    ("mixed", 85.0, 90.0, 45.0, 120.0, 5, 800.0, 150),
]


def test_sample_reading_codes(spark):
    df = spark.createDataFrame(SAMPLES, READING_COLS).withColumn("p", F.lit(0.1))
    got = {r["name"]: r["c"] for r in df.select("name", X.recommendation_codes("p").alias("c")).collect()}
    assert got["normal"] == ["HEALTHY"]
    assert got["critical"] == ["CPU_CRITICAL", "MEMORY_CRITICAL", "ERRORS_CRITICAL", "RESPONSE_CRITICAL", "DISK_HIGH", "LATENCY_HIGH"]
    assert got["mixed"] == ["CPU_HIGH", "MEMORY_HIGH"]


def test_urgent_first(spark):
    df = spark.createDataFrame(SAMPLES, READING_COLS).withColumn("p", F.lit(0.71))
    got = {r["name"]: r["c"] for r in df.select("name", X.recommendation_codes("p").alias("c")).collect()}
    assert got["normal"] == ["URGENT"]
    assert got["mixed"][0] == "URGENT"


@pytest.mark.parametrize(
    "p,risk,conf",
    [(0.8543, "CRITICAL", 0.646), (0.8, "CRITICAL", 0.7), (0.5, "MEDIUM", 0.95), (0.2, "LOW", 0.7), (0.0, "MINIMAL", 0.6),
     (0.6, "HIGH", 0.9), (0.4, "MEDIUM", 0.9), (0.7999999, "HIGH", 0.7)],
)
def test_risk_and_confidence(spark, p, risk, conf):
    r = spark.range(1).select(X.risk_level(f"CAST({p!r} AS DOUBLE)").alias("r"), X.confidence(f"CAST({p!r} AS DOUBLE)").alias("c")).first()
    assert r["r"] == risk
    assert r["c"] == pytest.approx(conf, abs=1e-12)


def test_margin_confidence(spark):
    r = spark.range(1).select(X.confidence("CAST(0.8543 AS DOUBLE)", "margin").alias("c")).first()
    assert r["c"] == pytest.approx(0.854)


def test_null_probability_has_no_risk(spark):
    r = spark.range(1).select(X.risk_level("CAST(NULL AS DOUBLE)").alias("r")).first()
    assert r["r"] is None


@pytest.mark.parametrize("col,value", [("cpu_usage", 80.0), ("memory_usage", 85.0), ("response_time_ms", 1000.0), ("error_count", 5)])
def test_stress_flags_are_strict(spark, col, value):
    base = {"cpu_usage": 10.0, "memory_usage": 10.0, "response_time_ms": 10.0, "error_count": 0}
    base[col] = value
    df = spark.createDataFrame([tuple(base.values())], "cpu_usage double, memory_usage double, response_time_ms double, error_count int")
    r = df.select(*[v.alias(k) for k, v in X.stress_exprs().items()]).first()
    assert r["total_stress"] == 0


def test_stress_flag_null_is_zero(spark):
    df = spark.createDataFrame([(None, None, None, None)], "cpu_usage double, memory_usage double, response_time_ms double, error_count int")
    r = df.select(*[v.alias(k) for k, v in X.stress_exprs().items()]).first()
    assert r["cpu_high"] == 0 and r["total_stress"] == 0


def test_round_even_matches_python(spark):
    vals = [0.12345, 0.12355, 2.675, 1.005, 0.6455, -0.12345, 0.5, 1.5, 2.5, 1e-9, 123.456789]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for d in (0, 2, 3, 4):
        got = [r[0] for r in df.select(X.round_even("x", d)).collect()]
        assert got == [round(v, d) for v in vals]


def test_feature_manifest_size():
    assert len(S.FEATURE_COLS) == 48
    assert len(S.MODEL_INPUTS) == 46
    assert S.history_base("cpu_usage_lag_2") == "cpu_usage"
    assert S.history_base("flag_x") is None
