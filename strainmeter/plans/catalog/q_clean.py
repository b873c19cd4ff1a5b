"""Validation and cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strainmeter import oracle_sql as O
from strainmeter import schema as S
from strainmeter.fixtures import FIXTURE_P_SQL, INVALID_SQL, invalid_fixture, null_fixture
from strainmeter.functions import exprs as X
from strainmeter.operators import clean as C
from strainmeter.plans.catalog import register
from strainmeter.plans.checks import rounded
from strainmeter.sources.io import events_metrics

CLOCK = "2024-06-03 14:30:00"  # a Monday, 14h


def _violations_sql() -> str:
    parts = []
    for c, lo, hi in S.READING_BOUNDS:
        parts.append(f"CASE WHEN {c} IS NULL THEN '{c}:missing' END")
        parts.append(f"CASE WHEN {c} < {lo} THEN '{c}:below' END")
        if hi is not None:
            parts.append(f"CASE WHEN {c} > {hi} THEN '{c}:above' END")
    for c, lo, hi in S.CALENDAR_BOUNDS:
        parts.append(f"CASE WHEN {c} < {lo} THEN '{c}:below' END")
        parts.append(f"CASE WHEN {c} > {hi} THEN '{c}:above' END")
    return "concat_ws(',', " + ", ".join(parts) + ")"


@register(
    "validate_readings",
    O.with_ctes(O.METRICS_CTE, INVALID_SQL)
    + f"\nSELECT event_id, {_violations_sql()} AS violations, {_violations_sql()} = '' AS is_valid FROM invalid",
)
def q_validate_readings(spark, sf_dir):
    m = C.validate_readings(invalid_fixture(events_metrics(spark, sf_dir)))
    return m.select(S.KEY, F.array_join("violations", ",").alias("violations"), "is_valid")


@register(
    "default_calendar",
    O.with_ctes(O.METRICS_CTE)
    + f"""
SELECT event_id,
  CAST(coalesce(CASE WHEN event_id % 7 = 0 THEN NULL ELSE hour END, hour(TIMESTAMP '{CLOCK}')) AS INT) AS hour,
  CAST(coalesce(CASE WHEN event_id % 11 = 0 THEN NULL ELSE day_of_week END, isodow(TIMESTAMP '{CLOCK}') - 1) AS INT) AS day_of_week
FROM metrics""",
)
def q_default_calendar(spark, sf_dir):
    m = events_metrics(spark, sf_dir).withColumns(
        {
            "hour": F.when(F.col(S.KEY) % 7 == 0, F.lit(None)).otherwise(F.col("hour")),
            "day_of_week": F.when(F.col(S.KEY) % 11 == 0, F.lit(None)).otherwise(F.col("day_of_week")),
        }
    )
    return C.default_calendar(m, CLOCK).select(S.KEY, "hour", "day_of_week")


@register(
    "clamp_metrics",
    O.with_ctes(O.METRICS_CTE, INVALID_SQL)
    + "\nSELECT event_id, "
    + ", ".join(f"least(greatest({c}, {lo}), {hi}) AS {c}" for c, lo, hi in S.CLAMP_RANGES)
    + " FROM invalid",
)
def q_clamp_metrics(spark, sf_dir):
    m = C.clamp_metrics(invalid_fixture(events_metrics(spark, sf_dir)))
    return m.select(S.KEY, *[c for c, _, _ in S.CLAMP_RANGES])


@register(
    "floor_metrics",
    O.with_ctes(O.METRICS_CTE, INVALID_SQL)
    + "\nSELECT event_id, greatest(response_time_ms, 50.0) AS response_time_ms,"
    " CAST(greatest(error_count, 0) AS INT) AS error_count,"
    " CAST(greatest(active_connections, 1) AS INT) AS active_connections FROM invalid",
)
def q_floor_metrics(spark, sf_dir):
    m = C.floor_metrics(invalid_fixture(events_metrics(spark, sf_dir)))
    return m.select(S.KEY, *[c for c, _ in S.FLOOR_BOUNDS])


@register(
    "round_metrics",
    O.with_ctes(O.METRICS_CTE)
    + f"""
SELECT event_id,
  {O.round_even("(cpu_usage + memory_usage + disk_usage) / 3", 2)} AS resource_pressure,
  {O.round_even("network_latency_ms * 1.37", 2)} AS latency_scaled,
  {O.round_even(FIXTURE_P_SQL, 4)} AS failure_probability,
  {O.round_even(f"1 - abs({FIXTURE_P_SQL} - 0.5)", 3)} AS confidence
FROM metrics""",
)
def q_round_metrics(spark, sf_dir):
    """Half-to-even rounding on the exact binary value (Python's round):
    metrics to 2 digits, probability to 4, confidence to 3."""
    m = events_metrics(spark, sf_dir)
    p = (F.col("cpu_usage") + F.col("memory_usage")) / 200
    m = m.select(
        S.KEY,
        ((F.col("cpu_usage") + F.col("memory_usage") + F.col("disk_usage")) / 3).alias("resource_pressure"),
        (F.col("network_latency_ms") * 1.37).alias("latency_scaled"),
        p.alias("failure_probability"),
        (F.lit(1.0) - F.abs(p - 0.5)).alias("confidence"),
    )
    return C.round_metrics(
        m,
        {"resource_pressure": 2, "latency_scaled": 2, "failure_probability": S.PROBABILITY_DIGITS, "confidence": S.CONFIDENCE_DIGITS},
    )


@register(
    "adjust_response",
    O.with_ctes(O.METRICS_CTE)
    + "\nSELECT event_id, "
    + O.r(
        "greatest(response_time_ms + 0.3 * network_latency_ms, 100.0)"
        " * (CASE WHEN cpu_usage > 80 THEN CAST(1.5 AS DOUBLE) ELSE 1.0 END)"
        " * (CASE WHEN memory_usage > 85 THEN CAST(1.3 AS DOUBLE) ELSE 1.0 END)"
    )
    + " AS adjusted_response_ms FROM metrics",
)
def q_adjust_response(spark, sf_dir):
    m = C.adjust_response(events_metrics(spark, sf_dir))
    return rounded(m.select(S.KEY, "adjusted_response_ms"))


@register(
    "fill_zero",
    O.with_ctes(O.NULL_METRICS_CTE)
    + "\nSELECT event_id, "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in S.METRIC_COLS)
    + " FROM metrics_nulls",
)
def q_fill_zero(spark, sf_dir):
    m = C.fill_zero(null_fixture(events_metrics(spark, sf_dir)), S.METRIC_COLS)
    return m.select(S.KEY, *S.METRIC_COLS)


_RATIO_SQL = (
    "CASE WHEN CAST(active_connections AS DOUBLE) + 1 = 0 THEN"
    " (CASE WHEN response_time_ms > 0 THEN CAST('inf' AS DOUBLE) WHEN response_time_ms < 0 THEN CAST('-inf' AS DOUBLE) END)"
    " ELSE response_time_ms / (CAST(active_connections AS DOUBLE) + 1) END"
)


@register(
    "inf_to_zero",
    O.with_ctes(O.METRICS_CTE, INVALID_SQL, f"rt AS (SELECT event_id, {_RATIO_SQL} AS pr FROM invalid)")
    + "\nSELECT event_id, CAST(isinf(pr) AS INT) AS was_inf, "
    + O.r("CASE WHEN isinf(pr) THEN 0.0 ELSE pr END")
    + " AS performance_ratio FROM rt",
)
def q_inf_to_zero(spark, sf_dir):
    m = invalid_fixture(events_metrics(spark, sf_dir))
    pr = X.ratio("response_time_ms", "CAST(active_connections AS DOUBLE) + 1")
    m = m.select(S.KEY, pr.alias("performance_ratio"))
    m = m.withColumn("was_inf", F.col("performance_ratio").isin(float("inf"), float("-inf")).cast("int"))
    return rounded(C.inf_to_zero(m, ["performance_ratio"]))


@register(
    "nan_to_null",
    O.with_ctes(O.METRICS_CTE)
    + "\nSELECT host_id, "
    + O.r("avg(CASE WHEN event_id % 19 = 0 THEN NULL ELSE cpu_usage END)")
    + " AS cpu_mean, CAST(count(CASE WHEN event_id % 19 = 0 THEN NULL ELSE cpu_usage END) AS BIGINT) AS cpu_n"
    " FROM metrics GROUP BY host_id",
)
def q_nan_to_null(spark, sf_dir):
    """NaN samples become NULL so that means skip them (pandas rule)."""
    m = events_metrics(spark, sf_dir)
    m = m.withColumn("cpu_usage", F.when(F.col(S.KEY) % 19 == 0, F.lit(float("nan"))).otherwise(F.col("cpu_usage")))
    m = C.nan_to_null(m, ["cpu_usage"])
    return rounded(m.groupBy(S.HOST).agg(F.avg("cpu_usage").alias("cpu_mean"), F.count("cpu_usage").alias("cpu_n")))


def _regime_sql() -> str:
    parts = []
    for name, conds in S.REGIMES:
        pred = " AND ".join(f"{c} >= {lo}" for c, lo in conds)
        parts.append(f"WHEN {pred} THEN '{name}'")
    return "CASE " + " ".join(parts) + f" ELSE '{S.REGIME_DEFAULT}' END"


@register("regime_tag", O.with_ctes(O.METRICS_CTE) + f"\nSELECT event_id, {_regime_sql()} AS regime FROM metrics")
def q_regime_tag(spark, sf_dir):
    return C.regime_tag(events_metrics(spark, sf_dir)).select(S.KEY, "regime")
