"""Schemas and fixed values shared by features, rules, scoring and tests.

Every threshold, window length, lag, rule tier and column list lives here so
that the batch, streaming and scoring paths cannot drift apart.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names
# ---------------------------------------------------------------------------
TS = "ts"
HOST = "host_id"
KEY = "event_id"  # unique tie-break key for every ordering (time ties)
LABEL = "failure_within_hour"

METRIC_COLS = [
    "cpu_usage",
    "memory_usage",
    "disk_usage",
    "network_latency_ms",
    "error_count",
    "response_time_ms",
    "active_connections",
]
CALENDAR_COLS = ["hour", "day_of_week", "is_weekend", "is_business_hours"]

# the 13 raw columns of a metric sample, in table order (timestamp first)
RAW_COLS = [TS] + METRIC_COLS + CALENDAR_COLS + [LABEL]

METRICS_SCHEMA = T.StructType(
    [
        T.StructField(KEY, T.LongType(), True),
        T.StructField(HOST, T.LongType(), True),
        T.StructField(TS, T.TimestampNTZType(), True),
        T.StructField("cpu_usage", T.DoubleType(), True),
        T.StructField("memory_usage", T.DoubleType(), True),
        T.StructField("disk_usage", T.DoubleType(), True),
        T.StructField("network_latency_ms", T.DoubleType(), True),
        T.StructField("error_count", T.IntegerType(), True),
        T.StructField("response_time_ms", T.DoubleType(), True),
        T.StructField("active_connections", T.IntegerType(), True),
        T.StructField("hour", T.IntegerType(), True),
        T.StructField("day_of_week", T.IntegerType(), True),
        T.StructField("is_weekend", T.IntegerType(), True),
        T.StructField("is_business_hours", T.IntegerType(), True),
        T.StructField(LABEL, T.IntegerType(), True),
    ]
)

# a reading sent for scoring: the seven metrics are required, calendar optional
READING_SCHEMA = T.StructType(
    [
        T.StructField("reading_id", T.LongType(), True),
        T.StructField(HOST, T.LongType(), True),
        T.StructField(TS, T.TimestampNTZType(), True),
        T.StructField("cpu_usage", T.DoubleType(), True),
        T.StructField("memory_usage", T.DoubleType(), True),
        T.StructField("disk_usage", T.DoubleType(), True),
        T.StructField("network_latency_ms", T.DoubleType(), True),
        T.StructField("error_count", T.IntegerType(), True),
        T.StructField("response_time_ms", T.DoubleType(), True),
        T.StructField("active_connections", T.IntegerType(), True),
        T.StructField("hour", T.IntegerType(), True),
        T.StructField("day_of_week", T.IntegerType(), True),
    ]
)

PREDICTION_FIELDS = T.StructType(
    [
        T.StructField("failure_probability", T.DoubleType(), True),
        T.StructField("failure_risk", T.StringType(), True),
        T.StructField("confidence", T.DoubleType(), True),
        T.StructField("recommendations", T.ArrayType(T.StringType()), True),
        T.StructField("model_used", T.StringType(), True),
        T.StructField("timestamp", T.TimestampNTZType(), True),
    ]
)

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------

# reading validation: (column, lower bound, upper bound or None); all required
READING_BOUNDS = [
    ("cpu_usage", 0.0, 100.0),
    ("memory_usage", 0.0, 100.0),
    ("disk_usage", 0.0, 100.0),
    ("network_latency_ms", 0.0, None),
    ("error_count", 0, None),
    ("response_time_ms", 0.0, None),
    ("active_connections", 0, None),
]
# optional calendar fields: (column, lower, upper)
CALENDAR_BOUNDS = [("hour", 0, 23), ("day_of_week", 0, 6)]

# calendar flags: weekend when day_of_week >= 5 (Monday = 0);
# business hours when 9 <= hour <= 17 on a weekday
WEEKEND_FROM_DOW = 5
BUSINESS_HOUR_FIRST = 9
BUSINESS_HOUR_LAST = 17

# expected load factors of the metric rules: business 1.3, weekend 0.7,
# night (hour < 6 or hour > 22) 0.5
LOAD_BUSINESS = 1.3
LOAD_WEEKEND = 0.7
LOAD_NIGHT = 0.5
NIGHT_BEFORE_HOUR = 6
NIGHT_AFTER_HOUR = 22

# clamp ranges of the metric rules (column, lo, hi)
CLAMP_RANGES = [
    ("cpu_usage", 0.0, 100.0),
    ("memory_usage", 0.0, 100.0),
    ("disk_usage", 10.0, 95.0),
]
# lower bounds of the metric rules (column, floor)
FLOOR_BOUNDS = [
    ("response_time_ms", 50.0),
    ("error_count", 0),
    ("active_connections", 1),
]
# response adjustment: + 0.3 x latency, floor 100, x1.5 when cpu > 80,
# x1.3 when memory > 85
RESPONSE_LATENCY_SHARE = 0.3
RESPONSE_FLOOR = 100.0
RESPONSE_CPU_OVER = 80.0
RESPONSE_CPU_FACTOR = 1.5
RESPONSE_MEM_OVER = 85.0
RESPONSE_MEM_FACTOR = 1.3

# stress flags (strict >)
STRESS_FLAGS = [
    ("cpu_high", "cpu_usage", 80),
    ("memory_high", "memory_usage", 85),
    ("response_slow", "response_time_ms", 1000),
    ("errors_high", "error_count", 5),
]

# rolling windows (rows incl. current, at least one value) and lags
ROLLING_WINDOWS = [3, 5]
ROLLING_COLS = ["cpu_usage", "memory_usage", "error_count", "response_time_ms"]
LAGS = [1, 2]
LAG_COLS = ["cpu_usage", "memory_usage", "error_count"]

# risk levels, inclusive lower bounds, highest first
RISK_LEVELS = [
    (0.8, "CRITICAL"),
    (0.6, "HIGH"),
    (0.4, "MEDIUM"),
    (0.2, "LOW"),
]
RISK_FLOOR_LEVEL = "MINIMAL"

# confidence = clamp(1 - abs(p - 0.5), 0.6, 0.95), 3 digits
CONFIDENCE_LO = 0.6
CONFIDENCE_HI = 0.95
PROBABILITY_DIGITS = 4
CONFIDENCE_DIGITS = 3
CLASS_THRESHOLD = 0.5  # class 1 when p > 0.5

# recommendation rules, in output order. Urgency first (p > 0.7), then six
# two-tier metric rules with strict '>': (metric, critical above, high above,
# critical code, high code)
URGENT_ABOVE = 0.7
RULE_TIERS = [
    ("cpu_usage", 85, 75, "CPU_CRITICAL", "CPU_HIGH"),
    ("memory_usage", 90, 80, "MEMORY_CRITICAL", "MEMORY_HIGH"),
    ("error_count", 10, 5, "ERRORS_CRITICAL", "ERRORS_HIGH"),
    ("response_time_ms", 2000, 1000, "RESPONSE_CRITICAL", "RESPONSE_HIGH"),
    ("disk_usage", 90, 80, "DISK_CRITICAL", "DISK_HIGH"),
    ("network_latency_ms", 500, 200, "LATENCY_CRITICAL", "LATENCY_HIGH"),
]
URGENT_CODE = "URGENT"
HEALTHY_CODE = "HEALTHY"
# each text states its rule: metric, bound and tier, in rule order
RECOMMENDATION_TEXT = {
    URGENT_CODE: f"failure_probability > {URGENT_ABOVE}",
    **{code: f"{metric} > {bound} ({tier})" for metric, critical, high, *codes in RULE_TIERS for code, bound, tier in zip(codes, (critical, high), ("critical", "high"), strict=True)},
    HEALTHY_CODE: "no rule fired",
}

# regimes of the metric rules, checked in this order (overlaps resolve to the
# first): cascade cpu >= 80, mem >= 85, resp >= 2000; spike cpu >= 85,
# resp >= 1500; leak mem >= 88, resp >= 800; otherwise normal
REGIMES = [
    ("cascade_failure", [("cpu_usage", 80), ("memory_usage", 85), ("response_time_ms", 2000)]),
    ("cpu_spike", [("cpu_usage", 85), ("response_time_ms", 1500)]),
    ("memory_leak", [("memory_usage", 88), ("response_time_ms", 800)]),
]
REGIME_DEFAULT = "normal"

# model registry order: insertion order of the comparison (first wins ties)
MODEL_ORDER = ["random_forest", "logistic_regression", "boosted_trees"]
# scoring preference when choose='preference'
MODEL_PREFERENCE = ["boosted_trees", "random_forest", "logistic_regression"]

# promotion gate thresholds per stage
STAGE_THRESHOLDS = {"staging": 0.92, "production": 0.90}

# split parameters
TEST_SHARE = 0.2
SPLIT_SEED = 42
N_FOLDS = 5
# split key: the first 15 hex digits of md5("seed:key") as a bigint
SPLIT_DIGITS = 15

# drift
DRIFT_P_THRESHOLD = 0.05

# alerts: probability above 0.8 without a break for 5 minutes
ALERT_ABOVE = 0.8
ALERT_FOR_SECONDS = 300

# roll-up cadence and failure horizon
ROLLUP_WINDOW = "5 minutes"
FAILURE_HORIZON_SECONDS = 3600

# late rows: dropped after this bound in streams
LATE_BOUND = "10 minutes"


# ---------------------------------------------------------------------------
# Generated feature names: one place
# ---------------------------------------------------------------------------
INTERACTION_COLS = ["cpu_memory_product", "resource_pressure", "performance_ratio", "error_rate"]
STRESS_COLS = [f for f, _, _ in STRESS_FLAGS] + ["total_stress"]
CYCLIC_COLS = ["hour_sin", "hour_cos", "day_sin", "day_cos"]


def rolling_names() -> list[tuple[str, str, str, int]]:
    """(output, source, 'mean'|'max', window) in the reference's column order."""
    out = []
    for w in ROLLING_WINDOWS:
        for c in ROLLING_COLS:
            out.append((f"{c}_rolling_mean_{w}", c, "mean", w))
            out.append((f"{c}_rolling_max_{w}", c, "max", w))
    return out


def lag_names() -> list[tuple[str, str, int]]:
    """(output, source, lag) in the reference's column order."""
    return [(f"{c}_lag_{n}", c, n) for n in LAGS for c in LAG_COLS]


ROLLING_COLS_OUT = [n for n, _, _, _ in rolling_names()]
LAG_COLS_OUT = [n for n, _, _ in lag_names()]

# the feature table: 13 raw + 4 + 5 + 16 + 6 + 4 = 48 columns
FEATURE_COLS = (
    RAW_COLS + INTERACTION_COLS + STRESS_COLS + ROLLING_COLS_OUT + LAG_COLS_OUT + CYCLIC_COLS
)
# model inputs: every column but the timestamp and the label, order kept (46)
MODEL_INPUTS = [c for c in FEATURE_COLS if c not in (TS, LABEL)]

_ROLLING_RE = re.compile(r"^(?P<base>.+)_rolling_(mean|max)_\d+$")
_LAG_RE = re.compile(r"^(?P<base>.+)_lag_\d+$")


def history_base(name: str) -> str | None:
    """Source column of a rolling or lag feature name, None otherwise."""
    m = _ROLLING_RE.match(name) or _LAG_RE.match(name)
    return m.group("base") if m else None

# feature columns that hold doubles; the others are counts and flags
DOUBLE_FEATURES = (
    ["cpu_usage", "memory_usage", "disk_usage", "network_latency_ms", "response_time_ms"]
    + INTERACTION_COLS
    + ROLLING_COLS_OUT
    + LAG_COLS_OUT
    + CYCLIC_COLS
)
