"""DuckDB SQL twins of the registered queries (second-engine checks).

The SQL is generated from the same constants as the Spark code (schema.py),
so thresholds and names cannot drift apart. Computed doubles are rounded to
6 digits on both sides (sums and sin differ in the last bits between engines).
"""

from __future__ import annotations

from strainmeter import schema as S

DIGITS = 6

# the metric table from the events test table (same rule as sources/adapt.py)
METRICS_CTE = """
e AS (SELECT *, CAST(round(value*100) AS BIGINT) AS cents FROM events),
m0 AS (SELECT event_id, user_id % 16 AS host_id, CAST(ts AS TIMESTAMP) AS ts,
  CAST((cents*37 + event_id*11) % 10001 AS DOUBLE)/100 AS cpu_usage,
  CAST((cents*53 + event_id*29) % 10001 AS DOUBLE)/100 AS memory_usage,
  10 + CAST((event_id*7919) % 8501 AS DOUBLE)/100 AS disk_usage,
  20 + value AS network_latency_ms,
  CAST(CASE WHEN event_type='error' THEN 6 + event_id%10 ELSE event_id%6 END AS INT) AS error_count,
  CAST(100 + cents%5000 AS DOUBLE) AS response_time_ms,
  CAST(1 + user_id%100 AS INT) AS active_connections FROM e),
metrics AS (SELECT event_id, host_id, ts, cpu_usage, memory_usage, disk_usage, network_latency_ms,
  error_count, response_time_ms, active_connections,
  CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) - 1 AS INT) AS day_of_week,
  CAST(isodow(ts) - 1 >= 5 AS INT) AS is_weekend,
  CAST(hour(ts) BETWEEN 9 AND 17 AND isodow(ts) - 1 < 5 AS INT) AS is_business_hours,
  CAST(CASE WHEN ((cpu_usage>80 OR memory_usage>85) AND event_id%10<8) OR event_id%50=7 THEN 1 ELSE 0 END AS INT)
    AS failure_within_hour
  FROM m0)"""

# null fixture: every metric NULL where event_id % 17 = 3 or event_id < 2
NULL_METRICS_CTE = (
    METRICS_CTE
    + """,
metrics_nulls AS (SELECT event_id, host_id, ts, """
    + ", ".join(f"CASE WHEN event_id % 17 = 3 OR event_id < 2 THEN NULL ELSE {c} END AS {c}" for c in S.METRIC_COLS)
    + """, hour, day_of_week, is_weekend, is_business_hours, failure_within_hour FROM metrics)"""
)

METRIC_TABLE_COLS = [S.KEY, S.HOST, S.TS] + S.METRIC_COLS + S.CALENDAR_COLS + [S.LABEL]


def r(expr: str, digits: int = DIGITS) -> str:
    # + 0.0 turns a rounded -0.0 into 0.0 (Spark's round never yields -0.0)
    return f"(round({expr}, {digits}) + 0.0)"


def round_even(expr: str, digits: int) -> str:
    """Python's round(x, digits) on doubles (exact half-to-even), the same
    Dekker product as functions/exprs.round_even."""
    sc = f"CAST({float(10**digits)!r} AS DOUBLE)"
    x = f"CAST({expr} AS DOUBLE)"
    hi = f"({x} * {sc})"
    t = f"({x} * CAST(134217729.0 AS DOUBLE))"
    xh = f"({t} - ({t} - {x}))"
    xl = f"({x} - {xh})"
    lo = f"(({xh} * {sc} - {hi}) + {xl} * {sc})"
    fl = f"CAST(floor({hi}) AS DOUBLE)"
    frac = f"({hi} - {fl})"
    r = (
        f"(CASE WHEN {frac} > 0.5 THEN {fl} + 1 WHEN {frac} < 0.5 THEN {fl} WHEN {lo} > 0 THEN {fl} + 1"
        f" WHEN {lo} < 0 THEN {fl} WHEN {fl} % 2 = 0 THEN {fl} ELSE {fl} + 1 END)"
    )
    return f"({r} / {sc})"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes if c.strip())


def _flag(pred: str) -> str:
    return f"CAST(coalesce({pred}, false) AS INT)"


def row_local_sql(src: str) -> str:
    """Interaction, stress and cyclic columns over relation ``src``."""
    conn1 = "(CAST(active_connections AS DOUBLE) + 1)"
    stress = [f"{_flag(f'{c} > {t}')} AS {n}" for n, c, t in S.STRESS_FLAGS]
    total = " + ".join(_flag(f"{c} > {t}") for _, c, t in S.STRESS_FLAGS)
    return f"""SELECT *,
  cpu_usage * memory_usage AS cpu_memory_product,
  (cpu_usage + memory_usage + disk_usage) / 3 AS resource_pressure,
  response_time_ms / {conn1} AS performance_ratio,
  CAST(error_count AS DOUBLE) / {conn1} AS error_rate,
  {", ".join(stress)}, {total} AS total_stress,
  sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos,
  sin(2 * pi() * day_of_week / 7) AS day_sin, cos(2 * pi() * day_of_week / 7) AS day_cos
FROM {src}"""


def feature_sql(src: str = "metrics", part: str = "host_id", order: str = "ts, event_id", extra_ctes: str = METRICS_CTE) -> str:
    """The feature table over relation ``src`` (rounded doubles)."""
    w = f"PARTITION BY {part} ORDER BY {order}" if part else f"ORDER BY {order}"
    roll = []
    for name, c, how, n in S.rolling_names():
        fn = "avg" if how == "mean" else "max"
        val = f"CAST({fn}({c}) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS DOUBLE)"
        last = f"CAST(last_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)"
        roll.append(f"coalesce({val}, {last}) AS {name}")
    lags = [
        f"coalesce(CAST(lag({c}, {n}) OVER ({w}) AS DOUBLE), (SELECT avg({c}) FROM {src})) AS {name}" for name, c, n in S.lag_names()
    ]
    keep = [S.KEY, S.HOST] if part else [S.KEY]
    never = set(S.STRESS_COLS) | set(keep) | {S.LABEL}
    local_cols = METRIC_TABLE_COLS + S.INTERACTION_COLS + S.STRESS_COLS + S.CYCLIC_COLS
    ff = []
    for c in local_cols:
        if c in (S.KEY, S.HOST) and c not in keep:
            continue
        if c in never:
            ff.append(c)
        else:
            ff.append(f"last_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}")
    body = f"""SELECT {", ".join(ff)}, {", ".join(roll)}, {", ".join(lags)} FROM loc"""
    out_cols = []
    for c in keep + S.FEATURE_COLS:
        if c == S.TS:
            out_cols.append(c)
        elif c in S.DOUBLE_FEATURES:
            out_cols.append(f"{r(f'coalesce({c}, 0)')} AS {c}")
        else:
            out_cols.append(f"coalesce({c}, 0) AS {c}")
    return with_ctes(extra_ctes, f"loc AS ({row_local_sql(src)})", f"feat AS ({body})") + f"\nSELECT {', '.join(out_cols)} FROM feat"
