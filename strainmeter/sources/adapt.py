"""The ``events`` test table as a metric table (one sample per event).

The rule is arithmetic only, so Spark SQL and DuckDB produce the same values;
the label mimics a high failure share under stress and a low background share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from strainmeter import schema as S
from strainmeter.functions import exprs as X

N_HOSTS = 16


def events_to_metrics(events: DataFrame, n_hosts: int = N_HOSTS) -> DataFrame:
    """Map ``events(event_id, ts, user_id, event_type, value, props)`` to the
    15-column metric table (``event_id``, ``host_id`` + 13 raw columns).
    Two projections of SQL text (one JVM call per column)."""
    m = events.selectExpr(
        f"event_id AS {S.KEY}",
        f"user_id % {n_hosts} AS {S.HOST}",
        f"CAST(ts AS TIMESTAMP_NTZ) AS {S.TS}",
        "CAST((CAST(round(value * 100) AS BIGINT) * 37 + event_id * 11) % 10001 AS DOUBLE) / 100 AS cpu_usage",
        "CAST((CAST(round(value * 100) AS BIGINT) * 53 + event_id * 29) % 10001 AS DOUBLE) / 100 AS memory_usage",
        "CAST(10 AS DOUBLE) + CAST((event_id * 7919) % 8501 AS DOUBLE) / 100 AS disk_usage",
        "CAST(20 AS DOUBLE) + value AS network_latency_ms",
        "CAST(CASE WHEN event_type = 'error' THEN 6 + event_id % 10 ELSE event_id % 6 END AS INT) AS error_count",
        "CAST(100 + CAST(round(value * 100) AS BIGINT) % 5000 AS DOUBLE) AS response_time_ms",
        "CAST(1 + user_id % 100 AS INT) AS active_connections",
    )
    label = (
        "CAST(CASE WHEN ((cpu_usage > 80 OR memory_usage > 85) AND event_id % 10 < 8) OR event_id % 50 = 7"
        f" THEN 1 ELSE 0 END AS INT) AS {S.LABEL}"
    )
    m = m.selectExpr(
        "*",
        label,
        f"CAST(hour({S.TS}) AS INT) AS hour",
        f"CAST(weekday({S.TS}) AS INT) AS day_of_week",
    )
    m = m.selectExpr("*", f"{X.weekend_sql()} AS is_weekend", f"{X.business_sql()} AS is_business_hours")
    return m.select([f.name for f in S.METRICS_SCHEMA.fields])
