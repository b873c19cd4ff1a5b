"""Derived test inputs (FIXTURES.md section 3), built from the given tables
by Spark so that their size grows with the tables. Each has the same rule in
SQL (``*_SQL``) for the second-engine check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainmeter import schema as S


def null_fixture(metrics: DataFrame) -> DataFrame:
    """Every metric NULL where event_id % 17 = 3 or event_id < 2 (leading and
    interior gaps)."""
    gap = (F.col(S.KEY) % 17 == 3) | (F.col(S.KEY) < 2)
    return metrics.withColumns({c: F.when(gap, F.lit(None)).otherwise(F.col(c)) for c in S.METRIC_COLS})


def invalid_fixture(metrics: DataFrame) -> DataFrame:
    """cpu 101 where event_id % 97 = 0, errors -1 where % 101 = 0, NULL memory
    where % 103 = 0, connections -1 where % 89 = 0."""
    k = F.col(S.KEY)
    return metrics.withColumns(
        {
            "cpu_usage": F.when(k % 97 == 0, F.lit(101.0)).otherwise(F.col("cpu_usage")),
            "error_count": F.when(k % 101 == 0, F.lit(-1)).otherwise(F.col("error_count")).cast("int"),
            "memory_usage": F.when(k % 103 == 0, F.lit(None)).otherwise(F.col("memory_usage")),
            "active_connections": F.when(k % 89 == 0, F.lit(-1)).otherwise(F.col("active_connections")).cast("int"),
        }
    )


INVALID_SQL = """invalid AS (SELECT event_id, host_id, ts,
  CASE WHEN event_id % 97 = 0 THEN 101.0 ELSE cpu_usage END AS cpu_usage,
  CASE WHEN event_id % 103 = 0 THEN NULL ELSE memory_usage END AS memory_usage,
  disk_usage, network_latency_ms,
  CAST(CASE WHEN event_id % 101 = 0 THEN -1 ELSE error_count END AS INT) AS error_count,
  response_time_ms,
  CAST(CASE WHEN event_id % 89 = 0 THEN -1 ELSE active_connections END AS INT) AS active_connections,
  hour, day_of_week, is_weekend, is_business_hours, failure_within_hour FROM metrics)"""


def fixture_score(df: DataFrame) -> DataFrame:
    """Stand-in model: p = (cpu + memory) / 200, model_used = 'fixture'."""
    return df.withColumn("failure_probability", (F.col("cpu_usage") + F.col("memory_usage")) / 200).withColumn(
        "model_used", F.lit("fixture")
    )


def fixture_model():
    """The stand-in model as a ``PipelineModel``: the same p as the positive
    class of a ``probability`` vector."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer, VectorAssembler

    p = "(cpu_usage + memory_usage) / 200"
    stages = [
        SQLTransformer(statement=f"SELECT *, 1 - {p} AS _p0, {p} AS _p1 FROM __THIS__"),
        VectorAssembler(inputCols=["_p0", "_p1"], outputCol="probability", handleInvalid="keep"),
    ]
    return PipelineModel(stages)


FIXTURE_P_SQL = "(cpu_usage + memory_usage) / 200"


SPLIT_KEY_SQL = f"CAST('0x' || substr(md5('{S.SPLIT_SEED}:' || event_id), 1, {S.SPLIT_DIGITS}) AS BIGINT)"


def drift_pair(metrics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reference = first half by event_id, current = second half with
    latency x 1.2; the cut is the middle of the id range (one aggregate)."""
    row = metrics.agg(F.min(S.KEY).alias("lo"), F.max(S.KEY).alias("hi")).first()
    mid = (row["lo"] + row["hi"] + 1) // 2
    ref = metrics.filter(F.col(S.KEY) < mid)
    cur = metrics.filter(F.col(S.KEY) >= mid).withColumn("network_latency_ms", F.col("network_latency_ms") * 1.2)
    return ref, cur


DRIFT_CUT_SQL = "(SELECT (min(event_id) + max(event_id) + 1) // 2 FROM metrics)"
