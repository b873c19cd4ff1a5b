"""Scan and write queries: round trips through the shared folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strainmeter import oracle_sql as O
from strainmeter import schema as S
from strainmeter.fixtures import FIXTURE_P_SQL, fixture_score
from strainmeter.operators import features as FE
from strainmeter.plans.catalog import register
from strainmeter.plans.checks import rounded
from strainmeter.session import shared_path
from strainmeter.sources import io as IO

AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)
METRIC_SELECT = ", ".join(O.METRIC_TABLE_COLS)


@register("scan_metrics", O.with_ctes(O.METRICS_CTE) + f"\nSELECT {METRIC_SELECT} FROM metrics")
def q_scan_metrics(spark, sf_dir):
    """Metric table written as CSV (header) and scanned back with the fixed
    schema and a TIMESTAMP_NTZ parse."""
    path = shared_path(spark, "metrics-csv")
    IO.write_table(IO.events_metrics(spark, sf_dir), path, fmt="csv", partition_by=[])
    return IO.scan_metrics(spark, path, fmt="csv")


@register("scan_features", O.feature_sql())
def q_scan_features(spark, sf_dir):
    path = shared_path(spark, "features")
    IO.write_table(FE.feature_table(IO.events_metrics(spark, sf_dir)), path)
    return rounded(IO.scan_features(spark, path).drop("event_date"))


@register(
    "write_table",
    O.with_ctes(O.METRICS_CTE)
    + "\nSELECT CAST(ts AS DATE) AS event_date, count(*) AS n_rows, CAST(sum(error_count) AS BIGINT) AS errors"
    " FROM metrics GROUP BY 1",
)
def q_write_table(spark, sf_dir):
    """Write partitioned by day, read back, count per day partition (the
    partition column comes from the folder names)."""
    path = shared_path(spark, "metrics-by-day")
    IO.write_table(IO.events_metrics(spark, sf_dir), path)
    back = spark.read.parquet(path)
    return back.groupBy("event_date").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("error_count").cast("bigint").alias("errors"))


READING_SQL_COLS = "event_id AS reading_id, host_id, ts, " + ", ".join(S.METRIC_COLS) + ", hour, day_of_week"


@register("read_readings_json", O.with_ctes(O.METRICS_CTE) + f"\nSELECT {READING_SQL_COLS} FROM metrics")
def q_read_readings_json(spark, sf_dir):
    path = shared_path(spark, "readings-json")
    m = IO.events_metrics(spark, sf_dir).withColumnRenamed(S.KEY, "reading_id")
    IO.write_readings_json(m.select(*[f.name for f in S.READING_SCHEMA.fields]), path)
    return IO.read_readings_json(spark, path)


#: Every seventh body of 50 readings is cut short; in every fifth, the first
#: reading's error count is text.
BODY = 50
_GOOD = f"event_id // {BODY} % 7 <> 3 AND NOT (event_id // {BODY} % 5 = 2 AND event_id % {BODY} = 0)"
_NO_READING = ", ".join(f"NULL AS {c}" for c in ["reading_id", S.HOST, S.TS, *S.METRIC_COLS, "hour", "day_of_week"])


@register(
    "read_readings_bodies",
    O.with_ctes(O.METRICS_CTE)
    + f"\nSELECT {READING_SQL_COLS}, NULL AS body_error FROM metrics WHERE {_GOOD}"
    + f"\nUNION ALL SELECT {_NO_READING}, '{IO.MALFORMED_BODY}' FROM metrics WHERE event_id // {BODY} % 7 = 3 GROUP BY event_id // {BODY}"
    + f"\nUNION ALL SELECT {_NO_READING}, '{IO.MALFORMED_READING}' FROM metrics WHERE event_id // {BODY} % 7 <> 3 AND event_id // {BODY} % 5 = 2 AND event_id % {BODY} = 0",
)
def q_read_readings_bodies(spark, sf_dir):
    """Readings written as batch bodies (JSON arrays) and read back; bodies
    cut short and elements of a wrong type are reported, the rest of their
    bodies is read."""
    path, broken = shared_path(spark, "readings-bodies"), shared_path(spark, "readings-broken")
    m = IO.events_metrics(spark, sf_dir).withColumnRenamed(S.KEY, "reading_id")
    text = spark.read.text(IO.write_readings_bodies(m, path, size=BODY))
    least = F.array_min(F.transform(F.from_json("value", "array<struct<reading_id: bigint>>"), lambda r: r["reading_id"]))
    n = text.withColumn("_n", F.floor(least / BODY)).withColumn("_first", F.concat(F.lit('"reading_id":'), (F.col("_n") * BODY).cast("string"), F.lit(",")))
    wrong = F.replace("value", F.col("_first"), F.concat(F.lit('"error_count":"many",'), F.col("_first")))
    cut = F.expr("left(value, length(value) - 9)")
    n.select(F.when(F.col("_n") % 7 == 3, cut).when(F.col("_n") % 5 == 2, wrong).otherwise(F.col("value")).alias("value")).write.text(broken)
    return IO.read_bodies(spark, broken).drop("raw")


@register("scan_days", O.with_ctes(O.METRICS_CTE) + f"\nSELECT {METRIC_SELECT} FROM metrics WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-09 12:30:00'")
def q_scan_days(spark, sf_dir):
    """A stretch of time of a table written by day: day folders are pruned;
    one of its days was written anew."""
    path = shared_path(spark, "metrics-days")
    m = IO.events_metrics(spark, sf_dir)
    IO.write_table(m, path)
    IO.write_table(m.filter(F.to_date(S.TS) == F.lit("2024-01-06")), path, replace="partitions")
    return IO.scan_metrics(spark, path, since=dt.datetime(2024, 1, 5, 6), until=dt.datetime(2024, 1, 9, 12, 30))


@register("scan_features_csv", O.feature_sql())
def q_scan_features_csv(spark, sf_dir):
    """Feature table through CSV, typed by the feature list."""
    path = shared_path(spark, "features-csv")
    IO.write_table(FE.feature_table(IO.events_metrics(spark, sf_dir)), path, fmt="csv", partition_by=[])
    return rounded(IO.scan_features(spark, path, fmt="csv"))


@register(
    "write_predictions",
    O.with_ctes(O.METRICS_CTE)
    + f"\nSELECT count(*) AS count, TIMESTAMP '{AS_OF.isoformat(sep=' ')}' AS timestamp,"
    + f" {O.r(f'avg({FIXTURE_P_SQL})')} AS mean_probability FROM metrics",
)
def q_write_predictions(spark, sf_dir):
    """Predictions written as Parquet (array column kept), envelope back."""
    from strainmeter.plans.score import score_readings

    m = fixture_score(IO.events_metrics(spark, sf_dir))
    preds = score_readings(m, as_of=AS_OF)
    path = shared_path(spark, "predictions")
    IO.write_predictions(preds, path)
    back = spark.read.parquet(path)
    env = back.agg(
        F.count(F.lit(1)).alias("count"),
        F.max("timestamp").alias("timestamp"),
        F.avg("failure_probability_raw").alias("mean_probability"),
    )
    return rounded(env)
