"""Monitoring queries: drift, performance, counters, quantiles, latest
features, sustained alerts, roll-up, failure labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from strainmeter import oracle_sql as O
from strainmeter import schema as S
from strainmeter.fixtures import DRIFT_CUT_SQL, FIXTURE_P_SQL, drift_pair, fixture_score
from strainmeter.operators import features as FE
from strainmeter.operators import monitor as MO
from strainmeter.operators.windows import column_means
from strainmeter.plans.catalog import register
from strainmeter.plans.checks import rounded, split_buckets
from strainmeter.session import shared_path
from strainmeter.sources.io import events_metrics, read_table

M = O.METRICS_CTE
P = FIXTURE_P_SQL


def ks_p_sql(lam: str) -> str:
    """Kolmogorov survival function, the same text as the Spark operator."""
    return MO.kolmogorov_sf_sql(lam)


def _ks_sql() -> str:
    cols = S.METRIC_COLS
    parts = []
    for c in cols:
        parts.append(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value, 'a' AS sample FROM ref")
        cur_val = f"{c} * 1.2" if c == "network_latency_ms" else c
        parts.append(f"SELECT '{c}', CAST({cur_val} AS DOUBLE), 'b' FROM metrics WHERE event_id >= {DRIFT_CUT_SQL}")
    return O.with_ctes(
        M,
        f"ref AS (SELECT * FROM metrics WHERE event_id < {DRIFT_CUT_SQL})",
        "lng AS (" + " UNION ALL ".join(parts) + ")",
        "pv AS (SELECT column_name, value, count_if(sample = 'a') AS na, count_if(sample = 'b') AS nb FROM lng WHERE value IS NOT NULL GROUP BY 1, 2)",
        """cd AS (SELECT column_name,
  abs(sum(na) OVER (PARTITION BY column_name ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(na) OVER (PARTITION BY column_name)
    - sum(nb) OVER (PARTITION BY column_name ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(nb) OVER (PARTITION BY column_name)) AS gap,
  CAST(sum(na) OVER (PARTITION BY column_name) AS BIGINT) AS n_ref, CAST(sum(nb) OVER (PARTITION BY column_name) AS BIGINT) AS n_cur FROM pv)""",
        "st AS (SELECT column_name, max(gap) AS ks_statistic, max(n_ref) AS n_ref, max(n_cur) AS n_cur FROM cd GROUP BY column_name)",
        "lm AS (SELECT *, sqrt(n_ref * n_cur / CAST(n_ref + n_cur AS DOUBLE)) * ks_statistic AS lam FROM st)",
        f"pvl AS (SELECT *, {ks_p_sql('lam')} AS p FROM lm)",
    ) + f"""
SELECT column_name, {O.r('ks_statistic')} AS ks_statistic, n_ref, n_cur, {O.r('p')} AS p_value, p < {S.DRIFT_P_THRESHOLD} AS drift_detected FROM pvl"""


@register("ks_drift", _ks_sql())
def q_ks_drift(spark, sf_dir):
    """First half of the ids against the second half with latency x 1.2."""
    ref, cur = drift_pair(events_metrics(spark, sf_dir))
    return rounded(MO.ks_drift(ref, cur, S.METRIC_COLS, n_buckets=split_buckets(ref)))


@register(
    "performance_monitor",
    O.with_ctes(
        M,
        f"pr AS (SELECT event_id, ts, CAST({P} > 0.5 AS INT) AS p FROM metrics)",
        "j AS (SELECT CAST(pr.ts AS DATE) AS day, pr.p, a.failure_within_hour AS y FROM pr JOIN metrics a USING (event_id))",
        """c AS (SELECT day, count_if(y = 1 AND p = 1) AS tp, count_if(y <> 1 AND p = 1) AS fp, count_if(y <> 1 AND p <> 1) AS tn,
  count_if(y = 1 AND p <> 1) AS fn FROM j GROUP BY day)""",
    )
    + """
SELECT day, tp, fp, tn, fn,
  round(CASE WHEN tp+fp+tn+fn = 0 THEN 0.0 ELSE (tp + tn) / CAST(tp+fp+tn+fn AS DOUBLE) END, 6) AS accuracy,
  round(CASE WHEN tp+fp = 0 THEN 0.0 ELSE tp / CAST(tp+fp AS DOUBLE) END, 6) AS precision,
  round(CASE WHEN tp+fn = 0 THEN 0.0 ELSE tp / CAST(tp+fn AS DOUBLE) END, 6) AS recall,
  round(CASE WHEN tp = 0 THEN 0.0 ELSE 2.0 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END, 6) AS f1
FROM c""",
)
def q_performance_monitor(spark, sf_dir):
    """Fixture predictions joined to the actual labels on the key, per day."""
    m = events_metrics(spark, sf_dir)
    preds = fixture_score(m).select(S.KEY, S.TS, (F.col("failure_probability") > S.CLASS_THRESHOLD).cast("int").alias("prediction"))
    return rounded(MO.performance_monitor(preds, m, by_day=S.TS))


@register(
    "prediction_counters",
    O.with_ctes(
        M,
        f"pr AS (SELECT CASE WHEN host_id % 2 = 0 THEN 'fixture_a' ELSE 'fixture_b' END AS model_used, CAST(ts AS DATE) AS day, {P} AS p FROM metrics)",
    )
    + f"""
SELECT model_used, day, count(*) AS n_predictions, count_if(p > {S.ALERT_ABOVE}) AS n_above,
  {O.r(f'count_if(p > {S.ALERT_ABOVE}) / CAST(count(*) AS DOUBLE)')} AS share_above FROM pr GROUP BY 1, 2""",
)
def q_prediction_counters(spark, sf_dir):
    """Predictions per model version and day, share above 0.8 (two model
    versions: even and odd hosts)."""
    m = fixture_score(events_metrics(spark, sf_dir))
    m = m.withColumn("model_used", F.when(F.col(S.HOST) % 2 == 0, "fixture_a").otherwise("fixture_b")).withColumn("day", F.to_date(S.TS))
    return rounded(MO.prediction_counters(m, by=["day"]))


@register(
    "latency_quantile",
    O.with_ctes(M)
    + f"\nSELECT date_trunc('hour', ts) AS bucket_start, {O.r('quantile_cont(response_time_ms, 0.95)')} AS p95, count(*) AS n"
    " FROM metrics GROUP BY 1",
)
def q_latency_quantile(spark, sf_dir):
    """Exact 95th percentile of response time per hour."""
    return rounded(MO.latency_quantile(events_metrics(spark, sf_dir), "response_time_ms", 0.95))


@register(
    "latency_quantile_quarter",
    O.with_ctes(M)
    + f"\nSELECT time_bucket(INTERVAL '15 minutes', ts) AS bucket_start, {O.r('quantile_cont(response_time_ms, 0.95)')} AS p95, count(*) AS n"
    " FROM metrics GROUP BY 1",
)
def q_latency_quantile_quarter(spark, sf_dir):
    """Exact 95th percentile of response time per quarter of an hour."""
    return rounded(MO.latency_quantile(events_metrics(spark, sf_dir), "response_time_ms", 0.95, bucket="15 minutes"))


#: Bound on the rank error of the merged sketches, as a share of the rows.
SKETCH_ERROR = 0.0133


@register(
    "latency_sketch",
    O.with_ctes(M, "dq AS (SELECT date_trunc('day', ts) AS bucket_start, count(*) AS n FROM metrics GROUP BY 1)")
    + "\nSELECT bucket_start, n, true AS within FROM dq",
)
def q_latency_sketch(spark, sf_dir):
    """Daily 95th percentile from stored minute sketches; whether the exact
    rank of each day's value is within the stated error."""
    m = events_metrics(spark, sf_dir)
    path = shared_path(spark, "latency-sketches")
    MO.quantile_sketches(m, "response_time_ms").write.parquet(path)
    days = MO.merged_quantile(spark.read.parquet(path))
    rows = m.select(F.to_date(S.TS).alias("d"), "response_time_ms").join(days.withColumn("d", F.to_date("bucket_start")), "d")
    v, below = F.col("response_time_ms"), lambda c: F.count_if(c) / F.first("n")
    off = F.greatest(below(v < F.col("p95")) - 0.95, F.lit(0.95) - below(v <= F.col("p95")))
    return rows.groupBy("bucket_start", "n").agg((off <= SKETCH_ERROR).alias("within"))


LATEST_NAMES = ["cpu_usage", "cpu_usage_rolling_mean_3", "memory_usage_lag_1", "error_rate", "total_stress"]
LATEST_AS_OF = "2024-01-20 12:00:00"


def _latest_sql() -> str:
    head, tail = O.feature_sql().rsplit("\nSELECT ", 1)
    return (
        head
        + ",\n_ft AS (SELECT "
        + tail
        + f"""),
rk AS (SELECT *, row_number() OVER (PARTITION BY host_id ORDER BY ts DESC, event_id DESC) AS r FROM _ft
  WHERE ts <= TIMESTAMP '{LATEST_AS_OF}'),
ents AS (SELECT DISTINCT host_id FROM metrics)
SELECT ents.host_id, rk.ts, {", ".join("rk." + c for c in LATEST_NAMES)} FROM ents LEFT JOIN rk ON ents.host_id = rk.host_id AND rk.r = 1"""
    )


@register("latest_features", _latest_sql())
def q_latest_features(spark, sf_dir):
    """Current feature values of every host as of a time (max_by per host)."""
    m = events_metrics(spark, sf_dir)
    # every frame looks back: rows after the time only enter the fill means
    past = m.filter(F.col(S.TS) <= F.lit(LATEST_AS_OF).cast("timestamp_ntz"))
    ft = rounded(FE.feature_table(past, lag_fill=column_means(m, S.LAG_COLS)))
    return MO.latest_features(ft, m.select(S.HOST), LATEST_NAMES, as_of=LATEST_AS_OF)


def _as_of_sql() -> str:
    head, tail = O.feature_sql().rsplit("\nSELECT ", 1)
    names = ", ".join(LATEST_NAMES)
    return f"""{head},
_ft AS (SELECT {tail}),
last_of AS (SELECT host_id, ts AS feature_ts, {names} FROM _ft QUALIFY row_number() OVER (PARTITION BY host_id, ts ORDER BY event_id DESC) = 1),
rq AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 20 END AS host_id, ts - INTERVAL '90 minutes' AS as_of FROM metrics)
SELECT rq.event_id, rq.host_id, rq.as_of, feature_ts, {", ".join("last_of." + c for c in LATEST_NAMES)}
FROM rq ASOF LEFT JOIN last_of ON rq.host_id = last_of.host_id AND rq.as_of >= last_of.feature_ts"""


@register("latest_features_asof", _as_of_sql())
def q_latest_features_asof(spark, sf_dir):
    """Feature values of a host at each request's own time: a request per
    event, a third of them for one host, some for unknown hosts."""
    m = events_metrics(spark, sf_dir)
    host = F.when(F.col(S.KEY) % 3 == 0, F.lit(0)).otherwise(F.col(S.KEY) % 20).cast("long")
    requests = m.select(S.KEY, host.alias(S.HOST), (F.col(S.TS) - F.expr("INTERVAL 90 MINUTES")).alias("as_of"))
    return MO.features_as_of(requests, rounded(FE.feature_table(m)), LATEST_NAMES)


def _alert_sql() -> str:
    return O.with_ctes(
        M,
        f"s AS (SELECT host_id, ts, event_id, {P} > {S.ALERT_ABOVE} AS hot FROM metrics)",
        "l AS (SELECT *, lag(hot) OVER (PARTITION BY host_id ORDER BY ts, event_id) AS prev FROM s)",
        "st AS (SELECT *, CASE WHEN hot AND NOT coalesce(prev, false) THEN ts END AS start0 FROM l)",
        """f AS (SELECT *, last_value(start0 IGNORE NULLS) OVER (PARTITION BY host_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island_start FROM st)""",
        f"""g AS (SELECT host_id, island_start,
  min(CASE WHEN ts >= island_start + INTERVAL {S.ALERT_FOR_SECONDS} SECOND THEN ts END) AS fired_at,
  max(ts) AS island_end, count(*) AS n_rows FROM f WHERE hot GROUP BY 1, 2)""",
    ) + "\nSELECT * FROM g WHERE fired_at IS NOT NULL"


@register("sustained_alert", _alert_sql())
def q_sustained_alert(spark, sf_dir):
    """Islands of p > 0.8 per host lasting at least 5 minutes."""
    return MO.sustained_alerts(fixture_score(events_metrics(spark, sf_dir)))


@register(
    "sample_rollup",
    """SELECT user_id % 16 AS host_id, time_bucket(INTERVAL '5 minutes', ts) AS window_start,
  time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
  count(*) AS n_events, count_if(event_type = 'error') AS n_errors, round(avg(value), 6) AS mean_value,
  max(value) AS max_value, count(DISTINCT user_id) AS n_users
FROM events GROUP BY 1, 2, 3""",
)
def q_sample_rollup(spark, sf_dir):
    """Raw events to one row per host and 5-minute window."""
    return rounded(MO.sample_rollup(read_table(spark, sf_dir, "events")))


@register(
    "failure_label",
    """SELECT event_id, user_id % 16 AS host_id,
  CAST(coalesce(max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id % 16 ORDER BY epoch_us(ts)
    RANGE BETWEEN 1 FOLLOWING AND 3600000000 FOLLOWING), 0) AS INT) AS failure_within_hour
FROM events""",
)
def q_failure_label(spark, sf_dir):
    """1 when an error event of the same host falls in the next 60 minutes
    (hosts that outgrow a task in time ranges)."""
    e = read_table(spark, sf_dir, "events").select(S.KEY, (F.col("user_id") % 16).alias(S.HOST), F.col("ts").cast("timestamp_ntz").alias(S.TS), "event_type")
    out = MO.failure_label(e, F.col("event_type") == "error")
    return out.select(S.KEY, S.HOST, S.LABEL)
