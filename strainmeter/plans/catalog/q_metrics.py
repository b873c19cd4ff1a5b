"""Aggregate, metric and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strainmeter import oracle_sql as O
from strainmeter import schema as S
from strainmeter.fixtures import FIXTURE_P_SQL, SPLIT_KEY_SQL, fixture_score, null_fixture
from strainmeter.operators import evaluate as EV
from strainmeter.operators import features as FE
from strainmeter.operators import split as SP
from strainmeter.operators.windows import column_means
from strainmeter.plans.catalog import register
from strainmeter.plans.checks import rounded, split_buckets
from strainmeter.sources.io import events_metrics

M = O.METRICS_CTE
P = FIXTURE_P_SQL

SPLIT_CTE = f"""sp AS (SELECT *, row_number() OVER (PARTITION BY failure_within_hour ORDER BY {SPLIT_KEY_SQL}, event_id) AS rk,
  count(*) OVER (PARTITION BY failure_within_hour) AS nc FROM metrics),
parts AS (SELECT *, rk <= ceil(nc * {S.TEST_SHARE}) AS is_test FROM sp)"""


def _split(spark, sf_dir):
    m = events_metrics(spark, sf_dir)
    return SP.stratified_split(m, n_buckets=split_buckets(m))


@register("stratified_split", O.with_ctes(M, SPLIT_CTE) + "\nSELECT event_id, is_test FROM parts")
def q_stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select(S.KEY, "is_test")


@register(
    "time_split",
    O.with_ctes(
        M,
        "tr AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rk, count(*) OVER () AS n FROM metrics)",
    )
    + f"\nSELECT event_id, rk > n - ceil(n * {S.TEST_SHARE}) AS is_test FROM tr",
)
def q_time_split(spark, sf_dir):
    m = events_metrics(spark, sf_dir)
    return SP.time_split(m, n_buckets=split_buckets(m)).select(S.KEY, "is_test")


@register(
    "kfold_eval",
    O.with_ctes(
        M,
        f"fr AS (SELECT event_id, row_number() OVER (PARTITION BY failure_within_hour ORDER BY {SPLIT_KEY_SQL}, event_id) AS rk FROM metrics)",
    )
    + f"\nSELECT event_id, CAST((rk - 1) % {S.N_FOLDS} AS INT) AS fold FROM fr",
)
def q_kfold_eval(spark, sf_dir):
    """Stratified fold column for 5-fold cross-validation (the fits that use it
    are in the model queries)."""
    m = events_metrics(spark, sf_dir)
    return SP.stratified_folds(m, n_buckets=split_buckets(m)).select(S.KEY, "fold")


@register(
    "failure_rate",
    O.with_ctes(M, SPLIT_CTE)
    + f"""
SELECT 'all' AS part, count(*) AS n_rows, {O.r('avg(CAST(failure_within_hour AS DOUBLE))')} AS failure_rate FROM parts
UNION ALL
SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END, count(*), {O.r('avg(CAST(failure_within_hour AS DOUBLE))')} FROM parts GROUP BY 1""",
)
def q_failure_rate(spark, sf_dir):
    parts = _split(spark, sf_dir).withColumn("part", F.when(F.col("is_test"), "test").otherwise("train"))
    return rounded(EV.failure_rate(parts, by=["part"], with_total=True))


@register(
    "row_counts",
    O.with_ctes(M, SPLIT_CTE)
    + """
SELECT 'events' AS table_name, count(*) AS n_rows FROM events
UNION ALL SELECT 'metrics', count(*) FROM metrics
UNION ALL SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END, count(*) FROM parts GROUP BY 1""",
)
def q_row_counts(spark, sf_dir):
    from strainmeter.sources.io import read_table

    ev = read_table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("events").alias("table_name"), "n_rows")
    m = events_metrics(spark, sf_dir)
    mc = m.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("metrics").alias("table_name"), "n_rows")
    parts = (
        _split(spark, sf_dir)
        .groupBy(F.when(F.col("is_test"), "test").otherwise("train").alias("table_name"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return ev.unionByName(mc).unionByName(parts)


@register(
    "column_means",
    O.with_ctes(O.NULL_METRICS_CTE)
    + "\nSELECT "
    + ", ".join(f"{O.r(f'avg({c})')} AS {c}" for c in S.LAG_COLS)
    + " FROM metrics_nulls",
)
def q_column_means(spark, sf_dir):
    """Means of the lag sources with gaps skipped (one aggregate)."""
    m = null_fixture(events_metrics(spark, sf_dir))
    return rounded(m.agg(*[F.avg(c).alias(c) for c in S.LAG_COLS]))


@register(
    "class_balance",
    O.with_ctes(M, SPLIT_CTE)
    + f"""
SELECT count_if(failure_within_hour <> 1) AS n_neg, count_if(failure_within_hour = 1) AS n_pos,
  {O.r('CAST(count_if(failure_within_hour <> 1) AS DOUBLE) / count_if(failure_within_hour = 1)')} AS neg_per_pos
FROM parts WHERE NOT is_test""",
)
def q_class_balance(spark, sf_dir):
    """Negatives per positive on the training part (boosted model weight)."""
    train = _split(spark, sf_dir).filter(~F.col("is_test"))
    return rounded(EV.class_balance(train))


@register(
    "balanced_weights",
    O.with_ctes(M)
    + "\nSELECT event_id, "
    + O.r(
        "CASE WHEN failure_within_hour = 1 THEN (SELECT count(*) FROM metrics) / (2.0 * (SELECT count_if(failure_within_hour = 1) FROM metrics))"
        " ELSE (SELECT count(*) FROM metrics) / (2.0 * (SELECT count_if(failure_within_hour <> 1) FROM metrics)) END"
    )
    + " AS weight FROM metrics",
)
def q_balanced_weights(spark, sf_dir):
    m = EV.balanced_weights(events_metrics(spark, sf_dir))
    return rounded(m.select(S.KEY, "weight"))


# means of short decimals often end in an exact 5 at the seventh digit, where
# summation order decides the rounding: both engines shift them off it
TIE_SHIFT = 1e-9


def _training_inputs_sql() -> str:
    head, tail = O.feature_sql().rsplit("\nSELECT ", 1)
    return head + f""",
_ft AS (SELECT {tail}),
{SPLIT_CTE},
tr AS (SELECT _ft.* FROM _ft JOIN parts USING (event_id) WHERE NOT is_test)"""


@register(
    "scaler_stats",
    _training_inputs_sql()
    + "\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, count({c}) AS n, {O.r(f'avg({c}) + {TIE_SHIFT}')} AS mean, {O.r(f'stddev_pop({c})')} AS std_pop,"
        f" {O.r(f'stddev_samp({c})')} AS std_samp FROM tr"
        for c in S.MODEL_INPUTS
    ),
)
def q_scaler_stats(spark, sf_dir):
    """Mean and standard deviation per model input over the training part
    (population sd, as the reference's scaler; sample sd, as MLlib's)."""
    ft = rounded(FE.feature_table(events_metrics(spark, sf_dir)))
    train = SP.stratified_split(ft, n_buckets=split_buckets(ft)).filter(~F.col("is_test"))
    stats = EV.column_stats(train, S.MODEL_INPUTS)
    return rounded(stats.withColumn("mean", F.col("mean") + TIE_SHIFT))


@register(
    "confusion_metrics",
    O.with_ctes(M, f"pr AS (SELECT failure_within_hour AS y, CAST({P} > 0.5 AS INT) AS p FROM metrics)")
    + """,
c AS (SELECT count_if(y = 1 AND p = 1) AS tp, count_if(y <> 1 AND p = 1) AS fp, count_if(y <> 1 AND p <> 1) AS tn,
  count_if(y = 1 AND p <> 1) AS fn FROM pr)
SELECT tp, fp, tn, fn,
  round(CASE WHEN tp+fp+tn+fn = 0 THEN 0.0 ELSE (tp + tn) / CAST(tp+fp+tn+fn AS DOUBLE) END, 6) AS accuracy,
  round(CASE WHEN tp+fp = 0 THEN 0.0 ELSE tp / CAST(tp+fp AS DOUBLE) END, 6) AS precision,
  round(CASE WHEN tp+fn = 0 THEN 0.0 ELSE tp / CAST(tp+fn AS DOUBLE) END, 6) AS recall,
  round(CASE WHEN tp = 0 THEN 0.0 ELSE 2.0 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END, 6) AS f1
FROM c""",
)
def q_confusion_metrics(spark, sf_dir):
    m = fixture_score(events_metrics(spark, sf_dir))
    m = m.withColumn("prediction", (F.col("failure_probability") > S.CLASS_THRESHOLD).cast("int"))
    return rounded(EV.confusion_metrics(m))


AUC_SQL = f"""ps AS (SELECT {P} AS s, count_if(failure_within_hour = 1) AS pos, count_if(failure_within_hour <> 1) AS neg
  FROM metrics GROUP BY 1),
cu AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM ps)"""
AUC_EXPR = "sum(pos * (below + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg))"


@register("roc_auc", O.with_ctes(M, AUC_SQL) + f"\nSELECT {O.r(AUC_EXPR)} AS auc FROM cu")
def q_roc_auc(spark, sf_dir):
    """Exact AUC of the fixture score (ties count one half)."""
    m = fixture_score(events_metrics(spark, sf_dir))
    return rounded(EV.roc_auc(m, n_buckets=split_buckets(m)))


@register(
    "evaluate_model",
    O.with_ctes(M, AUC_SQL)
    + f"""
SELECT {O.r(AUC_EXPR)} AS auc,
  CAST(sum(CASE WHEN s > 0.5 THEN pos ELSE 0 END) AS BIGINT) AS tp, CAST(sum(CASE WHEN s > 0.5 THEN neg ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN s <= 0.5 THEN neg ELSE 0 END) AS BIGINT) AS tn, CAST(sum(CASE WHEN s <= 0.5 THEN pos ELSE 0 END) AS BIGINT) AS fn,
  {O.r("sum(CASE WHEN s > 0.5 THEN pos ELSE 0 END + CASE WHEN s <= 0.5 THEN neg ELSE 0 END) / CAST(sum(pos + neg) AS DOUBLE)")} AS accuracy,
  {O.r("sum(CASE WHEN s > 0.5 THEN pos ELSE 0 END) / CAST(sum(CASE WHEN s > 0.5 THEN pos + neg ELSE 0 END) AS DOUBLE)")} AS precision,
  {O.r("sum(CASE WHEN s > 0.5 THEN pos ELSE 0 END) / CAST(sum(pos) AS DOUBLE)")} AS recall,
  {O.r("2.0 * sum(CASE WHEN s > 0.5 THEN pos ELSE 0 END) / (2.0 * sum(CASE WHEN s > 0.5 THEN pos ELSE 0 END) + sum(CASE WHEN s > 0.5 THEN neg ELSE 0 END) + sum(CASE WHEN s <= 0.5 THEN pos ELSE 0 END))")} AS f1
FROM cu""",
)
def q_evaluate_model(spark, sf_dir):
    """AUC + class metrics at p > 0.5 in one final aggregate (the fixture
    score stands in for a fitted model; models use the same operator)."""
    m = fixture_score(events_metrics(spark, sf_dir))
    return rounded(EV.evaluate_scores(m, n_buckets=split_buckets(m)))
