"""Model queries (MLlib fits; checked by rows and properties, not SQL)."""

from __future__ import annotations

import datetime as dt

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strainmeter import oracle_sql as O
from strainmeter import schema as S
from strainmeter.fixtures import FIXTURE_P_SQL, INVALID_SQL, fixture_model, fixture_score, invalid_fixture, null_fixture
from strainmeter.operators import clean as C
from strainmeter.operators import evaluate as EV
from strainmeter.operators import features as FE
from strainmeter.operators import split as SP
from strainmeter.operators.clean import inf_to_zero
from strainmeter.plans import train as TR
from strainmeter.plans.catalog import register
from strainmeter.plans.catalog.q_metrics import AUC_EXPR, AUC_SQL
from strainmeter.plans.catalog.q_scoring import codes_sql, risk_sql
from strainmeter.plans.checks import rounded, split_buckets
from strainmeter.plans.history import HistoryStore, score_incremental
from strainmeter.plans.registry import promotion_gate
from strainmeter.plans.score import score_batch, with_rejected
from strainmeter.plans.workflow import comparison, end_to_end, evaluated, predicted, scored_readings, trained_registry
from strainmeter.session import shared_path
from strainmeter.sources.io import events_metrics

AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)


def _fit_query(name: str):
    def q(spark, sf_dir):
        """One model, fitted anew on the given table."""
        reg = trained_registry(spark, sf_dir, [name], refit=True)
        return reg.latest_records().filter(F.col("model") == name).drop("trained_at")

    return q


register("train_logistic")(_fit_query("logistic_regression"))
register("train_forest")(_fit_query("random_forest"))
register("train_boosted")(_fit_query("boosted_trees"))


@register("train_all")
def q_train_all(spark, sf_dir):
    """The three fits, their metrics on the table's test part, best by AUC
    and the scoring choice."""
    return comparison(evaluated(spark, sf_dir, trained_registry(spark, sf_dir)))


@register("predict_proba", f"SELECT event_id, {O.r(FIXTURE_P_SQL)} AS failure_probability, 'fixture' AS model_used FROM ({O.feature_sql(src='metrics_nulls', extra_ctes=O.NULL_METRICS_CTE)})")
def q_predict_proba(spark, sf_dir):
    """Positive-class probability of every row of the feature table (gaps
    carried or filled), by the fixture model."""
    return rounded(predicted(null_fixture(events_metrics(spark, sf_dir)), fixture_model(), "fixture"))


@register("predict_proba_fitted")
def q_predict_proba_fitted(spark, sf_dir):
    """The same by the chosen fitted model, lag gaps filled as in its fit."""
    reg = trained_registry(spark, sf_dir)
    name = reg.choose("preference")
    return predicted(events_metrics(spark, sf_dir), reg.load(name), name, reg.fills())


def _raw_readings(spark, sf_dir):
    """Readings with gaps and out-of-range values."""
    return null_fixture(invalid_fixture(events_metrics(spark, sf_dir)))


def _raw_sql() -> str:
    from strainmeter.plans.catalog.q_clean import _violations_sql

    gap = "event_id % 17 = 3 OR event_id < 2"
    raw = "rawr AS (SELECT event_id, hour, day_of_week, " + ", ".join(f"CASE WHEN {gap} THEN NULL ELSE {c} END AS {c}" for c in S.METRIC_COLS) + " FROM invalid)"
    ok = lambda x: f"CASE WHEN violations = '' THEN {x} END"
    return O.with_ctes(O.METRICS_CTE, INVALID_SQL, raw, f"ch AS (SELECT *, {_violations_sql()} AS violations FROM rawr)") + (
        f"\nSELECT event_id, violations, {ok(O.round_even(FIXTURE_P_SQL, S.PROBABILITY_DIGITS))} AS failure_probability,"
        f" {ok(risk_sql(FIXTURE_P_SQL))} AS failure_risk, {ok(codes_sql(FIXTURE_P_SQL))} AS recommendation_codes FROM ch"
    )


def _reading_view(both):
    return both.select(
        F.col("reading_id").alias(S.KEY),
        F.coalesce(F.array_join("violations", ","), F.lit("")).alias("violations"),
        "failure_probability",
        "failure_risk",
        F.array_join("recommendation_codes", ",").alias("recommendation_codes"),
    )


@register("end_to_end_run")
def q_end_to_end_run(spark, sf_dir):
    """Features -> split -> fits -> registry -> batch scoring of all raw
    readings with point features (the reference's batch run, re-aimed);
    readings with gaps or out of range come back with their codes."""
    return end_to_end(spark, sf_dir, as_of=AS_OF, readings=_raw_readings(spark, sf_dir))


@register("end_to_end_fixture", _raw_sql())
def q_end_to_end_fixture(spark, sf_dir):
    """The scoring half of the batch run with the fixture model."""
    return _reading_view(scored_readings(_raw_readings(spark, sf_dir), fixture_model(), "fixture", as_of=AS_OF))


@register("top_feature_importance")
def q_top_feature_importance(spark, sf_dir):
    """The ten strongest inputs of the forest (46 numbers from the model),
    with each input's mean and deviation over the feature table."""
    reg = trained_registry(spark, sf_dir, ["random_forest"])
    top = TR.feature_importances(reg.load("random_forest"), reg.manifest(), top=10)
    rows = [(i + 1, n, v) for i, (n, v) in enumerate(top)]
    ft = inf_to_zero(FE.feature_table(events_metrics(spark, sf_dir), lag_fill=reg.fills()), S.MODEL_INPUTS)
    stats = EV.column_stats(ft, [n for n, _ in top]).select(F.col("column").alias("feature"), "mean", "std_pop")
    return spark.createDataFrame(rows, "rank INT, feature STRING, importance DOUBLE").join(stats, "feature")


@register(
    "promotion_gate",
    O.with_ctes(O.METRICS_CTE, AUC_SQL, f"a AS (SELECT {AUC_EXPR} AS value FROM cu)")
    + "\n"
    + "\nUNION ALL\n".join(
        f"SELECT 'fixture' AS model, '{k}' AS stage, CAST({v} AS DOUBLE) AS threshold, {O.r('value')} AS value,"
        f" value >= {v} AS passed FROM a"
        for k, v in S.STAGE_THRESHOLDS.items()
    ),
)
def q_promotion_gate(spark, sf_dir):
    """AUC against the stage thresholds (staging 0.92, production 0.90); the
    fixture score stands in for a fitted model's record."""
    m = fixture_score(events_metrics(spark, sf_dir))
    auc = EV.roc_auc(m, n_buckets=split_buckets(m)).select(F.lit("fixture").alias("model"), "auc")
    gate = promotion_gate(auc, "auc")
    return rounded(gate, skip=("threshold",))


#: Rounds and trees of the cross-validated tree models: five fits each.
CV_ROUNDS, CV_TREES = 5, 20


@register("kfold_cv")
def q_kfold_cv(spark, sf_dir):
    """5-fold cross-validation of the three models on the feature table with
    the stratified fold column (the fits behind ``kfold_eval``)."""
    path = shared_path(spark, "features-folds")
    metrics = events_metrics(spark, sf_dir)
    ft = SP.stratified_folds(inf_to_zero(FE.feature_table(metrics), S.MODEL_INPUTS))
    # what fits read, in the order of whole rows
    TR.dealt(ft, metrics.count()).select(S.LABEL, "fold", *S.MODEL_INPUTS).write.option("compression", "zstd").parquet(path)
    ft = spark.read.parquet(path)
    rows = []
    for spec in TR.cv_specs(CV_ROUNDS, CV_TREES):
        mean, std = TR.cross_validate(ft, spec)
        rows.append((spec.name, S.N_FOLDS, mean[0], std[0]))
    return spark.createDataFrame(rows, "model STRING, n_folds INT, mean_auc DOUBLE, std_auc DOUBLE")


@register("score_history")
def q_score_history(spark, sf_dir):
    """All readings scored with true history inputs (rolling / lag / forward
    fill over each host's whole history), the chosen model."""
    reg = trained_registry(spark, sf_dir)
    name = reg.choose("preference")
    readings = events_metrics(spark, sf_dir).select(F.col(S.KEY).alias("reading_id"), S.HOST, S.TS, *S.METRIC_COLS, "hour", "day_of_week")
    return with_rejected(*score_batch(readings, reg.load(name), name, manifest=reg.manifest(), as_of=AS_OF, mode="history", lag_fill=reg.fills()))


def _incremental_sql() -> str:
    from strainmeter.plans.catalog.q_clean import _violations_sql

    new = [*S.ROLLING_COLS_OUT, *S.LAG_COLS_OUT]
    ctes = ",\n".join([O.METRICS_CTE.strip(), INVALID_SQL, f"ch AS (SELECT *, {_violations_sql()} AS violations FROM invalid)", "validv AS (SELECT * EXCLUDE (violations) FROM ch WHERE violations = '')"])
    head, tail = O.feature_sql(src="validv", extra_ctes=ctes).rsplit("\nSELECT ", 1)
    return (
        f"{head},\n_ft AS (SELECT {tail})\nSELECT ch.event_id, ch.violations,"
        f" CASE WHEN ch.violations = '' THEN {O.round_even(FIXTURE_P_SQL.replace('cpu', 'ch.cpu').replace('memory', 'ch.memory'), S.PROBABILITY_DIGITS)} END AS failure_probability, "
        + ", ".join(f"_ft.{c}" for c in new)
        + " FROM ch LEFT JOIN _ft ON ch.event_id = _ft.event_id"
    )


@register("score_incremental", _incremental_sql())
def q_score_incremental(spark, sf_dir):
    """Readings scored ten days at a time with the keyed history table: the
    rolling and lag inputs equal those over the whole valid history."""
    readings = invalid_fixture(events_metrics(spark, sf_dir)).drop(S.LABEL, "is_weekend", "is_business_hours")
    fills = FE.lag_fills(C.split_valid(readings)[0])
    store = HistoryStore(spark, shared_path(spark, "history"))
    period = F.floor(F.datediff(F.to_date(S.TS), F.lit("2024-01-01").cast("date")) / 10)
    new = [*S.ROLLING_COLS_OUT, *S.LAG_COLS_OUT]
    # each batch reads its own ten days, not the whole table
    path = shared_path(spark, "readings-by-period")
    readings.withColumn("_period", period).write.partitionBy("_period").parquet(path)
    dealt = spark.read.schema(T.StructType([*readings.schema.fields, T.StructField("_period", T.LongType())])).parquet(path)
    done, version = [], 0
    for p in sorted(r[0] for r in dealt.select("_period").distinct().collect()):
        batch = dealt.filter(F.col("_period") == p).drop("_period")
        preds, rejected, version = score_incremental(batch, store, version, fixture_model(), "fixture", fills, as_of=AS_OF, with_inputs=new)
        preds = preds.select(S.KEY, F.lit("").alias("violations"), "failure_probability", *new)
        done.append(preds.unionByName(rejected.select(S.KEY, F.array_join("violations", ",").alias("violations")), allowMissingColumns=True))
    return rounded(reduce(DataFrame.unionByName, done))


@register("model_info")
def q_model_info(spark, sf_dir):
    """The registry's info view: models, input count and first input names,
    with the rows of the table that the fits stand for."""
    info = trained_registry(spark, sf_dir).info()
    n = events_metrics(spark, sf_dir).count()
    return info.select("feature_count", F.array_join("models", ",").alias("models"), F.array_join("first_features", ",").alias("first_features"), F.lit(n).alias("n_rows"))
