"""Scoring queries on the fixture score p = (cpu + memory) / 200."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strainmeter import oracle_sql as O
from strainmeter import schema as S
from strainmeter.fixtures import FIXTURE_P_SQL, INVALID_SQL, fixture_score, invalid_fixture
from strainmeter.operators import clean as C
from strainmeter.operators import features as FE
from strainmeter.plans.catalog import register
from strainmeter.plans.checks import rounded
from strainmeter.plans.score import batch_summary, score_readings, with_rejected
from strainmeter.sources.io import events_metrics

AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)
P = FIXTURE_P_SQL


def risk_sql(p: str) -> str:
    whens = " ".join(f"WHEN {p} >= {lo} THEN '{name}'" for lo, name in S.RISK_LEVELS)
    return f"CASE WHEN {p} IS NULL THEN NULL {whens} ELSE '{S.RISK_FLOOR_LEVEL}' END"


def confidence_sql(p: str) -> str:
    return O.round_even(f"least(greatest(1 - abs({p} - 0.5), {S.CONFIDENCE_LO}), {S.CONFIDENCE_HI})", S.CONFIDENCE_DIGITS)


def codes_sql(p: str) -> str:
    parts = [f"CASE WHEN {p} > {S.URGENT_ABOVE} THEN '{S.URGENT_CODE}' END"]
    for metric, crit, high, cc, hc in S.RULE_TIERS:
        parts.append(f"CASE WHEN {metric} > {crit} THEN '{cc}' WHEN {metric} > {high} THEN '{hc}' END")
    joined = "concat_ws(',', " + ", ".join(parts) + ")"
    return f"CASE WHEN {joined} = '' THEN '{S.HEALTHY_CODE}' ELSE {joined} END"


def _scored(spark, sf_dir):
    return score_readings(fixture_score(events_metrics(spark, sf_dir)), as_of=AS_OF)


@register("risk_level", O.with_ctes(O.METRICS_CTE) + f"\nSELECT event_id, {risk_sql(P)} AS failure_risk FROM metrics")
def q_risk_level(spark, sf_dir):
    return _scored(spark, sf_dir).select(S.KEY, "failure_risk")


@register("confidence", O.with_ctes(O.METRICS_CTE) + f"\nSELECT event_id, {confidence_sql(P)} AS confidence FROM metrics")
def q_confidence(spark, sf_dir):
    return _scored(spark, sf_dir).select(S.KEY, "confidence")


@register("recommendations", O.with_ctes(O.METRICS_CTE) + f"\nSELECT event_id, {codes_sql(P)} AS recommendation_codes FROM metrics")
def q_recommendations(spark, sf_dir):
    return _scored(spark, sf_dir).select(S.KEY, F.array_join("recommendation_codes", ",").alias("recommendation_codes"))


def _score_batch_sql() -> str:
    valid = "validv AS (SELECT * FROM invalid WHERE " + " AND ".join(
        [f"{c} IS NOT NULL AND {c} >= {lo}" + (f" AND {c} <= {hi}" if hi is not None else "") for c, lo, hi in S.READING_BOUNDS]
        + [f"({c} IS NULL OR {c} BETWEEN {lo} AND {hi})" for c, lo, hi in S.CALENDAR_BOUNDS]
    ) + ")"
    return (
        O.with_ctes(O.METRICS_CTE, INVALID_SQL, valid)
        + f"""
SELECT event_id, {O.round_even(P, S.PROBABILITY_DIGITS)} AS failure_probability, {risk_sql(P)} AS failure_risk,
  {confidence_sql(P)} AS confidence, {codes_sql(P)} AS recommendation_codes, 'fixture' AS model_used,
  TIMESTAMP '{AS_OF.isoformat(sep=' ')}' AS timestamp
FROM validv"""
    )


@register("score_batch", _score_batch_sql())
def q_score_batch(spark, sf_dir):
    """Whole batch in one plan: invalid rows quarantined, the rest scored
    (fixture score stands in for the model)."""
    valid, _bad = C.split_valid(invalid_fixture(events_metrics(spark, sf_dir)))
    preds = score_readings(fixture_score(valid), as_of=AS_OF)
    return preds.select(
        S.KEY,
        "failure_probability",
        "failure_risk",
        "confidence",
        F.array_join("recommendation_codes", ",").alias("recommendation_codes"),
        "model_used",
        "timestamp",
    )


def _envelope_sql() -> str:
    from strainmeter.plans.catalog.q_clean import _violations_sql

    return (
        O.with_ctes(O.METRICS_CTE, INVALID_SQL, f"ch AS (SELECT *, {_violations_sql()} AS violations FROM invalid)")
        + f"""
SELECT event_id, violations,
  CASE WHEN violations = '' THEN {O.round_even(P, S.PROBABILITY_DIGITS)} END AS failure_probability FROM ch"""
    )


@register("batch_envelope", _envelope_sql())
def q_batch_envelope(spark, sf_dir):
    """Both sides of a batch: every reading once, scored or rejected."""
    valid, bad = C.split_valid(invalid_fixture(events_metrics(spark, sf_dir)))
    both = with_rejected(score_readings(fixture_score(valid), as_of=AS_OF).select(S.KEY, "failure_probability"), bad)
    return both.select(S.KEY, F.coalesce(F.array_join("violations", ","), F.lit("")).alias("violations"), "failure_probability")


@register(
    "batch_summary",
    O.with_ctes(
        O.METRICS_CTE,
        f"sc AS (SELECT {risk_sql(P)} AS failure_risk, {codes_sql(P)} AS codes FROM metrics)",
    )
    + """
SELECT 'total' AS kind, 'all' AS key, count(*) AS n FROM sc
UNION ALL SELECT 'risk', failure_risk, count(*) FROM sc GROUP BY failure_risk
UNION ALL SELECT 'code', code, count(*) FROM (SELECT unnest(string_split(codes, ',')) AS code FROM sc) GROUP BY code""",
)
def q_batch_summary(spark, sf_dir):
    return batch_summary(_scored(spark, sf_dir))


def _point_sql() -> str:
    cols = []
    for c in S.MODEL_INPUTS:
        base = S.history_base(c)
        if base is not None:
            cols.append(f"{O.r(f'CAST({base} AS DOUBLE)')} AS {c}")
        else:
            cols.append(f"{O.r(f'CAST({c} AS DOUBLE)')} AS {c}")
    return (
        O.with_ctes(O.METRICS_CTE, f"loc AS ({O.row_local_sql('metrics')})")
        + "\nSELECT event_id, "
        + ", ".join(cols)
        + " FROM loc"
    )


@register("point_features", _point_sql())
def q_point_features(spark, sf_dir):
    """Scoring-time rows without history (rolling / lag = own value)."""
    m = events_metrics(spark, sf_dir)
    readings = m.select(S.KEY, *S.METRIC_COLS, "hour", "day_of_week")
    return rounded(FE.point_features(readings, keep=[S.KEY]))


def _align_sql() -> str:
    cols = []
    have = set(O.METRIC_TABLE_COLS)
    for c in S.MODEL_INPUTS:
        base = S.history_base(c)
        if c in have:
            cols.append(f"CAST({c} AS DOUBLE) AS {c}")
        elif base is not None and base in have:
            cols.append(f"CAST({base} AS DOUBLE) AS {c}")
        else:
            cols.append(f"CAST(0 AS DOUBLE) AS {c}")
    return O.with_ctes(O.METRICS_CTE) + "\nSELECT event_id, " + ", ".join(cols) + " FROM metrics"


@register("align_to_manifest", _align_sql())
def q_align_to_manifest(spark, sf_dir):
    """Raw table with an extra column aligned to the 46-input manifest:
    missing rolling / lag take the base column, other missing inputs 0,
    extras dropped, order fixed."""
    m = events_metrics(spark, sf_dir).withColumn("unused_extra", F.lit("x"))
    return FE.align_to_manifest(m, S.MODEL_INPUTS, keep=[S.KEY])
