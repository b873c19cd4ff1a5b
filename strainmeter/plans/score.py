"""Scoring: probability -> risk level, confidence, recommendation list.

``score_batch`` is one plan for any number of readings: validate (bad rows
quarantined, not failing the batch), calendar defaults, point features,
model transform, rules. Nothing is collected.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.functions import exprs as X
from strainmeter.operators import clean as C
from strainmeter.operators import features as FE


def _ts_lit(as_of: dt.datetime | str | None) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    txt = as_of if isinstance(as_of, str) else as_of.isoformat(sep=" ")
    return F.lit(txt).cast("timestamp_ntz")


def score_readings(
    df: DataFrame,
    p_col: str = "failure_probability",
    as_of: dt.datetime | str | None = None,
    confidence_mode: str = "reference",
    model_used: str | Column | None = None,
) -> DataFrame:
    """Add the prediction fields to rows holding a raw probability and the
    seven metrics. Risk and rules use the unrounded probability; only the
    output field is rounded (4 digits)."""
    p = f"`{p_col}`"
    model = model_used if isinstance(model_used, Column) else (F.lit(model_used) if model_used else F.col("model_used"))
    codes = X.recommendation_codes(p)
    return df.withColumns(
        {
            "failure_probability_raw": F.col(p_col),
            "failure_risk": X.risk_level(p),
            "_confidence_raw": X.ex(X.confidence_raw_sql(p, confidence_mode)),
            "recommendation_codes": codes,
            "model_used": model,
            "timestamp": _ts_lit(as_of),
        }
    ).withColumns(
        {
            # rounding repeats its operand: round columns, not expressions
            "confidence": X.round_even("`_confidence_raw`", S.CONFIDENCE_DIGITS),
            "failure_probability": X.round_even(p, S.PROBABILITY_DIGITS),
            "recommendations": X.recommendation_texts("recommendation_codes"),
        }
    ).drop("_confidence_raw")


def positive_probability(scored: DataFrame, prob_col: str = "probability", out: str = "failure_probability") -> DataFrame:
    """Positive-class probability from MLlib's probability vector."""
    return scored.withColumn(out, vector_to_array(F.col(prob_col))[1])


def score_batch(
    readings: DataFrame,
    model,
    model_name: str,
    manifest: list[str] = S.MODEL_INPUTS,
    as_of: dt.datetime | str | None = None,
    clock: dt.datetime | str | None = None,
    keep: list[str] | None = None,
    confidence_mode: str = "reference",
    mode: str = "point",
    lag_fill: dict[str, float | None] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(predictions, quarantine) for a batch or stream of readings, scored by
    a fitted ``PipelineModel`` whose first stage assembles ``manifest``.

    ``mode='point'``: rolling and lag inputs take the reading's own value
    (the reference's serving rule). ``mode='history'`` (batch only): true
    rolling, lag and forward-filled inputs over each host's readings in time
    order, the feature table's windows, so serving matches training; lag gaps
    take ``lag_fill`` (the fit's means, ``Registry.fills``). Rejected readings
    are part of nobody's history. ``plans.history`` scores batch after batch."""
    keep = keep or [c for c in ("reading_id", S.KEY, S.HOST, S.TS) if c in readings.columns]
    valid, bad = C.split_valid(readings)
    valid = C.default_calendar(valid, clock)
    if mode == "point":
        feats = FE.point_features(valid, manifest, keep=keep)
    elif mode == "history":
        if lag_fill is None:
            raise ValueError("history scoring needs the fit's lag fills")
        feats = _history_inputs(valid, manifest, keep, lag_fill)
    else:
        raise ValueError(f"unknown scoring mode {mode!r}")
    scored = positive_probability(model.transform(feats))
    metric_view = scored.select(*keep, *S.METRIC_COLS, "failure_probability")
    preds = score_readings(metric_view, as_of=as_of, confidence_mode=confidence_mode, model_used=model_name)
    return preds.select(*keep, *[f.name for f in S.PREDICTION_FIELDS.fields], "recommendation_codes"), bad


def with_rejected(preds: DataFrame, bad: DataFrame) -> DataFrame:
    """Both sides of a batch, each reading once: predictions, and rejected
    readings with their ``violations`` and no prediction."""
    names = [c for c in preds.columns if c in bad.columns]
    return preds.unionByName(bad.select(*names, "violations"), allowMissingColumns=True)


def _history_inputs(valid: DataFrame, manifest: list[str], keep: list[str], lag_fill: dict[str, float | None]) -> DataFrame:
    """Feature-table inputs for readings (key, host, ts needed for order)."""
    df = valid
    if S.KEY not in df.columns and "reading_id" in df.columns:
        df = df.withColumn(S.KEY, F.col("reading_id"))
    if S.LABEL not in df.columns:
        df = df.withColumn(S.LABEL, F.lit(None).cast("int"))
    df = df.withColumns({"is_weekend": X.weekend_flag(), "is_business_hours": X.business_flag()})
    extra = [c for c in keep if c not in (S.KEY, S.HOST)]
    ft = FE.feature_table(df, lag_fill=lag_fill, keep=[S.KEY, S.HOST] + [c for c in extra if c != S.TS])
    return FE.align_to_manifest(ft, manifest, keep=keep)


def batch_summary(predictions: DataFrame) -> DataFrame:
    """Rows (kind, key, n): total count, count per risk level, count per
    recommendation code, in one pass (each prediction emits its keys, one
    partial + final aggregation)."""
    # the key list is (all, risk level, codes...): its position gives the
    # kind, so no lambda is needed and the projection stays in generated code
    keys = F.concat(F.array(F.lit("all"), F.col("failure_risk")), F.col("recommendation_codes"))
    kind = F.expr("CASE pos WHEN 0 THEN 'total' WHEN 1 THEN 'risk' ELSE 'code' END")
    return (
        predictions.select(F.posexplode(keys).alias("pos", "key"))
        .groupBy(kind.alias("kind"), F.col("key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
