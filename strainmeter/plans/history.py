"""Incremental scoring with true history features: a keyed table of what each
host's next readings need.

A version of the store has two tables. ``tail`` holds the last rows of each
host that a row frame or lag can reach (4), ``carry`` the last non-null value
of every forward-filled column over all rows before those. A batch of new
readings is unioned with the tails (a few rows a host), gets the carry joined
as the value "seen before", and runs through the feature table's own windows;
the tail rows are dropped from the result. So scoring a day reads that day and
a few rows a host, never the past, and gives ``feature_table``'s rows exactly.

Rules:

* a rejected reading (missing or out of range) is quarantined and is part of
  nobody's history;
* a reading that isn't after its host's last stored one, by (ts, key), is
  rejected with the code ``ts:late``;
* lag gaps take the means of the fit (``Registry.fills``), not those of the
  readings at hand.

Version n is made from version n - 1 and batch n, and is overwritten as a
whole when batch n is repeated, so a run that stopped can be started again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strainmeter import schema as S
from strainmeter.functions import exprs as X
from strainmeter.operators import clean as C
from strainmeter.operators import features as FE
from strainmeter.operators.windows import history_features
from strainmeter.session import DEFAULT_ROWS_PER_BUCKET

LATE_CODE = f"{S.TS}:late"
SEEN = "_seen_before_"
TAIL = "_is_tail"


def reading_rows(readings: DataFrame) -> DataFrame:
    """Readings as rows of the metric table: key, host, time, metrics and
    calendar (flags derived), label unknown."""
    df = readings
    if S.KEY not in df.columns:
        df = df.withColumnRenamed("reading_id", S.KEY)
    df = df.withColumns({"is_weekend": X.weekend_flag(), "is_business_hours": X.business_flag()})
    if S.LABEL not in df.columns:
        df = df.withColumn(S.LABEL, F.lit(None).cast("int"))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.METRICS_SCHEMA.fields])


def _spec(local: DataFrame, fills: dict[str, float | None]):
    return FE.history_spec(fills, FE._ffill_columns(local, [S.KEY, S.HOST, S.LABEL]))


@dataclass
class HistoryStore:
    """Versions of the keyed history under one folder."""

    spark: SparkSession
    base: str
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET

    def path(self, version: int, table: str) -> str:
        return f"{self.base}/v{version:06d}/{table}"

    def _local(self, metrics: DataFrame) -> DataFrame:
        cols = [c for c in S.FEATURE_COLS if c not in S.ROLLING_COLS_OUT + S.LAG_COLS_OUT]
        return FE.row_local_features(C.nan_to_null(metrics, [c for c, t in metrics.dtypes if t == "double"])).select(S.KEY, S.HOST, *cols)

    def _empty(self) -> tuple[DataFrame, DataFrame]:
        local = self._local(self.spark.createDataFrame([], S.METRICS_SCHEMA))
        carry = T.StructType([local.schema[S.HOST], *[T.StructField(SEEN + c, local.schema[c].dataType) for c in self._sources(local)]])
        return local, self.spark.createDataFrame([], carry)

    def _sources(self, local: DataFrame) -> list[str]:
        spec = _spec(local, {})
        return [*spec.ffill, *[s for s in dict.fromkeys(s for _, s, _, _ in spec.rolling) if s not in spec.ffill]]

    def read(self, version: int) -> tuple[DataFrame, DataFrame]:
        """(tail rows, carry rows) of a version; version 0 is empty."""
        if version == 0:
            return self._empty()
        schemas = [d.schema for d in self._empty()]
        return tuple(self.spark.read.schema(s).parquet(self.path(version, t)) for t, s in zip(("tail", "carry"), schemas))

    def split_late(self, rows: DataFrame, version: int) -> tuple[DataFrame, DataFrame]:
        """Rows after their host's last stored one, and the others. A host
        has one stored end, so the join copies nothing."""
        tail, _ = self.read(version)
        ends = tail.groupBy(F.col(S.HOST).alias("_h")).agg(F.max(F.struct(S.TS, S.KEY)).alias("_end"))
        told = rows.join(ends, F.col(S.HOST).eqNullSafe(F.col("_h")), "left")
        after = F.coalesce(F.struct(S.TS, S.KEY) > F.col("_end"), F.lit(True))
        drop = ("_h", "_end")
        return told.filter(after).drop(*drop), told.filter(~after).drop(*drop)

    def features(self, rows: DataFrame, version: int, fills: dict[str, float | None]) -> DataFrame:
        """Feature rows of new metric rows (all after the stored ones)."""
        tail, carry = self.read(version)
        new = self._local(rows).withColumn(TAIL, F.lit(False))
        spec = _spec(new.drop(TAIL), fills)
        both = new.unionByName(tail.withColumn(TAIL, F.lit(True)))
        feats = history_features(both, spec, rows_per_bucket=self.rows_per_bucket, post=FE._zero_fill, seed=(carry, SEEN))
        return feats.filter(~F.col(TAIL)).select(S.KEY, S.HOST, *S.FEATURE_COLS)

    def advance(self, rows: DataFrame, version: int) -> int:
        """Write version + 1 from the stored one and the batch's rows."""
        tail, carry = self.read(version)
        new = self._local(rows).unionByName(tail)
        lookback = _spec(new, {}).lookback
        # where each host's last rows begin, from host, time and key alone:
        # the wide rows are neither sorted nor moved for it
        last = Window.partitionBy(S.HOST).orderBy(F.col(S.TS).desc(), F.col(S.KEY).desc())
        first = lambda rows: rows.groupBy(F.col(S.HOST).alias("_h")).agg(F.min(F.struct(S.TS, S.KEY)).alias("_first"))
        begin = first(new.select(S.HOST, S.TS, S.KEY).withColumn("_r", F.row_number().over(last)).filter(F.col("_r") <= lookback))
        near = new.join(begin, F.col(S.HOST).eqNullSafe(F.col("_h"))).filter(F.struct(S.TS, S.KEY) >= F.col("_first")).drop("_h", "_first")
        kept = near.withColumn("_r", F.row_number().over(last)).filter(F.col("_r") <= lookback).drop("_r")
        path = self.path(version + 1, "tail")
        kept.write.mode("overwrite").parquet(path)
        kept = self.spark.read.schema(kept.schema).parquet(path)
        older = new.join(first(kept), F.col(S.HOST).eqNullSafe(F.col("_h")), "left").filter(F.struct(S.TS, S.KEY) < F.col("_first"))
        order = X.order_key_sql(older, [S.TS, S.KEY])
        names = self._sources(new)
        seen = older.groupBy(S.HOST).agg(*[F.expr(f"max_by(`{c}`, CASE WHEN `{c}` IS NOT NULL THEN {order} END)").alias(f"_new_{c}") for c in names])
        before = carry.withColumnRenamed(S.HOST, "_h")
        both = seen.join(before, F.col(S.HOST).eqNullSafe(F.col("_h")), "full")
        out = both.select(F.coalesce(S.HOST, "_h").alias(S.HOST), *[F.coalesce(f"_new_{c}", SEEN + c).alias(SEEN + c) for c in names])
        out.write.mode("overwrite").parquet(self.path(version + 1, "carry"))
        return version + 1


def score_incremental(
    readings: DataFrame,
    store: HistoryStore,
    version: int,
    model,
    model_name: str,
    fills: dict[str, float | None],
    manifest: list[str] = S.MODEL_INPUTS,
    as_of=None,
    with_inputs: list[str] | tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame, int]:
    """(predictions, rejected readings, new version) of one batch of readings
    with history features. Readings are ordered by (ts, id) within a host;
    ``with_inputs`` names model inputs that come with the predictions."""
    from strainmeter.plans.score import positive_probability, score_readings

    valid, bad = C.split_valid(readings)
    valid = C.default_calendar(valid, F.col(S.TS))
    rows, late = store.split_late(reading_rows(valid), version)
    feats = FE.align_to_manifest(store.features(rows, version, fills), manifest, keep=[S.KEY, S.HOST, S.TS])
    scored = positive_probability(model.transform(feats))
    extra = [c for c in with_inputs if c not in S.METRIC_COLS]
    preds = score_readings(scored.select(S.KEY, S.HOST, S.TS, *S.METRIC_COLS, *extra, "failure_probability"), as_of=as_of, model_used=model_name)
    preds = preds.select(S.KEY, S.HOST, S.TS, *[f.name for f in S.PREDICTION_FIELDS.fields], "recommendation_codes", *with_inputs)
    key = S.KEY if S.KEY in readings.columns else "reading_id"
    bad = bad.withColumnRenamed(key, S.KEY)
    late = late.withColumn("violations", F.array(F.lit(LATE_CODE)))
    names = [S.KEY, S.HOST, S.TS, *S.METRIC_COLS, "violations"]
    rejected = bad.select(*names).unionByName(late.select(*names))
    return preds, rejected, store.advance(rows, version)
