"""The 48-column feature table and its parts.

Order of work (same as the reference): row-local features from the raw
columns (NULL inputs give NULL, flags compare NULL as false), rolling and lag
features per series (rolling skips NULL, lag gaps take the whole-table mean),
then every column is forward filled per series and the rest set to 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.functions import exprs as X
from strainmeter.operators.clean import nan_to_null
from strainmeter.operators.windows import HistorySpec, column_means, history_features
from strainmeter.session import DEFAULT_ROWS_PER_BUCKET


def add_interactions(df: DataFrame) -> DataFrame:
    return df.withColumns(X.interaction_exprs())


def add_stress(df: DataFrame) -> DataFrame:
    # total_stress refers to the flag expressions, so add in one projection
    return df.withColumns(X.stress_exprs())


def add_cyclic(df: DataFrame) -> DataFrame:
    return df.withColumns(X.cyclic_exprs())


def row_local_features(metrics: DataFrame) -> DataFrame:
    """Interaction, stress and cyclic features (no window, no shuffle)."""
    return metrics.withColumns({**X.interaction_exprs(), **X.stress_exprs(), **X.cyclic_exprs()})


# columns that can be NULL after the row-local step and are forward filled;
# the flags and total_stress never are (NULL compares as false)
def _ffill_columns(df: DataFrame, keys: list[str]) -> list[str]:
    never_null = set(S.STRESS_COLS) | set(keys) | set(S.ROLLING_COLS_OUT) | set(S.LAG_COLS_OUT)
    return [c for c in df.columns if c not in never_null]


def history_spec(lag_fill: dict[str, float | None], ffill: list[str]) -> HistorySpec:
    return HistorySpec(rolling=S.rolling_names(), lags=S.lag_names(), lag_fill=lag_fill, ffill=ffill)


def lag_fills(metrics: DataFrame) -> dict[str, float | None]:
    """Whole-table means that fill lag gaps; NULL and NaN don't count."""
    return column_means(nan_to_null(metrics, [c for c, t in metrics.dtypes if t in ("double", "float") and c in S.LAG_COLS]), S.LAG_COLS)


def feature_table(
    metrics: DataFrame,
    partition_cols: tuple[str, ...] | list[str] = (S.HOST,),
    order_cols: tuple[str, ...] | list[str] = (S.TS, S.KEY),
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    n_buckets: int | None = None,
    lag_fill: dict[str, float | None] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Raw metric table -> feature table (``keep`` columns + 48 features).

    ``lag_fill`` defaults to the whole-table means (the reference's rule);
    pass training-part means to avoid leaking test rows into the fill.
    Without ``n_buckets`` only series above ``rows_per_bucket`` rows are split
    into ranges (``windows.by_series_size``).
    """
    keep = list(keep) if keep is not None else [c for c in (S.KEY, S.HOST) if c in metrics.columns]
    metrics = nan_to_null(metrics, [c for c, t in metrics.dtypes if t in ("double", "float")])
    if lag_fill is None:
        lag_fill = lag_fills(metrics)
    local = row_local_features(metrics).select(*keep, *[c for c in S.FEATURE_COLS if c not in S.ROLLING_COLS_OUT + S.LAG_COLS_OUT])
    ffill = _ffill_columns(local, keep + [S.LABEL])
    spec = history_spec(lag_fill, ffill)
    feats = history_features(local, spec, partition_cols, order_cols, rows_per_bucket, n_buckets, post=_zero_fill)
    return feats.select(*keep, *S.FEATURE_COLS)


def _zero_fill(name: str, sql: str) -> str:
    """Remaining NULL (and NaN) -> 0, the timestamp and keys untouched."""
    if name in (S.TS, S.KEY, S.HOST) or name.startswith("_"):
        return sql
    if name in S.DOUBLE_FEATURES:
        return f"coalesce(nanvl({sql}, CAST(NULL AS DOUBLE)), CAST(0 AS DOUBLE))"
    return f"coalesce({sql}, 0)"



def select_inputs(features: DataFrame, manifest: list[str] | None = None) -> DataFrame:
    """Model inputs in manifest order (every column but timestamp and label)."""
    names = manifest or S.MODEL_INPUTS
    return features.select(*names)


def align_to_manifest(df: DataFrame, manifest: list[str], keep: list[str] | None = None) -> DataFrame:
    """Add missing inputs (rolling / lag from their base column, else 0), drop
    extras, fix the order: one ``select`` built from column names."""
    keep = keep or []
    have = set(df.columns)
    cols = []
    for name in manifest:
        if name in have:
            cols.append(F.col(name).cast("double").alias(name))
            continue
        base = S.history_base(name)
        if base is not None and base in have:
            cols.append(F.col(base).cast("double").alias(name))
        else:
            cols.append(F.lit(0.0).alias(name))
    return df.select(*[F.col(k) for k in keep], *cols)


def point_features(readings: DataFrame, manifest: list[str] = S.MODEL_INPUTS, keep: list[str] | None = None) -> DataFrame:
    """Scoring-time feature rows with no history: rolling and lag features take
    the reading's own value (the reference's serving rule)."""
    df = readings.withColumns(
        {
            "is_weekend": X.weekend_flag("day_of_week"),
            "is_business_hours": X.business_flag("hour", "day_of_week"),
        }
    )
    df = row_local_features(df)
    return align_to_manifest(df, manifest, keep=keep)
