"""Shared helpers for registered queries: rounding doubles for the
cross-engine check, named like the SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column to ``digits`` (HALF_UP, as DuckDB's round)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in skip:
            cols.append(f"round(`{f.name}`, {digits}) AS `{f.name}`")
        else:
            cols.append(f"`{f.name}`")
    return df.selectExpr(*cols)


def split_buckets(df: DataFrame, rows_per_bucket: int | None = None) -> int:
    """Range count for queries that must run the split (range + halo / two
    level) form: as many ranges as the data needs, at least one per core."""
    from strainmeter.operators.windows import n_buckets_for
    from strainmeter.session import DEFAULT_ROWS_PER_BUCKET

    need = n_buckets_for(df, rows_per_bucket or DEFAULT_ROWS_PER_BUCKET)
    return max(need, df.sparkSession.sparkContext.defaultParallelism)
