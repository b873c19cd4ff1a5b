"""Two-level rank and cumulative sums: a global ``row_number`` (or running
sum) over a key with few or no groups, without a one-task window.

The order key is cut into ranges (bounds from ``approxQuantile``); rows are
counted per (group, range); the small count table is prefix-summed; each
range is ranked on its own and the offset of the earlier ranges is added.
Only the count table (groups x ranges rows) crosses a one-task window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strainmeter.operators.windows import BUCKET, bounded_broadcast, range_bounds, series_ranges, with_range_bucket
from strainmeter.session import DEFAULT_ROWS_PER_BUCKET


def _ranges(df: DataFrame, part: list[str], rows_per_bucket: int, n_buckets: int | None) -> tuple[int, int, int]:
    """(rows, ranges, groups), counted in one aggregate: one range while every
    group fits a task."""
    sizes = df.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
    stat = sizes.agg(F.count(F.lit(1)).alias("groups"), F.sum("_n").alias("rows"), F.max("_n").alias("most")).first()
    if n_buckets is None:
        fits = (stat["most"] or 0) <= rows_per_bucket
        n_buckets = 1 if fits else math.ceil(stat["rows"] / max(1, rows_per_bucket))
    return stat["rows"] or 0, n_buckets, stat["groups"]


def ranked(
    df: DataFrame,
    order_cols: list[str | Column],
    order_num: Column,
    partition_cols: list[str] | tuple[str, ...] = (),
    out: str = "rank",
    total_out: str | None = None,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    n_buckets: int | None = None,
    tie: Column | None = None,
) -> DataFrame:
    """Add ``out`` = row_number() over (partition by ``partition_cols`` order
    by ``order_cols``), and optionally the group size as ``total_out``.

    ``order_num`` must be a numeric column non-decreasing in ``order_cols``
    (usually the first order column); with ``tie``, a numeric second order
    column, ranges are a tree that cuts heavy values by it
    (``windows.series_ranges``). The count table has at most
    groups x ranges rows, both counted: it is broadcast while that is within
    ``BROADCAST_ROWS``, else the join is left to AQE's runtime size check.
    """
    part = list(partition_cols)
    rows, n_buckets, groups = _ranges(df, part, rows_per_bucket, n_buckets)
    split = n_buckets > 1
    if tie is not None and split:
        b = series_ranges(df, part, order_num, max(1, math.ceil(rows / n_buckets)), tie)
    else:
        bounds = range_bounds(df, order_num, n_buckets)
        b, split = with_range_bucket(df, order_num, bounds), bool(bounds)
    if not split:
        w = Window.partitionBy(*part).orderBy(*order_cols) if part else Window.orderBy(*order_cols)
        res = b.withColumn(out, F.row_number().over(w).cast("long"))
        if total_out:
            wt = Window.partitionBy(*part) if part else Window.partitionBy()
            res = res.withColumn(total_out, F.count(F.lit(1)).over(wt).cast("long"))
        return res.drop(BUCKET)
    counts = b.groupBy(*part, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    wp = Window.partitionBy(*part) if part else Window.partitionBy()
    offsets = counts.select(
        *part,
        BUCKET,
        F.coalesce(F.sum("_n").over(wp.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_n").over(wp).alias("_total"),
    )
    offsets = bounded_broadcast(offsets, groups * 2 * n_buckets)
    j = b.join(offsets, on=[*part, BUCKET], how="inner")
    w = Window.partitionBy(*part, BUCKET).orderBy(*order_cols)
    res = j.withColumn(out, (F.col("_off") + F.row_number().over(w)).cast("long"))
    if total_out:
        res = res.withColumn(total_out, F.col("_total").cast("long"))
    return res.drop(BUCKET, "_off", "_total")


def running_sums(
    df: DataFrame,
    order_col: str,
    sum_cols: list[str],
    partition_cols: list[str] | tuple[str, ...] = (),
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    n_buckets: int | None = None,
    exclusive: bool = False,
) -> DataFrame:
    """Add ``cum_<c>`` = running sum of ``c`` over rows ordered by the numeric
    ``order_col`` (unique per group) per group, inclusive or exclusive of
    the current row."""
    part = list(partition_cols)
    _, n_buckets, groups = _ranges(df, part, rows_per_bucket, n_buckets)
    onum = F.col(order_col).cast("double")
    bounds = range_bounds(df, onum, n_buckets)
    b = with_range_bucket(df, onum, bounds)
    hi = -1 if exclusive else 0
    if not bounds:
        wp = Window.partitionBy(*part) if part else Window.partitionBy()
        w = wp.orderBy(order_col).rowsBetween(Window.unboundedPreceding, hi)
        return b.withColumns({f"cum_{c}": F.coalesce(F.sum(c).over(w), F.lit(0)) for c in sum_cols}).drop(BUCKET)
    sums = b.groupBy(*part, BUCKET).agg(*[F.sum(c).alias(f"_s_{c}") for c in sum_cols])
    wp = Window.partitionBy(*part) if part else Window.partitionBy()
    wo = wp.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*part, BUCKET, *[F.coalesce(F.sum(f"_s_{c}").over(wo), F.lit(0)).alias(f"_o_{c}") for c in sum_cols])
    offsets = bounded_broadcast(offsets, groups * bounds.n_buckets)
    j = b.join(offsets, on=[*part, BUCKET], how="inner")
    w = Window.partitionBy(*part, BUCKET).orderBy(order_col).rowsBetween(Window.unboundedPreceding, hi)
    res = j.withColumns({f"cum_{c}": F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(w), F.lit(0)) for c in sum_cols})
    return res.drop(BUCKET, *[f"_o_{c}" for c in sum_cols])
