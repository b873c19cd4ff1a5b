"""Exact splits: stratified train / test, time-based, stratified folds.

All ranks are two-level (range buckets + prefix sums, ranking.py), so a
label with two values or a global time order never lands in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.functions.exprs import order_micros
from strainmeter.operators.ranking import ranked
from strainmeter.session import DEFAULT_ROWS_PER_BUCKET


def _split_order(key: Column | None) -> tuple[Column, list[Column]]:
    k = key if key is not None else shuffled_key(F.col(S.KEY))
    return k, [k, F.col(S.KEY)]


def shuffled_key(key: Column, seed: int = S.SPLIT_SEED) -> Column:
    """A uniform 60-bit order key: any id type and size, another order for
    another seed, and the same in both engines."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, S.SPLIT_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint")


def stratified_split(
    df: DataFrame,
    label: str = S.LABEL,
    test_share: float = S.TEST_SHARE,
    order_key: Column | None = None,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    n_buckets: int | None = None,
) -> DataFrame:
    """Add ``is_test``: per label class, the first ceil(share x n_class) rows
    in the seeded key order are the test part (label shares kept exactly)."""
    k, order = _split_order(order_key)
    r = ranked(
        df, order, k, partition_cols=[label], out="_rank", total_out="_n", rows_per_bucket=rows_per_bucket, n_buckets=n_buckets
    )
    return r.withColumn("is_test", F.col("_rank") <= F.ceil(F.col("_n") * F.lit(test_share))).drop("_rank", "_n")


def time_split(
    df: DataFrame,
    test_share: float = S.TEST_SHARE,
    ts: str = S.TS,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    n_buckets: int | None = None,
) -> DataFrame:
    """Add ``is_test``: the latest ceil(share x n) rows by (ts, key) are the
    test part; training only sees the past."""
    r = ranked(
        df,
        [F.col(ts), F.col(S.KEY)],
        order_micros(ts),
        out="_rank",
        total_out="_n",
        rows_per_bucket=rows_per_bucket,
        n_buckets=n_buckets,
        tie=F.col(S.KEY),
    )
    return r.withColumn("is_test", F.col("_rank") > F.col("_n") - F.ceil(F.col("_n") * F.lit(test_share))).drop("_rank", "_n")


def stratified_folds(
    df: DataFrame,
    k: int = S.N_FOLDS,
    label: str = S.LABEL,
    order_key: Column | None = None,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    n_buckets: int | None = None,
    out: str = "fold",
) -> DataFrame:
    """Add ``fold`` = (rank within class - 1) % k: every fold holds the
    class shares to within one row."""
    key, order = _split_order(order_key)
    r = ranked(df, order, key, partition_cols=[label], out="_rank", rows_per_bucket=rows_per_bucket, n_buckets=n_buckets)
    return r.withColumn(out, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")
