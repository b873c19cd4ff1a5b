"""Validation and cleaning of metric samples and readings (row-local)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.functions import exprs as X


def violation_checks(bounds=S.READING_BOUNDS, optional=S.CALENDAR_BOUNDS, present: list[str] | None = None) -> list[tuple[str, str]]:
    """(condition, code) per check, rule order; ``<column>:missing|below|above``."""
    checks = []
    for c, lo, hi in bounds:
        # NaN is a missing value, not one above every bound
        checks.append((f"({c} IS NULL OR isnan({c}))", f"{c}:missing"))
        checks.append((f"{c} < {lo}", f"{c}:below"))
        if hi is not None:
            checks.append((f"({c} > {hi} AND NOT isnan({c}))", f"{c}:above"))
    for c, lo, hi in optional:
        if present is not None and c not in present:
            continue
        checks.append((f"{c} < {lo}", f"{c}:below"))
        checks.append((f"{c} > {hi}", f"{c}:above"))
    return checks


def violation_codes_sql(bounds=S.READING_BOUNDS, optional=S.CALENDAR_BOUNDS, present: list[str] | None = None) -> list[str]:
    """One CASE per check giving its code, rule order."""
    return [f"CASE WHEN {cond} THEN '{code}' END" for cond, code in violation_checks(bounds, optional, present)]


def violation_codes(bounds=S.READING_BOUNDS, optional=S.CALENDAR_BOUNDS, present: list[str] | None = None) -> Column:
    """Array of violation codes, rule order kept."""
    return F.expr(X.compact_sql(violation_codes_sql(bounds, optional, present)))


def valid_sql(bounds=S.READING_BOUNDS, optional=S.CALENDAR_BOUNDS, present: list[str] | None = None) -> str:
    """True when no check fires: the same conditions as the codes, NULL
    comparing as false, so a plain predicate (no array built per row)."""
    conds = [cond for cond, _ in violation_checks(bounds, optional, present)]
    return "NOT (" + " OR ".join(f"coalesce({c}, false)" for c in conds) + ")"


def validate_readings(df: DataFrame) -> DataFrame:
    """Add ``violations`` (array of codes) and ``is_valid``; no row removed."""
    v = violation_codes(present=df.columns)
    return df.withColumn("violations", v).withColumn("is_valid", F.size("violations") == 0)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their codes): bad rows are kept
    aside instead of failing the batch. The valid side filters on the plain
    predicate; only quarantined rows get their code array."""
    ok = F.expr(valid_sql(present=df.columns))
    return df.filter(ok), validate_readings(df.filter(~ok))


def default_calendar(df: DataFrame, clock: dt.datetime | str | Column | None = None) -> DataFrame:
    """Missing ``hour`` / ``day_of_week`` from the clock; the clock is an
    argument (deterministic), defaulting to the current time."""
    if clock is None:
        c = F.current_timestamp().cast("timestamp_ntz")
    elif isinstance(clock, Column):
        c = clock
    else:
        c = F.lit(clock if isinstance(clock, str) else clock.isoformat(sep=" ")).cast("timestamp_ntz")
    out = df
    if "hour" not in out.columns:
        out = out.withColumn("hour", F.lit(None).cast("int"))
    if "day_of_week" not in out.columns:
        out = out.withColumn("day_of_week", F.lit(None).cast("int"))
    return out.withColumns(
        {
            "hour": F.coalesce(F.col("hour"), X.hour_of(c)).cast("int"),
            "day_of_week": F.coalesce(F.col("day_of_week"), X.weekday_of(c)).cast("int"),
        }
    )


def clamp_metrics(df: DataFrame, ranges=S.CLAMP_RANGES) -> DataFrame:
    return df.withColumns({c: X.clamp(c, lo, hi) for c, lo, hi in ranges if c in df.columns})


def floor_metrics(df: DataFrame, bounds=S.FLOOR_BOUNDS) -> DataFrame:
    return df.withColumns({c: X.floor_at(c, lo).cast(df.schema[c].dataType) for c, lo in bounds if c in df.columns})


def round_metrics(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round half to even per column (``round`` in Python)."""
    return df.withColumns({c: X.round_even(c, n) for c, n in digits.items()})


def adjust_response(df: DataFrame, out: str = "adjusted_response_ms") -> DataFrame:
    return df.withColumn(out, X.adjusted_response())


def fill_zero(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.fillna(0, subset=cols) if cols else df.fillna(0)


def inf_to_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: X.inf_to_zero(c) for c in cols})


def nan_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: X.nan_to_null(c) for c in cols})


def regime_tag(df: DataFrame, out: str = "regime") -> DataFrame:
    return df.withColumn(out, X.regime_tag())
