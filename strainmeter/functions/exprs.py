"""Scalar column expressions (JVM-side, codegen friendly).

Every rule is written once as Spark SQL text (``*_sql`` builders, operands
are SQL text: a column name or an expression) and turned into a ``Column``
with ``F.expr``. One JVM call per output column keeps planning cheap, and
the same text runs in DuckDB for the second-engine checks where both
dialects agree. Nothing here triggers a job.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainmeter import schema as S

INF = float("inf")


def ex(sql: str) -> Column:
    return F.expr(sql)


def q(name: str) -> str:
    """Quote a column name for SQL text."""
    return f"`{name}`"


def dbl(v: float) -> str:
    """A double literal in both dialects (plain decimals are DECIMAL)."""
    return f"CAST({float(v)!r} AS DOUBLE)"


# ---------------------------------------------------------------------------
# arithmetic helpers with IEEE results (pandas semantics) under ANSI mode
# ---------------------------------------------------------------------------
def ratio_sql(num: str, den: str) -> str:
    """num / den as double; x/0 gives +-inf, 0/0 gives NULL (pandas NaN)."""
    n, d = f"CAST({num} AS DOUBLE)", f"CAST({den} AS DOUBLE)"
    return (
        f"CASE WHEN {n} IS NULL OR {d} IS NULL THEN CAST(NULL AS DOUBLE) "
        f"WHEN {d} = 0 THEN (CASE WHEN {n} > 0 THEN CAST('inf' AS DOUBLE) WHEN {n} < 0 THEN CAST('-inf' AS DOUBLE) END) "
        f"ELSE {n} / {d} END"
    )


def ratio(num: str, den: str) -> Column:
    return ex(ratio_sql(num, den))


def nan_to_null(c: str) -> Column:
    """NaN -> NULL, so that Spark aggregates skip it like pandas does."""
    return ex(f"nanvl(CAST({c} AS DOUBLE), CAST(NULL AS DOUBLE))")


def inf_to_zero(c: str) -> Column:
    return ex(f"CASE WHEN {c} IN (CAST('inf' AS DOUBLE), CAST('-inf' AS DOUBLE)) THEN {dbl(0)} ELSE {c} END")


def clamp_sql(c: str, lo: float, hi: float) -> str:
    return f"least(greatest({c}, {lo!r}), {hi!r})"


def clamp(c: str, lo: float, hi: float) -> Column:
    return ex(clamp_sql(c, lo, hi))


def floor_at(c: str, lo: float) -> Column:
    return ex(f"greatest({c}, {lo!r})")


_SPLITTER = 134217729.0  # 2**27 + 1, Veltkamp split of a double


def round_even_sql(expr: str, digits: int) -> str:
    """Python's ``round(x, digits)`` on doubles: half to even on the exact
    binary value (``bround`` works on the shortest decimal form instead and
    differs on values such as 0.12345).

    y = x * 10**digits is formed exactly as hi + lo (Dekker product; 10**d has
    few significant bits so only x is split). ``rint(hi)`` (half to even) is
    right unless hi is exactly a half while y is not: then the sign of lo
    decides. Exact for |y| < 2^52. Beyond, x itself is returned (NaN and
    infinities too): the rounding moves the value by less than one ulp
    there, and Python may land on the neighbouring double.
    Operands are repeated in the text, so pass a column (or a small
    expression) to keep the generated code small."""
    sc = dbl(10.0**digits)
    x = f"CAST({expr} AS DOUBLE)"
    hi = f"({x} * {sc})"
    t = f"({x} * {dbl(_SPLITTER)})"
    xh = f"({t} - ({t} - {x}))"
    xl = f"({x} - {xh})"
    lo = f"(({xh} * {sc} - {hi}) + {xl} * {sc})"
    tie = f"({hi} - floor({hi}) = 0.5 AND {lo} <> 0)"
    r = f"(CASE WHEN {tie} THEN (CASE WHEN {lo} > 0 THEN ceil({hi}) ELSE floor({hi}) END) ELSE rint({hi}) END)"
    return f"(CASE WHEN abs({hi}) < {dbl(2.0**52)} THEN {r} / {sc} ELSE {x} END)"


def round_even(c: str, digits: int) -> Column:
    return ex(round_even_sql(c, digits))


def flag_sql(pred: str) -> str:
    """Boolean predicate as int 0/1, NULL comparing as false (pandas)."""
    return f"CAST(coalesce({pred}, false) AS INT)"


# ---------------------------------------------------------------------------
# calendar
# ---------------------------------------------------------------------------
def hour_of(ts: str | Column) -> Column:
    return F.hour(ts if isinstance(ts, Column) else F.col(ts)).cast("int")


def weekday_of(ts: str | Column) -> Column:
    """Day of week with Monday = 0 (``weekday``, not ``dayofweek``)."""
    return F.weekday(ts if isinstance(ts, Column) else F.col(ts)).cast("int")


def weekend_sql(dow: str = "day_of_week") -> str:
    return flag_sql(f"{dow} >= {S.WEEKEND_FROM_DOW}")


def business_sql(hour: str = "hour", dow: str = "day_of_week") -> str:
    return flag_sql(f"{hour} BETWEEN {S.BUSINESS_HOUR_FIRST} AND {S.BUSINESS_HOUR_LAST} AND {dow} < {S.WEEKEND_FROM_DOW}")


def weekend_flag(dow: str = "day_of_week") -> Column:
    return ex(weekend_sql(dow))


def business_flag(hour: str = "hour", dow: str = "day_of_week") -> Column:
    return ex(business_sql(hour, dow))


def with_calendar(df: DataFrame, ts: str = S.TS) -> DataFrame:
    """hour, day_of_week, is_weekend, is_business_hours from a timestamp."""
    return df.withColumns({"hour": hour_of(ts), "day_of_week": weekday_of(ts)}).withColumns(
        {"is_weekend": weekend_flag(), "is_business_hours": business_flag()}
    )


def expected_load_sql(hour: str = "hour", dow: str = "day_of_week") -> str:
    """Product of business, weekend and night load factors."""
    business = (
        f"(CASE WHEN {hour} BETWEEN {S.BUSINESS_HOUR_FIRST} AND {S.BUSINESS_HOUR_LAST} AND {dow} < {S.WEEKEND_FROM_DOW}"
        f" THEN {dbl(S.LOAD_BUSINESS)} ELSE {dbl(1)} END)"
    )
    weekend = f"(CASE WHEN {dow} >= {S.WEEKEND_FROM_DOW} THEN {dbl(S.LOAD_WEEKEND)} ELSE {dbl(1)} END)"
    night = f"(CASE WHEN {hour} < {S.NIGHT_BEFORE_HOUR} OR {hour} > {S.NIGHT_AFTER_HOUR} THEN {dbl(S.LOAD_NIGHT)} ELSE {dbl(1)} END)"
    return f"({business} * {weekend} * {night})"


def expected_load(hour: str = "hour", dow: str = "day_of_week") -> Column:
    return ex(expected_load_sql(hour, dow))


# ---------------------------------------------------------------------------
# features
# ---------------------------------------------------------------------------
def interaction_sql() -> dict[str, str]:
    conn1 = "(CAST(active_connections AS DOUBLE) + 1)"
    return {
        "cpu_memory_product": "cpu_usage * memory_usage",
        "resource_pressure": "(cpu_usage + memory_usage + disk_usage) / 3",
        "performance_ratio": ratio_sql("response_time_ms", conn1),
        "error_rate": ratio_sql("error_count", conn1),
    }


def stress_sql() -> dict[str, str]:
    out = {name: flag_sql(f"{src} > {thr}") for name, src, thr in S.STRESS_FLAGS}
    out["total_stress"] = " + ".join(out[name] for name, _, _ in S.STRESS_FLAGS)
    return out


def cyclic_sql(hour: str = "hour", dow: str = "day_of_week") -> dict[str, str]:
    two_pi = dbl(2 * math.pi)
    h, d = f"CAST({hour} AS DOUBLE)", f"CAST({dow} AS DOUBLE)"
    return {
        "hour_sin": f"sin({two_pi} * {h} / 24)",
        "hour_cos": f"cos({two_pi} * {h} / 24)",
        "day_sin": f"sin({two_pi} * {d} / 7)",
        "day_cos": f"cos({two_pi} * {d} / 7)",
    }


def _cols(d: dict[str, str]) -> dict[str, Column]:
    return {k: ex(v) for k, v in d.items()}


def interaction_exprs() -> dict[str, Column]:
    return _cols(interaction_sql())


def stress_exprs() -> dict[str, Column]:
    return _cols(stress_sql())


def cyclic_exprs(hour: str = "hour", dow: str = "day_of_week") -> dict[str, Column]:
    return _cols(cyclic_sql(hour, dow))


# ---------------------------------------------------------------------------
# scoring rules
# ---------------------------------------------------------------------------
def risk_sql(p: str) -> str:
    whens = " ".join(f"WHEN {p} >= {lo} THEN '{name}'" for lo, name in S.RISK_LEVELS)
    return f"CASE WHEN {p} IS NULL THEN CAST(NULL AS STRING) {whens} ELSE '{S.RISK_FLOOR_LEVEL}' END"


def risk_level(p: str) -> Column:
    return ex(risk_sql(p))


def confidence_raw_sql(p: str, mode: str = "reference") -> str:
    """Unrounded confidence. ``reference``: clamp(1 - |p - 0.5|, 0.6, 0.95)
    (highest for unsure scores, as the reference computes it); ``margin``:
    clamp(0.5 + |p - 0.5|)."""
    if mode == "reference":
        raw = f"({dbl(1)} - abs({p} - {dbl(0.5)}))"
    elif mode == "margin":
        raw = f"({dbl(0.5)} + abs({p} - {dbl(0.5)}))"
    else:
        raise ValueError(f"unknown confidence mode {mode!r}")
    return f"least(greatest({raw}, {dbl(S.CONFIDENCE_LO)}), {dbl(S.CONFIDENCE_HI)})"


def confidence_sql(p: str, mode: str = "reference") -> str:
    return round_even_sql(confidence_raw_sql(p, mode), S.CONFIDENCE_DIGITS)


def confidence(p: str, mode: str = "reference") -> Column:
    return ex(confidence_sql(p, mode))


def code_parts_sql(p: str) -> list[str]:
    """One CASE per rule, in rule order (urgency first, then six tiers)."""
    parts = [f"CASE WHEN {p} > {S.URGENT_ABOVE} THEN '{S.URGENT_CODE}' END"]
    for metric, crit, high, crit_code, high_code in S.RULE_TIERS:
        parts.append(f"CASE WHEN {metric} > {crit} THEN '{crit_code}' WHEN {metric} > {high} THEN '{high_code}' END")
    return parts


def compact_sql(parts: list[str], elem: str = "STRING") -> str:
    """Array of the non-NULL values of ``parts`` (CASE expressions giving a
    string or NULL), order kept. Same result as ``array_compact(array(...))``,
    but built from ``concat`` of one-element arrays, which stays inside
    whole-stage code generation (``array_compact`` becomes a lambda
    ``filter``, which is evaluated row by row outside it)."""
    empty = f"CAST(array() AS ARRAY<{elem}>)"
    if not parts:
        return empty
    one = [f"(CASE WHEN ({x}) IS NULL THEN {empty} ELSE array({x}) END)" for x in parts]
    return one[0] if len(one) == 1 else "concat(" + ", ".join(one) + ")"


def recommendation_codes_sql(p: str) -> str:
    codes = compact_sql(code_parts_sql(p))
    return f"CASE WHEN size({codes}) = 0 THEN array('{S.HEALTHY_CODE}') ELSE {codes} END"


def recommendation_codes(p: str) -> Column:
    """Array of rule codes in rule order; ``HEALTHY`` when no rule fires."""
    return ex(recommendation_codes_sql(p))


def recommendation_texts(codes: str) -> Column:
    """Text of each code, code order kept. Codes occur at most once and
    always in rule order (the order of ``RECOMMENDATION_TEXT``), so the texts
    are the rule-ordered texts whose code is present: no lambda, inside
    whole-stage code generation."""
    parts = [f"CASE WHEN array_contains({codes}, '{k}') THEN '{v}' END" for k, v in S.RECOMMENDATION_TEXT.items()]
    return ex(f"CASE WHEN {codes} IS NULL THEN NULL ELSE {compact_sql(parts)} END")


def regime_sql() -> str:
    parts = []
    for name, conds in S.REGIMES:
        pred = " AND ".join(f"{c} >= {lo}" for c, lo in conds)
        parts.append(f"WHEN {pred} THEN '{name}'")
    return "CASE " + " ".join(parts) + f" ELSE '{S.REGIME_DEFAULT}' END"


def regime_tag() -> Column:
    return ex(regime_sql())


def adjusted_response_sql() -> str:
    """response + 0.3 x latency, floored at 100, x1.5 when cpu > 80, x1.3 when
    memory > 85 (the metric rules' load-adjusted response)."""
    return (
        f"greatest(response_time_ms + {dbl(S.RESPONSE_LATENCY_SHARE)} * network_latency_ms, {dbl(S.RESPONSE_FLOOR)})"
        f" * (CASE WHEN cpu_usage > {S.RESPONSE_CPU_OVER} THEN {dbl(S.RESPONSE_CPU_FACTOR)} ELSE {dbl(1)} END)"
        f" * (CASE WHEN memory_usage > {S.RESPONSE_MEM_OVER} THEN {dbl(S.RESPONSE_MEM_FACTOR)} ELSE {dbl(1)} END)"
    )


def adjusted_response() -> Column:
    return ex(adjusted_response_sql())


# Bits an order column takes once shifted to be non-negative: timestamps are
# microseconds of years 1 to 9999 (|us| < 2^58), then the integer widths.
_ORDER_BITS = {"timestamp": 59, "timestamp_ntz": 59, "bigint": 64, "int": 32, "smallint": 16, "tinyint": 8, "date": 32}
_DECIMAL_BITS = 126  # 10^38 > 2^126


def packed_order_sql(df: DataFrame, cols: list[str]) -> str | None:
    """One DECIMAL(38,0) that orders rows exactly as ``struct(cols...)``
    does (ascending, lexicographic, NULL first), or None when the columns do
    not fit in 126 bits.

    A NULL part is 0; a value is shifted to 1 .. 2^b, so it takes b + 1
    bits; parts are packed most-significant first. ``max_by(x, <packed>)``
    then keeps fixed-width buffers and plans as a hash aggregate; with a
    struct ordering Spark falls back to a sort-based aggregate, which sorts
    every input row."""
    types = dict(df.dtypes)
    bits = [_ORDER_BITS.get(types.get(c, "")) for c in cols]
    if not cols or any(b is None for b in bits) or sum(b + 1 for b in bits) > _DECIMAL_BITS:
        return None
    out = None
    for c, b in zip(cols, bits):
        t = types[c]
        if t == "timestamp_ntz":
            v = ntz_micros_sql(q(c))
        elif t == "timestamp":
            v = f"unix_micros({q(c)})"
        elif t == "date":
            v = f"unix_date({q(c)})"
        else:
            v = q(c)
        part = f"(CASE WHEN {q(c)} IS NULL THEN 0BD ELSE CAST({v} AS DECIMAL(38,0)) + {2 ** (b - 1) + 1}BD END)"
        out = part if out is None else f"({out} * {2 ** (b + 1)}BD + {part})"
    return f"CAST({out} AS DECIMAL(38,0))"


def order_key_sql(df: DataFrame, cols: list[str]) -> str:
    """Packed order key when the columns fit, else ``struct(cols...)``."""
    return packed_order_sql(df, cols) or "struct(" + ", ".join(q(c) for c in cols) + ")"


def ntz_micros_sql(ts: str) -> str:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ value from its
    own fields (day number, hour, minute, seconds with fraction). No session
    zone enters: ``timestampdiff`` would read both ends in the session zone,
    where two wall-clock times of a DST gap become one instant."""
    return (
        f"(CAST(unix_date(CAST({ts} AS DATE)) AS BIGINT) * 86400000000 + CAST(hour({ts}) AS BIGINT) * 3600000000"
        f" + CAST(minute({ts}) AS BIGINT) * 60000000 + CAST(date_part('SECOND', {ts}) * 1000000 AS BIGINT))"
    )


def ntz_to_instant_sql(ts: str) -> str:
    """The TIMESTAMP whose UTC reading is the TIMESTAMP_NTZ value (event time
    for watermarks), with no session zone: ``CAST(ts AS TIMESTAMP)`` reads
    the wall clock in the session zone, where a DST gap shifts values."""
    return f"timestamp_micros({ntz_micros_sql(ts)})"


def instant_to_ntz_sql(t: str) -> str:
    """Back from ``ntz_to_instant_sql``: the UTC reading as TIMESTAMP_NTZ
    (epoch plus a day-time interval, zone-free)."""
    return f"(TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(unix_micros({t}) AS DECIMAL(18,0)) / 1000000))"


def order_micros(ts: str) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ column, no zone shift
    (order preserving; a numeric range key for bucketing)."""
    return ex(ntz_micros_sql(q(ts)))
