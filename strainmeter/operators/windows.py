"""History features over ordered series: rolling mean / max, lags with a mean
fill, and forward fill.

Two physical forms give identical values:

* ``per-series``: one window per series (``partitionBy(host)``); one exchange,
  one sort and one ``Window`` node for every feature.
* ``bucketed``: a series is cut into ranges of the order key
  (``series_ranges``: every series by its own quantiles, as many as its rows
  need, and a time that fills a range alone by the second order column, so a
  range holds about ``rows_per_bucket`` rows); windows run per ``(series,
  range)``. Each range gets a halo: the last rows before it, taken
  from the tails of earlier ranges, so row frames and lags see the rows they
  need. Forward fill, whose frame is unbounded, gets the last non-null value
  of every earlier range from a small table of range ends. This keeps a hot
  series (a third of all rows) from landing in one task.

Rows are counted per series: only series with more than ``rows_per_bucket``
rows take the bucketed form; all others share the per-series form, with no
copied row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from strainmeter import schema as S
from strainmeter import session
from strainmeter.functions.exprs import compact_sql, order_key_sql, order_micros
from strainmeter.session import DEFAULT_ROWS_PER_BUCKET

BUCKET = "_range_bucket"
HALO = "_is_halo"


@dataclass
class HistorySpec:
    """What to compute: rolling (out, src, 'mean'|'max', window), lags
    (out, src, n) with their gap fill value, and columns to forward fill."""

    rolling: list[tuple[str, str, str, int]] = field(default_factory=list)
    lags: list[tuple[str, str, int]] = field(default_factory=list)
    lag_fill: dict[str, float | None] = field(default_factory=dict)
    ffill: list[str] = field(default_factory=list)
    ffill_rolling: bool = True  # forward fill rolling outputs too

    @property
    def lookback(self) -> int:
        w = max([n - 1 for *_, n in self.rolling] + [n for *_, n in self.lags] + [0])
        return w


# at most this many quantile ranges in the first sketch; beyond, each of them
# is cut again by its own quantiles (keeps every sketch small)
MAX_QUANTILE_RANGES = 1024


@dataclass
class RangePlan:
    """Ordered ranges of a numeric order key over a whole table, cut at
    quantiles (``bounds``); rows of one value share a range. The bucket index
    is non-decreasing in the order key."""

    bounds: list[float] = field(default_factory=list)
    sub: int = 1  # ranges cut inside each range of the first sketch

    def __bool__(self) -> bool:
        return bool(self.bounds)

    @property
    def n_buckets(self) -> int:
        return len(self.bounds) + 1


def _quantile_cuts(num: DataFrame, cols: list[str], n_buckets: int, rel_err: float | None = None) -> tuple[dict[str, list[float]], int]:
    """Sorted cuts (repeated where one value spans several) and the number of
    ranges cut inside each range of the first sketch."""
    k = min(n_buckets, MAX_QUANTILE_RANGES)
    err = rel_err if rel_err is not None else min(0.01, 0.25 / k)
    first = num.approxQuantile(cols, [i / k for i in range(1, k)], err)
    cuts = {c: sorted(q) for c, q in zip(cols, first)}
    sub = -(-n_buckets // k)
    if sub == 1:
        return cuts, 1
    inner = ", ".join(repr(j / sub) + "D" for j in range(1, sub))
    for c in cols:
        coarse = with_range_bucket(num.select(c).filter(F.col(c).isNotNull()), F.col(c), RangePlan(sorted(set(cuts[c]))))
        per = coarse.groupBy(BUCKET).agg(F.expr(f"percentile_approx(`{c}`, array({inner}), {4 * sub})").alias("q"))
        cuts[c] = sorted(cuts[c] + [float(v) for row in per.collect() for v in row["q"]])  # cuts, never rows
    return cuts, sub


def range_bounds(df: DataFrame, order_num: Column, n_buckets: int, rel_err: float | None = None) -> RangePlan:
    """Ranges of a numeric order key holding about n / n_buckets rows each:
    quantile cuts from one ``approxQuantile`` job (relative error 1/4 of a
    range); beyond ``MAX_QUANTILE_RANGES`` each range is cut again by its own
    quantiles. Only the cuts reach the driver, never rows."""
    if n_buckets <= 1:
        return RangePlan()
    cuts, sub = _quantile_cuts(df.select(order_num.cast("double").alias("_o")), ["_o"], n_buckets, rel_err)
    return RangePlan(sorted(set(cuts["_o"])), sub)


def range_plans(df: DataFrame, cols: list[str], n_buckets: int) -> dict[str, RangePlan]:
    """``range_bounds`` for several numeric columns with one first sketch."""
    if n_buckets <= 1:
        return {c: RangePlan() for c in cols}
    cuts, sub = _quantile_cuts(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), cols, n_buckets)
    return {c: RangePlan(sorted(set(cuts[c])), sub) for c in cols}


def with_range_bucket(df: DataFrame, order_num: Column, plan: RangePlan | list[float], out: str = BUCKET) -> DataFrame:
    """Bucket index of the order key: binary search over the cuts in the JVM
    (``Bucketizer``). NULL keys sort first, as in the windows."""
    if isinstance(plan, list):
        plan = RangePlan(bounds=plan)
    if not plan:
        return df.withColumn(out, F.lit(0).cast("long"))
    d = df.withColumn("_order_num", F.coalesce(order_num.cast("double"), F.lit(-math.inf)))
    b = Bucketizer(splits=[-math.inf] + plan.bounds + [math.inf], inputCol="_order_num", outputCol="_bucket_d", handleInvalid="keep")
    return b.transform(d).withColumn(out, F.col("_bucket_d").cast("long")).drop("_order_num", "_bucket_d")


# a level cuts a group into at most this many ranges; two numbers a cut, for
# values that get a range of their own, still fit a step of the bucket index
RADIX = 64
_STEP = 2 * RADIX
_MOST_LEVELS = 8
# groups up to this many times the bound stay whole: quantiles are sketches
_LOOSE = 1.5


def series_ranges(df: DataFrame, part: list[str], order_num: Column, bound: int, tie: Column | None = None) -> DataFrame:
    """``df`` with a range number (BUCKET) per series of ``part``,
    non-decreasing in (``order_num``, ``tie``); ranges hold about ``bound``
    rows, and a series has about as many as its rows need.

    A tree of ranges: a level cuts every group (series, range so far) that is
    too large into at most ``RADIX`` ranges at its own quantiles. A value that
    fills a range alone gets a range of its own, which the next level cuts by
    ``tie``. So every series has its own cuts, whatever times it covers, and
    every heavy time as many tie cuts as its rows need. A level is one count
    and one quantile sketch per group (partial aggregates); cuts are a written
    table, joined by group. Rows equal in both columns stay together."""
    spark = df.sparkSession
    keys = [f"_g{i}" for i in range(len(part))]
    low = -(1 << 62)
    rows = df.withColumns(
        {k: F.col(c) for k, c in zip(keys, part)}
        | {
            BUCKET: F.lit(0).cast("long"),
            "_o": F.coalesce(order_num.cast("long"), F.lit(low)),
            "_t": F.coalesce(tie.cast("long"), F.lit(low)) if tie is not None else F.lit(0).cast("long"),
        }
    )
    grid = ", ".join(f"{i / RADIX}D" for i in range(1, RADIX))
    for level in range(_MOST_LEVELS):
        # one group of all rows: its cuts are constants, not a join
        alone = not keys and level == 0
        groups = rows.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_n"), F.min("_o").alias("_lo"), F.max("_o").alias("_hi"), F.min("_t").alias("_tl"), F.max("_t").alias("_th"))
        large = groups.filter((F.col("_n") > _LOOSE * bound) & ((F.col("_lo") < F.col("_hi")) | (F.col("_tl") < F.col("_th"))))
        large = large.select(*keys, BUCKET, "_n", (F.col("_lo") < F.col("_hi")).alias("_by_o"))
        path = session.shared_path(spark, "range-groups")
        large.write.parquet(path)
        large = spark.read.schema(large.schema).parquet(path)
        n_large = large.count()
        if not n_large:
            break
        ranges = F.least(F.ceil(F.col("_n") / bound), F.lit(RADIX))
        value = F.when(F.col("_by_o"), F.col("_o")).otherwise(F.col("_t"))
        inside = _with_row(rows, large) if alone else _joined(rows, bounded_broadcast(large, n_large), [*keys, BUCKET], "inner")
        sketched = inside.withColumn("_v", value).groupBy(*keys, BUCKET, "_by_o", "_n").agg(F.expr(f"percentile_approx(_v, array({grid}), {16 * RADIX})").alias("_q"))
        sketched = sketched.withColumn("_r", ranges.cast("int")).selectExpr(
            *keys,
            BUCKET,
            "_by_o",
            f"transform(sequence(1, _r - 1), i -> _q[CAST(floor(i * {RADIX} / _r) AS INT) - 1]) AS _even",
            # neighbours of the grid that are equal: the value fills 1 / RADIX
            # of the group; it is heavy when that is about a range
            "filter(array_distinct(_q), v -> size(filter(_q, w -> w = v)) >= greatest(2, CAST(floor(%d / _r) AS INT))) AS _heavy" % RADIX,
        )
        cuts = sketched.selectExpr(*keys, BUCKET, "_by_o", "array_union(_even, _heavy) AS _cuts", "_heavy")
        path = session.shared_path(spark, "range-cuts")
        cuts.write.parquet(path)
        cuts = spark.read.schema(cuts.schema).parquet(path)
        step = "CASE WHEN _cuts IS NULL THEN 0 ELSE size(filter(_cuts, c -> c <= _v)) + size(filter(_heavy, h -> h < _v)) END"
        told = _with_row(rows, cuts) if alone else _joined(rows, bounded_broadcast(cuts, n_large), [*keys, BUCKET], "left")
        told = told.withColumn("_v", value)
        rows = told.withColumn(BUCKET, F.col(BUCKET) * _STEP + F.expr(step)).drop("_by_o", "_cuts", "_heavy", "_v")
    return rows.drop(*keys, "_o", "_t")


def _with_row(rows: DataFrame, one: DataFrame) -> DataFrame:
    """``rows`` with the columns of a one-row table that they lack, as
    constants: numbers, or at most two lists of ``RADIX`` cuts."""
    row = one.first()
    made = {f.name: F.lit(row[f.name]) if not isinstance(row[f.name], list) else F.array(*[F.lit(x) for x in row[f.name]]).cast(f.dataType) for f in one.schema.fields if f.name not in rows.columns}
    return rows.withColumns(made)


def _joined(rows: DataFrame, groups: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join by group; a NULL key is a group of its own."""
    named = groups.withColumnsRenamed({k: f"_of{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of{k}")) for k in keys])
    return rows.join(named, same, how).drop(*[f"_of{k}" for k in keys])


def bound_for(df: DataFrame, part: list[str], n_buckets: int) -> int:
    """Rows a range has when the largest series is cut into ``n_buckets``."""
    most = df.groupBy(*part).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return max(1, math.ceil((most or 0) / n_buckets))


def bounded_broadcast(df: DataFrame, rows_bound: int) -> DataFrame:
    """Broadcast hint only for a table whose row count is proven to be at
    most ``session.BROADCAST_ROWS``. Beyond it the join stays a shuffle join;
    AQE still broadcasts when the runtime size turns out small."""
    return F.broadcast(df) if rows_bound <= session.BROADCAST_ROWS else df


def by_series_size(df: DataFrame, part: list[str], rows_per_bucket: int) -> list[tuple[DataFrame, int | None]]:
    """[(rows, bound)]: the series that fit one task together, with None, and
    the hot series, if any, with the rows that a range of them may have.
    Series are counted in one aggregate. A table that is one series (no
    ``part``) is cut for two waves of tasks on every core once it is worth
    it, whatever a task could hold: else its rows keep few cores busy."""
    if not part:
        n = df.count()
        waves = 2 * df.sparkSession.sparkContext.defaultParallelism
        bound = min(rows_per_bucket, max(session.LEAST_RANGE_ROWS, math.ceil(n / waves)))
        return [(df, bound if n > min(rows_per_bucket, 4 * bound) else None)]
    hot = df.groupBy(*part).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_bucket)
    n_hot = hot.count()
    if not n_hot:
        return [(df, None)]
    names = bounded_broadcast(hot.select(*[F.col(c).alias(f"_hot_{c}") for c in part]), n_hot)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in part])
    return [(df.join(names, same, "left_anti"), None), (df.join(names, same, "left_semi"), rows_per_bucket)]


def sized_groups(df: DataFrame, part: list[str], rows_per_bucket: int, n_buckets: int | None) -> list[tuple[DataFrame, int | None]]:
    """``by_series_size``, or every series cut as ``n_buckets`` says."""
    if n_buckets is None:
        return by_series_size(df, part, rows_per_bucket)
    return [(df, bound_for(df, part, n_buckets) if n_buckets > 1 else None)]


def n_buckets_for(df: DataFrame, rows_per_bucket: int) -> int:
    n = df.count()
    return max(1, math.ceil(n / max(1, rows_per_bucket)))


def _q(c: str) -> str:
    return f"`{c}`"


def _over(part: list[str], order: list[str], frame: str | None = None) -> str:
    p = ("PARTITION BY " + ", ".join(_q(c) for c in part) + " ") if part else ""
    o = "ORDER BY " + ", ".join(_q(c) for c in order)
    return f"OVER ({p}{o}{' ' + frame if frame else ''})"


RUNNING = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _window_exprs(spec: HistorySpec, part: list[str], order: list[str]) -> dict[str, str]:
    """Window functions only (SQL text), each computed once: running last
    non-null per forward-filled source, raw rolling aggregates, raw lags."""
    out: dict[str, str] = {}
    for src in _ffill_sources(spec):
        out[f"_seen_{src}"] = f"last({_q(src)}, true) {_over(part, order, RUNNING)}"
    for name, src, how, n in spec.rolling:
        fn = "avg" if how == "mean" else "max"
        out[f"_roll_{name}"] = f"{fn}({_q(src)}) {_over(part, order, f'ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW')}"
    for name, src, n in spec.lags:
        out[f"_lag_{name}"] = f"lag({_q(src)}, {n}) {_over(part, order)}"
    return out


def _combine_exprs(spec: HistorySpec, carry: set[str] | None) -> dict[str, str]:
    """Final columns from the window outputs (plain projection, SQL text)."""
    carry = carry or set()

    def seen(src: str) -> str:
        run = _q(f"_seen_{src}")
        return f"coalesce({run}, {_q(f'_carry_{src}')})" if src in carry else run

    out: dict[str, str] = {}
    for name, src, _, _ in spec.rolling:
        val = f"CAST({_q(f'_roll_{name}')} AS DOUBLE)"
        out[name] = f"coalesce({val}, CAST({seen(src)} AS DOUBLE))" if spec.ffill_rolling else val
    for name, src, _ in spec.lags:
        fill = spec.lag_fill.get(src)
        val = f"CAST({_q(f'_lag_{name}')} AS DOUBLE)"
        out[name] = f"coalesce({val}, CAST({float(fill)!r} AS DOUBLE))" if fill is not None else val
    for c in spec.ffill:
        out[c] = seen(c)
    return out


def _apply(df: DataFrame, spec: HistorySpec, part: list[str], order: list[str], carry, final_cols: list[str], post=None) -> DataFrame:
    """Window node, then one projection to the final columns (``post(name,
    sql)`` may wrap each final column, e.g. the zero fill)."""
    win = df.selectExpr("*", *[f"{e} AS {_q(n)}" for n, e in _window_exprs(spec, part, order).items()])
    comb = _combine_exprs(spec, carry)
    sel = []
    for c in final_cols:
        e = comb.get(c, _q(c))
        sel.append(f"{post(c, e) if post else e} AS {_q(c)}")
    return win.selectExpr(*sel)


def _ffill_sources(spec: HistorySpec) -> list[str]:
    srcs = list(spec.ffill)
    if spec.ffill_rolling:
        for _, src, _, _ in spec.rolling:
            if src not in srcs:
                srcs.append(src)
    return srcs


def history_features(
    df: DataFrame,
    spec: HistorySpec,
    partition_cols: list[str] | tuple[str, ...] = (S.HOST,),
    order_cols: list[str] | tuple[str, ...] = (S.TS, S.KEY),
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    n_buckets: int | None = None,
    ts_col: str = S.TS,
    post=None,
    seed: tuple[DataFrame, str] | None = None,
    bound: int | None = None,
) -> DataFrame:
    """Add rolling, lag and forward-filled columns per series (see module doc).
    ``post(name, column)`` may wrap every output column (e.g. a zero fill).
    ``seed`` (rows, prefix) gives the value last seen before a series' first
    row: at most one row a series, a column ``prefix + source`` each."""
    part, order = list(partition_cols), list(order_cols)
    final_cols = list(df.columns) + [c for c in _out_names(spec) if c not in df.columns]
    groups = [(df, bound)] if bound is not None else sized_groups(df, part, rows_per_bucket, n_buckets)
    done = [
        _apply(_seeded(rows, spec, part, seed), spec, part, order, set(_ffill_sources(spec)) if seed else None, final_cols, post)
        if most is None
        else _bucketed(rows, spec, part, order, most, ts_col, final_cols, post, seed)
        for rows, most in groups
    ]
    return reduce(DataFrame.unionByName, done)


def _seeded(rows: DataFrame, spec: HistorySpec, part: list[str], seed: tuple[DataFrame, str] | None) -> DataFrame:
    """Rows with ``_carry_<source>`` from the seed of their series."""
    if seed is None:
        return rows
    before, prefix = seed
    before = before.select(*[F.col(c).alias(f"_seed_{c}") for c in part], *[F.col(prefix + c).alias(f"_carry_{c}") for c in _ffill_sources(spec)])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_seed_{c}")) for c in part])
    return rows.join(before, same, "left").drop(*[f"_seed_{c}" for c in part])


def _tie_column(df: DataFrame, order: list[str]) -> Column | None:
    """The second order column, if it is a number ranges can be cut on."""
    return F.col(order[1]) if len(order) > 1 and isinstance(df.schema[order[1]].dataType, NumericType) else None


def _bucketed(
    df: DataFrame, spec: HistorySpec, part: list[str], order: list[str], bound: int, ts_col: str, final_cols: list[str], post=None, seed=None
) -> DataFrame:
    base = series_ranges(df, part, order_micros(ts_col), bound, _tie_column(df, order))
    h = spec.lookback
    cols = list(df.columns)

    # halo: the last h rows before each range, from the tails of earlier ranges
    main = base.withColumn(HALO, F.lit(False))
    if h > 0:
        w_tail = Window.partitionBy(*part, BUCKET).orderBy(*[F.col(c).desc() for c in order])
        tails = base.withColumn("_rd", F.row_number().over(w_tail)).filter(F.col("_rd") <= h).drop("_rd")
        w_series = Window.partitionBy(*part).orderBy(*order)
        leads = [F.lead(BUCKET, k).over(w_series) for k in range(1, h + 1)]
        # ranges of the next h tail rows, other than this row's own (no lambda:
        # the projection stays in generated code)
        nxt = [F.when(t != F.col(BUCKET), t) for t in leads]
        targets = F.array_distinct(F.expr(compact_sql(["_n%d" % i for i in range(h)], "BIGINT")))
        tails = tails.select("*", *[c.alias("_n%d" % i) for i, c in enumerate(nxt)])
        halo = (
            tails.withColumn("_targets", targets)
            .withColumn(BUCKET, F.explode("_targets"))
            .drop("_targets", *["_n%d" % i for i in range(h)])
            .withColumn(HALO, F.lit(True))
        )
        main = main.unionByName(halo.select(*main.columns))

    # carry for forward fill: last non-null value of every earlier range
    srcs = _ffill_sources(spec)
    carry_cols: set[str] = set()
    joined = main
    if srcs:
        okey = order_key_sql(base, order)
        ends = base.groupBy(*part, BUCKET).agg(
            *[F.expr(f"max_by({_q(c)}, CASE WHEN {_q(c)} IS NOT NULL THEN {okey} END)").alias(f"_end_{c}") for c in srcs]
        )
        before = _over(part, [BUCKET], "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
        carry = ends.selectExpr(
            *[_q(c) for c in part], BUCKET, *[f"last({_q(f'_end_{c}')}, true) {before} AS {_q(f'_carry_{c}')}" for c in srcs]
        )
        if seed is not None:  # what was seen before the series' first range
            first = _seeded(carry.withColumnsRenamed({f"_carry_{c}": f"_later_{c}" for c in srcs}), spec, part, seed)
            carry = first.select(*part, BUCKET, *[F.coalesce(f"_later_{c}", f"_carry_{c}").alias(f"_carry_{c}") for c in srcs])
        joined = main.join(carry, on=[*part, BUCKET], how="left")
        carry_cols = set(srcs)

    return _apply(joined, spec, [*part, BUCKET], order, carry_cols, final_cols + [HALO], post).filter(~F.col(HALO)).drop(HALO)


def _out_names(spec: HistorySpec) -> list[str]:
    return [n for n, *_ in spec.rolling] + [n for n, *_ in spec.lags]


def forward_fill(
    df: DataFrame,
    cols: list[str],
    partition_cols=(S.HOST,),
    order_cols=(S.TS, S.KEY),
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    n_buckets: int | None = None,
    bound: int | None = None,
) -> DataFrame:
    """Carry the last non-null value forward per series."""
    spec = HistorySpec(ffill=list(cols), ffill_rolling=False)
    return history_features(df, spec, partition_cols, order_cols, rows_per_bucket, n_buckets, bound=bound)


def column_means(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Whole-table means (NULL skipped) in one aggregate; a few scalars."""
    row = df.agg(*[F.avg(F.col(c)).alias(c) for c in cols]).first()
    return {c: (None if row[c] is None else float(row[c])) for c in cols}
