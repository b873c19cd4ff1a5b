"""Monitoring operators: drift, performance against actuals, counters,
quantiles, latest values per entity, sustained alerts, roll-ups and
forward-looking failure labels.

Everything is a composition of aggregates and windows; per-series windows
use range buckets (windows.py) so a hot series is split over many tasks.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from strainmeter import schema as S
from strainmeter.functions import exprs as X
from strainmeter.functions.exprs import order_micros
from strainmeter.operators.evaluate import confusion_metrics
from strainmeter.operators.ranking import bounded_broadcast
from strainmeter.operators.windows import (
    BUCKET,
    HistorySpec,
    forward_fill,
    history_features,
    n_buckets_for,
    range_plans,
    series_ranges,
    sized_groups,
    with_range_bucket,
)
from strainmeter.session import DEFAULT_ROWS_PER_BUCKET

KS_TERMS = 6  # terms of each series; both converge to 1e-15 on their side of 1.18
KS_SWITCH = 1.18


# ---------------------------------------------------------------------------
# Kolmogorov-Smirnov drift
# ---------------------------------------------------------------------------
def kolmogorov_sf_sql(lam: str, terms: int = KS_TERMS) -> str:
    """Kolmogorov's survival function Q(lam), evaluated as usual in two forms:
    below 1.18 by the theta series 1 - sqrt(2 pi)/lam sum exp(-(2k-1)^2 pi^2 /
    (8 lam^2)), above by 2 sum (-1)^(k-1) exp(-2 k^2 lam^2); clipped to [0, 1].
    SQL text valid in Spark and DuckDB."""
    small = " + ".join(f"exp({-((2 * k - 1) ** 2) * math.pi**2 / 8.0!r} / ({lam} * {lam}))" for k in range(1, terms + 1))
    large = " + ".join(f"{2.0 * (-1) ** (k - 1)!r} * exp({-2.0 * k * k!r} * {lam} * {lam})" for k in range(1, terms + 1))
    qv = f"CASE WHEN {lam} < {KS_SWITCH} THEN 1.0 - {math.sqrt(2 * math.pi)!r} / {lam} * ({small}) ELSE {large} END"
    return f"CAST(CASE WHEN {lam} <= 0 THEN 1.0 ELSE least(greatest({qv}, 0.0), 1.0) END AS DOUBLE)"


def kolmogorov_sf(lam: str) -> Column:
    return F.expr(kolmogorov_sf_sql(lam))


def _long(df: DataFrame, cols: list[str], sample: str) -> DataFrame:
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE), CAST(`{c}__b` AS INT)" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, value, {BUCKET})").filter("value IS NOT NULL").withColumn(
        "sample", F.lit(sample)
    )


def ks_drift(
    reference: DataFrame,
    current: DataFrame,
    cols: list[str] | None = None,
    threshold: float = S.DRIFT_P_THRESHOLD,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    n_buckets: int | None = None,
) -> DataFrame:
    """Two-sample KS test per shared column: statistic, p-value, drift flag
    (p < threshold). Exact statistic; all columns in one job.

    Long form (column, value, sample); each column is cut into its own
    value ranges (quantiles of both samples), counts per (column,
    value) are prefix-summed per range and offset by the earlier ranges, so
    no column lands in one task. p-value: exact (``ks_exact_sql``) while
    n m <= ``KS_EXACT_PAIRS``, beyond it Kolmogorov's limit law at
    sqrt(n m / (n + m)) D."""
    if cols is None:  # every number both tables have, but for the row's names
        numeric = [{f.name for f in d.schema.fields if isinstance(f.dataType, NumericType)} for d in (reference, current)]
        cols = [c for c in reference.columns if c in numeric[0] & numeric[1] and c not in (S.KEY, S.HOST)]
    # cuts from both samples: a shifted one would else fall in one range
    both = reference.select(*cols).unionByName(current.select(*cols))
    if n_buckets is None:
        n_buckets = n_buckets_for(both, rows_per_bucket)
    plans = range_plans(both, cols, n_buckets)

    plain = all(p.bounds for p in plans.values())

    def bucketed(df: DataFrame) -> DataFrame:
        d = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
        if plain:  # one multi-column binary search
            splits = [[-math.inf] + plans[c].bounds + [math.inf] for c in cols]
            b = Bucketizer(splitsArray=splits, inputCols=cols, outputCols=[f"{c}__b" for c in cols], handleInvalid="keep")
            return b.transform(d)
        for c in cols:
            d = with_range_bucket(d, F.col(c), plans[c], out=f"{c}__b")
        return d

    long = _long(bucketed(reference), cols, "a").unionByName(_long(bucketed(current), cols, "b"))
    per_value = long.groupBy("column_name", BUCKET, "value").agg(
        F.count_if(F.col("sample") == "a").alias("cnt_a"), F.count_if(F.col("sample") == "b").alias("cnt_b")
    )
    per_bucket = per_value.groupBy("column_name", BUCKET).agg(F.sum("cnt_a").alias("sum_a"), F.sum("cnt_b").alias("sum_b"))
    wb = Window.partitionBy("column_name").orderBy(BUCKET)
    offsets = per_bucket.select(
        "column_name",
        BUCKET,
        F.coalesce(F.sum("sum_a").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off_a"),
        F.coalesce(F.sum("sum_b").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off_b"),
        F.sum("sum_a").over(Window.partitionBy("column_name")).alias("tot_a"),
        F.sum("sum_b").over(Window.partitionBy("column_name")).alias("tot_b"),
    )
    # columns x ranges rows: bounded by the caller's column list and the
    # range count; broadcast while that bound is small
    n_ranges = max(p.n_buckets for p in plans.values())
    j = per_value.join(bounded_broadcast(offsets, len(cols) * n_ranges), on=["column_name", BUCKET])
    w = Window.partitionBy("column_name", BUCKET).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    cdf = j.select(
        "column_name",
        "tot_a",
        "tot_b",
        F.abs((F.col("off_a") + F.sum("cnt_a").over(w)) / F.col("tot_a") - (F.col("off_b") + F.sum("cnt_b").over(w)) / F.col("tot_b")).alias("gap"),
    )
    stat = cdf.groupBy("column_name").agg(F.max("gap").alias("ks_statistic"), F.first("tot_a").alias("n_ref"), F.first("tot_b").alias("n_cur"))
    stat = stat.withColumn("_lam", F.expr("sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) * ks_statistic"))
    p_value = F.when(F.col("n_ref") * F.col("n_cur") <= KS_EXACT_PAIRS, F.expr(ks_exact_sql())).otherwise(kolmogorov_sf("_lam"))
    return stat.withColumn("p_value", p_value).withColumn("drift_detected", F.col("p_value") < threshold).drop("_lam")


#: Samples of at most this many pairs get the exact p-value.
KS_EXACT_PAIRS = 10_000


def ks_exact_sql(n: str = "n_ref", m: str = "n_cur", d: str = "ks_statistic") -> str:
    """P(D >= d) of two samples of n and m values without ties, exactly: one
    less the share of lattice paths from (0, 0) to (n, m) that stay inside
    |i / n - j / m| < d. The share of paths to (i, j) is i / (i + j) of that to
    (i - 1, j) plus j / (i + j) of that to (i, j - 1), and 0 outside; rows of
    this triangle are folded one after another. d is a multiple of 1 / (n m),
    so the bound is a whole number."""
    k = f"CAST(round({d} * {n} * {m}) AS BIGINT)"
    first = f"aggregate(sequence(1L, {m}), array(1D), (u, j) -> concat(u, array(CASE WHEN j * {n} < {k} THEN element_at(u, -1) ELSE 0D END)))"
    step = f"CASE WHEN abs(i * {m} - j * {n}) < {k} THEN (i * u[CAST(j AS INT)] + j * element_at(r, -1)) / (i + j) ELSE 0D END"
    row = f"aggregate(sequence(1L, {m}), array(CASE WHEN i * {m} < {k} THEN u[0] ELSE 0D END), (r, j) -> concat(r, array({step})))"
    inside = f"element_at(aggregate(sequence(1L, {n}), {first}, (u, i) -> {row}), -1)"
    return f"CASE WHEN {k} <= 0 THEN 1D ELSE 1 - {inside} END"


# ---------------------------------------------------------------------------
# performance and counters
# ---------------------------------------------------------------------------
def performance_monitor(
    predictions: DataFrame,
    actuals: DataFrame,
    key: str = S.KEY,
    pred_col: str = "prediction",
    label: str = S.LABEL,
    by_day: str | None = None,
) -> DataFrame:
    """Accuracy, precision, recall (and F1) of predictions against actuals,
    joined on the key; optionally per day of ``by_day``."""
    j = predictions.join(actuals.select(key, label), on=key, how="inner")
    by = None
    if by_day:
        j = j.withColumn("day", F.to_date(F.col(by_day)))
        by = ["day"]
    return confusion_metrics(j, label, pred_col, by=by)


def prediction_counters(predictions: DataFrame, above: float = S.ALERT_ABOVE, by: list[str] | None = None) -> DataFrame:
    """Predictions per model (and group), count and share above a bound."""
    p = F.col("failure_probability")
    return (
        predictions.groupBy("model_used", *(by or []))
        .agg(F.count(F.lit(1)).alias("n_predictions"), F.count_if(p > above).alias("n_above"))
        .withColumn("share_above", F.col("n_above") / F.col("n_predictions"))
    )


def latency_quantile(
    df: DataFrame,
    value: str,
    q: float = 0.95,
    ts: str = S.TS,
    bucket: str = "1 hour",
    exact: bool = True,
    accuracy: int = 10000,
    n_buckets: int | None = None,
) -> DataFrame:
    """q-quantile of a duration per time bucket, with linear interpolation
    between the two order statistics around (n - 1) q.

    ``exact``: counts per (bucket, value) in a partial aggregate, a two-level
    running count over the values of each bucket, then the two order
    statistics picked by a partial min-aggregate; no bucket's values are
    ever held by one task. Otherwise ``percentile_approx`` (bounded sketch)."""
    start = F.window(F.col(ts).cast("timestamp_ntz"), bucket)["start"]
    name = f"p{int(round(q * 100))}"
    src = df.select(start.alias("bucket_start"), F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    if not exact:
        return src.groupBy("bucket_start").agg(
            F.percentile_approx("_v", q, accuracy).cast("double").alias(name), F.count(F.lit(1)).alias("n")
        )
    from strainmeter.operators.ranking import running_sums

    per_value = src.groupBy("bucket_start", "_v").agg(F.count(F.lit(1)).alias("_c"))
    cum = running_sums(per_value, "_v", ["_c"], partition_cols=["bucket_start"], n_buckets=n_buckets)
    totals = per_value.groupBy("bucket_start").agg(F.sum("_c").alias("n"))
    j = cum.join(totals, on="bucket_start")
    pos = F.expr(f"CAST(n - 1 AS DOUBLE) * {float(q)!r}")
    lo_rank = F.floor(pos)
    picked = j.groupBy("bucket_start", "n").agg(
        F.min(F.when(F.col("cum__c") > lo_rank, F.col("_v"))).alias("_lo"),
        F.min(F.when(F.col("cum__c") > lo_rank + 1, F.col("_v"))).alias("_hi"),
        F.first(pos - lo_rank).alias("_frac"),
    )
    val = F.col("_lo") + F.col("_frac") * (F.coalesce(F.col("_hi"), F.col("_lo")) - F.col("_lo"))
    return picked.select("bucket_start", val.alias(name), F.col("n").cast("long").alias("n"))


# accuracy of a sketch: its k (size about 1 / rank error)
KLL_K = 400


def quantile_sketches(df: DataFrame, value: str, ts: str = S.TS, bucket: str = "1 minute", k: int = KLL_K) -> DataFrame:
    """(bucket_start, n, sketch): one mergeable KLL sketch of a duration per
    time bucket, to be stored: later reports merge sketches instead of reading
    rows again. NULL and NaN don't count."""
    start = F.window(F.col(ts).cast("timestamp_ntz"), bucket)["start"]
    src = df.select(start.alias("bucket_start"), F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")).alias("_v")).filter(F.col("_v").isNotNull())
    return src.groupBy("bucket_start").agg(F.count(F.lit(1)).alias("n"), F.expr(f"kll_sketch_agg_double(_v, {k})").alias("sketch"))


def merged_quantile(sketches: DataFrame, q: float = 0.95, bucket: str = "1 day") -> DataFrame:
    """(bucket_start, n, p<q>) per wider bucket from stored sketches. The
    value's rank is within the sketch's error (about 1.33 % of the rows for
    k = 200, less than half of it for k = 400) of the exact one's. Merging is
    an aggregate with partial merges: no bucket's sketches meet in one list."""
    start = F.window(F.col("bucket_start"), bucket)["start"]
    parts = sketches.select(start.alias("_wide"), "n", "sketch").groupBy(F.col("_wide").alias("bucket_start"))
    merged = parts.agg(F.sum("n").alias("n"), F.expr("kll_merge_agg_double(sketch)").alias("_s"))
    return merged.select("bucket_start", "n", F.expr(f"kll_sketch_get_quantile_double(_s, {float(q)!r}D)").alias(f"p{int(round(q * 100))}"))


# ---------------------------------------------------------------------------
# latest values per entity
# ---------------------------------------------------------------------------
def latest_features(
    features: DataFrame,
    entities: DataFrame,
    names: list[str],
    entity: str = S.HOST,
    as_of: str | None = None,
    ts: str = S.TS,
) -> DataFrame:
    """Latest row (by ts, key) of each listed entity, at or before ``as_of``:
    one partial aggregate per entity (max_by), then a join to the list."""
    f = features
    if as_of is not None:
        f = f.filter(F.col(ts) <= F.lit(as_of).cast("timestamp_ntz"))
    okey = X.packed_order_sql(f, [ts, S.KEY])
    if okey is None:
        latest = f.groupBy(entity).agg(F.max_by(F.struct(ts, *names), F.struct(ts, S.KEY)).alias("_l"))
        latest = latest.select(entity, *[F.col(f"_l.{c}").alias(c) for c in [ts, *names]])
    else:
        # (ts, key) names one row: every column's max_by picks that row; the
        # packed key keeps the aggregate hash-based (no sort of the input)
        latest = f.groupBy(entity).agg(*[F.expr(f"max_by(`{c}`, {okey})").alias(c) for c in [ts, *names]])
    return entities.select(entity).distinct().join(latest, on=entity, how="left").select(entity, ts, *names)


def features_as_of(
    requests: DataFrame,
    features: DataFrame,
    names: list[str],
    entity: str = S.HOST,
    at: str = "as_of",
    ts: str = S.TS,
    key: str = S.KEY,
    max_age: str | None = None,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    n_buckets: int | None = None,
) -> DataFrame:
    """Point-in-time lookup: each request row (``entity``, time ``at``, any
    other columns) with the entity's latest feature row at or before its own
    time, by (ts, key): ``feature_ts`` and ``names``, NULL where there is
    none, or none younger than ``max_age``.

    As a union, not a join: features and requests of an entity share one
    sorted pass, in which each request sees the last feature row carried
    forward. No pair of rows is ever formed, so an entity with many requests
    and many feature rows costs their sum; a hot entity is split into ranges
    (windows.py). A feature row may hold NULLs: the row is carried, not its
    values. Requests with a NULL time find nothing; a NULL entity is an
    entity of its own. Repeated requests stay."""
    given = requests.columns
    row = F.struct(F.col(ts).alias("feature_ts"), *names)
    told = features.filter(F.col(ts).isNotNull()).select(
        F.col(entity).alias("_entity"), F.col(ts).cast("timestamp_ntz").alias("_at"), F.col(key).cast("long").alias("_tie"), row.alias("_row")
    )
    asked = requests.select(
        F.col(entity).alias("_entity"),
        F.col(at).cast("timestamp_ntz").alias("_at"),
        F.lit((1 << 63) - 1).cast("long").alias("_tie"),  # after every feature row of its time
        F.struct(*[F.col(c) for c in given]).alias("_request"),
    )
    both = told.unionByName(asked, allowMissingColumns=True)
    spec = HistorySpec(ffill=["_row"], ffill_rolling=False)
    found = history_features(both, spec, ("_entity",), ("_at", "_tie"), rows_per_bucket, n_buckets, ts_col="_at")
    found = found.filter(F.col("_request").isNotNull())
    near = F.col("_row") if max_age is None else F.when(F.col("_row.feature_ts") >= F.col("_at") - F.expr(f"INTERVAL {max_age}"), F.col("_row"))
    return found.withColumn("_row", near).select("_request.*", "_row.*")


# ---------------------------------------------------------------------------
# sustained alert (batch): gaps and islands
# ---------------------------------------------------------------------------
def sustained_alerts(
    scored: DataFrame,
    above: float = S.ALERT_ABOVE,
    for_seconds: int = S.ALERT_FOR_SECONDS,
    p_col: str = "failure_probability",
    partition_cols=(S.HOST,),
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    n_buckets: int | None = None,
) -> DataFrame:
    """One row per island of consecutive rows with p > bound that lasts at
    least ``for_seconds``: start, firing time (first row at or after start +
    for), end, rows.

    A row that is hot after one that isn't starts an island; its (ts, key) is
    carried forward over the series, so start, firing time, end and size are
    one partial aggregate of the hot rows per island, with no join. The lag
    and the carry share one shuffle and sort; a hot series is split into
    ranges (windows.py)."""
    part = list(partition_cols)
    df = scored.select(*part, S.TS, S.KEY, F.expr(f"CAST(coalesce(`{p_col}` > {above!r}, false) AS INT)").alias("_hot"))
    groups = sized_groups(df, part, rows_per_bucket, n_buckets)

    def islands(rows: DataFrame, bound: int | None) -> DataFrame:
        cut = {"bound": bound} if bound is not None else {"n_buckets": 1}
        d = history_features(rows, HistorySpec(lags=[("_prev", "_hot", 1)]), part, **cut)
        first = (F.col("_hot") == 1) & (F.coalesce(F.col("_prev"), F.lit(0)) == 0)
        d = d.withColumns({"island_start": F.when(first, F.col(S.TS)), "_start_key": F.when(first, F.col(S.KEY))}).drop("_prev")
        d = forward_fill(d, ["island_start", "_start_key"], part, **cut).filter("_hot = 1")
        fire_from = F.col("island_start") + F.make_dt_interval(secs=F.lit(for_seconds))
        return d.groupBy(*part, "island_start", "_start_key").agg(
            F.min(F.when(F.col(S.TS) >= fire_from, F.col(S.TS))).alias("fired_at"),
            F.max(S.TS).alias("island_end"),
            F.count(F.lit(1)).alias("n_rows"),
        )

    found = reduce(DataFrame.unionByName, [islands(rows, n) for rows, n in groups])
    return found.filter(F.col("fired_at").isNotNull()).select(*part, "island_start", "fired_at", "island_end", "n_rows")


# ---------------------------------------------------------------------------
# roll-up and forward-looking labels
# ---------------------------------------------------------------------------
def sample_rollup(events: DataFrame, n_hosts: int = 16, window: str = S.ROLLUP_WINDOW, approx_distinct: bool = False) -> DataFrame:
    """Raw events -> one row per host and 5-minute window (partial + final
    aggregation on the window key)."""
    e = events.withColumn(S.HOST, F.col("user_id") % n_hosts)
    users = F.approx_count_distinct("user_id") if approx_distinct else F.countDistinct("user_id")
    out = e.groupBy(S.HOST, F.window(F.col("ts"), window).alias("w")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("event_type") == "error").alias("n_errors"),
        F.avg("value").alias("mean_value"),
        F.max("value").alias("max_value"),
        users.alias("n_users"),
    )
    return out.select(S.HOST, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_events", "n_errors", "mean_value", "max_value", "n_users")


def failure_label(
    df: DataFrame,
    failure: Column,
    horizon_seconds: int = S.FAILURE_HORIZON_SECONDS,
    partition_cols=(S.HOST,),
    out: str = S.LABEL,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    n_buckets: int | None = None,
) -> DataFrame:
    """1 when a failure event of the same series falls in (ts, ts + horizon].

    Same as asking whether the series' next failure strictly after ts comes
    within the horizon. The next failure time is a running minimum over the
    rows after this one: ``ORDER BY us DESC`` with a frame from UNBOUNDED
    PRECEDING to 1 PRECEDING, a growing frame (linear per partition; a
    sliding range frame for max recomputes as rows leave it).

    Split form: a hot series is cut into ranges of time, and a time that
    fills a range alone by the key; the window runs per range. The first
    failure of the ranges that begin strictly later comes from a small table
    (first failure per range, then a suffix minimum over the ranges' first
    times), joined back by range. No row is copied, however narrow a range is
    next to the horizon."""
    part = list(partition_cols)
    hz = horizon_seconds * 1_000_000
    base = df.withColumn("_us", order_micros(S.TS)).withColumn(
        "_fail_us", F.when(failure.cast("int") == 1, F.col("_us"))
    )

    def label(nxt: Column) -> Column:
        return F.coalesce((nxt - F.col("_us")) <= F.lit(hz), F.lit(False)).cast("int")

    def after(w, c: str = "_us"):
        return w.orderBy(F.col(c).desc()).rangeBetween(Window.unboundedPreceding, -1)

    def labelled(rows: DataFrame, bound: int | None) -> DataFrame:
        if bound is None:
            nxt = F.min("_fail_us").over(after(Window.partitionBy(*part)))
            return rows.withColumn(out, label(nxt)).drop("_us", "_fail_us")
        tie = F.col(S.KEY) if S.KEY in df.columns and isinstance(df.schema[S.KEY].dataType, NumericType) else None
        b = series_ranges(rows, part, F.col("_us"), bound, tie)
        # first failure of each later range: (series x ranges) rows, not rows
        first = b.groupBy(*part, BUCKET).agg(F.min("_fail_us").alias("_first"), F.min("_us").alias("_begins"))
        carry = first.select(*[F.col(c).alias(f"_of_{c}") for c in part], F.col(BUCKET).alias("_of"), F.min("_first").over(after(Window.partitionBy(*part), "_begins")).alias("_carry"))
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in part] + [F.col(BUCKET) == F.col("_of")])
        j = b.join(carry, same, "left")
        nxt = F.coalesce(F.min("_fail_us").over(after(Window.partitionBy(*part, BUCKET))), F.col("_carry"))
        return j.withColumn(out, label(nxt)).drop("_us", "_fail_us", "_carry", "_of", BUCKET, *[f"_of_{c}" for c in part])

    return reduce(DataFrame.unionByName, [labelled(rows, bound) for rows, bound in sized_groups(base, part, rows_per_bucket, n_buckets)])
