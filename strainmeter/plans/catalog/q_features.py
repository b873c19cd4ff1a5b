"""Feature queries (projections and windows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strainmeter import oracle_sql as O
from strainmeter import schema as S
from strainmeter.fixtures import null_fixture
from strainmeter.functions import exprs as X
from strainmeter.operators import features as FE
from strainmeter.operators.ranking import ranked
from strainmeter.operators.windows import HistorySpec, column_means, forward_fill, history_features
from strainmeter.plans.catalog import register
from strainmeter.plans.checks import rounded, split_buckets
from strainmeter.sources.io import events_metrics

M = O.METRICS_CTE
W_HOST = "PARTITION BY host_id ORDER BY ts, event_id"


def _sql(select: str, *ctes: str) -> str:
    return O.with_ctes(M, *ctes) + "\n" + select


@register(
    "calendar_parts",
    _sql("SELECT event_id, CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) - 1 AS INT) AS day_of_week FROM metrics"),
)
def q_calendar_parts(spark, sf_dir):
    m = events_metrics(spark, sf_dir)
    return m.select(S.KEY, X.hour_of(S.TS).alias("hour"), X.weekday_of(S.TS).alias("day_of_week"))


@register(
    "calendar_flags",
    _sql(
        "SELECT event_id, CAST(day_of_week >= 5 AS INT) AS is_weekend,"
        " CAST(hour BETWEEN 9 AND 17 AND day_of_week < 5 AS INT) AS is_business_hours FROM metrics"
    ),
)
def q_calendar_flags(spark, sf_dir):
    m = events_metrics(spark, sf_dir)
    return m.select(
        S.KEY,
        X.weekend_flag("day_of_week").alias("is_weekend"),
        X.business_flag("hour", "day_of_week").alias("is_business_hours"),
    )


@register(
    "expected_load",
    _sql(
        "SELECT event_id, "
        + O.r(
            "(CASE WHEN hour BETWEEN 9 AND 17 AND day_of_week < 5 THEN CAST(1.3 AS DOUBLE) ELSE 1.0 END)"
            " * (CASE WHEN day_of_week >= 5 THEN CAST(0.7 AS DOUBLE) ELSE 1.0 END)"
            " * (CASE WHEN hour < 6 OR hour > 22 THEN CAST(0.5 AS DOUBLE) ELSE 1.0 END)"
        )
        + " AS expected_load, "
        + O.r(
            "cpu_usage / ((CASE WHEN hour BETWEEN 9 AND 17 AND day_of_week < 5 THEN CAST(1.3 AS DOUBLE) ELSE 1.0 END)"
            " * (CASE WHEN day_of_week >= 5 THEN CAST(0.7 AS DOUBLE) ELSE 1.0 END)"
            " * (CASE WHEN hour < 6 OR hour > 22 THEN CAST(0.5 AS DOUBLE) ELSE 1.0 END))"
        )
        + " AS cpu_vs_load FROM metrics"
    ),
)
def q_expected_load(spark, sf_dir):
    m = events_metrics(spark, sf_dir)
    load = X.expected_load()
    return rounded(m.select(S.KEY, load.alias("expected_load"), (F.col("cpu_usage") / load).alias("cpu_vs_load")))


@register(
    "interaction_features",
    _sql(
        "SELECT event_id, "
        + ", ".join(f"{O.r(c)} AS {c}" for c in S.INTERACTION_COLS)
        + " FROM loc",
        f"loc AS ({O.row_local_sql('metrics')})",
    ),
)
def q_interaction_features(spark, sf_dir):
    m = FE.add_interactions(events_metrics(spark, sf_dir))
    return rounded(m.select(S.KEY, *S.INTERACTION_COLS))


@register(
    "stress_features",
    _sql("SELECT event_id, " + ", ".join(S.STRESS_COLS) + " FROM loc", f"loc AS ({O.row_local_sql('metrics')})"),
)
def q_stress_features(spark, sf_dir):
    m = FE.add_stress(events_metrics(spark, sf_dir))
    return m.select(S.KEY, *S.STRESS_COLS)


@register(
    "cyclic_features",
    _sql(
        "SELECT event_id, " + ", ".join(f"{O.r(c)} AS {c}" for c in S.CYCLIC_COLS) + " FROM loc",
        f"loc AS ({O.row_local_sql('metrics')})",
    ),
)
def q_cyclic_features(spark, sf_dir):
    m = FE.add_cyclic(events_metrics(spark, sf_dir))
    return rounded(m.select(S.KEY, *S.CYCLIC_COLS))


def _rolling_sql(how: str) -> str:
    fn = "avg" if how == "mean" else "max"
    cols = [
        f"{O.r(f'CAST({fn}({c}) OVER ({W_HOST} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS DOUBLE)')} AS {name}"
        for name, c, h, n in S.rolling_names()
        if h == how
    ]
    return _sql(f"SELECT event_id, host_id, {', '.join(cols)} FROM metrics")


def _rolling_query(how: str):
    def q(spark, sf_dir):
        m = events_metrics(spark, sf_dir)
        spec = HistorySpec(rolling=[r for r in S.rolling_names() if r[2] == how], ffill_rolling=False)
        out = history_features(m, spec)
        return rounded(out.select(S.KEY, S.HOST, *[r[0] for r in spec.rolling]))

    return q


register("rolling_mean", _rolling_sql("mean"))(_rolling_query("mean"))
register("rolling_max", _rolling_sql("max"))(_rolling_query("max"))


@register(
    "lag_mean_fill",
    O.with_ctes(O.NULL_METRICS_CTE)
    + "\nSELECT event_id, host_id, "
    + ", ".join(
        f"{O.r(f'coalesce(CAST(lag({c}, {n}) OVER ({W_HOST}) AS DOUBLE), (SELECT avg({c}) FROM metrics_nulls))')} AS {name}"
        for name, c, n in S.lag_names()
    )
    + " FROM metrics_nulls",
)
def q_lag_mean_fill(spark, sf_dir):
    m = null_fixture(events_metrics(spark, sf_dir))
    spec = HistorySpec(lags=S.lag_names(), lag_fill=column_means(m, S.LAG_COLS))
    out = history_features(m, spec)
    return rounded(out.select(S.KEY, S.HOST, *S.LAG_COLS_OUT))


@register(
    "forward_fill",
    O.with_ctes(O.NULL_METRICS_CTE)
    + "\nSELECT event_id, host_id, "
    + ", ".join(
        f"last_value({c} IGNORE NULLS) OVER ({W_HOST} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
        for c in S.METRIC_COLS
    )
    + " FROM metrics_nulls",
)
def q_forward_fill(spark, sf_dir):
    m = null_fixture(events_metrics(spark, sf_dir))
    return forward_fill(m, S.METRIC_COLS).select(S.KEY, S.HOST, *S.METRIC_COLS)


@register("feature_table", O.feature_sql())
def q_feature_table(spark, sf_dir):
    return rounded(FE.feature_table(events_metrics(spark, sf_dir)))


@register("feature_table_nulls", O.feature_sql(src="metrics_nulls", extra_ctes=O.NULL_METRICS_CTE))
def q_feature_table_nulls(spark, sf_dir):
    """The feature table over the null fixture (fill order: rolling / lag skip
    NULL, then forward fill, then 0)."""
    return rounded(FE.feature_table(null_fixture(events_metrics(spark, sf_dir))))


@register("rolling_global", O.feature_sql(part=""))
def q_rolling_global(spark, sf_dir):
    """One ordered series (no host): range buckets with halo rows as soon as
    it outgrows a task."""
    return rounded(FE.feature_table(events_metrics(spark, sf_dir), partition_cols=(), keep=[S.KEY]))


def _wrap_feature_sql(select: str) -> str:
    head, tail = O.feature_sql().rsplit("\nSELECT ", 1)
    return head + ",\n_ft AS (SELECT " + tail + ")\n" + select


@register("select_inputs", _wrap_feature_sql("SELECT event_id, " + ", ".join(S.MODEL_INPUTS) + " FROM _ft"))
def q_select_inputs(spark, sf_dir):
    ft = rounded(FE.feature_table(events_metrics(spark, sf_dir)))
    return ft.select(S.KEY, *FE.select_inputs(ft).columns)


@register(
    "sort_by_time",
    _sql(
        "SELECT event_id, ts, CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT) AS position FROM metrics"
    ),
)
def q_sort_by_time(spark, sf_dir):
    """Global time order as a position column (two-level rank: no one-task
    window), so the order itself is checked."""
    m = events_metrics(spark, sf_dir)
    return ranked(m.select(S.KEY, S.TS), [S.TS, S.KEY], X.order_micros(S.TS), out="position", n_buckets=split_buckets(m), tie=F.col(S.KEY))
