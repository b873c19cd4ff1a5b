"""History features: the range-bucketed (halo) form equals the per-series
form, and both equal pandas on data with gaps, ties and one-row series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.fixtures import null_fixture
from strainmeter.operators.features import feature_table
from strainmeter.operators.windows import HistorySpec, forward_fill, history_features


def _rows(df):
    return df.orderBy(S.KEY).toPandas().reset_index(drop=True)


@pytest.mark.parametrize("nulls", [False, True])
def test_bucketed_equals_per_series(spark, metrics_small, nulls):
    m = null_fixture(metrics_small) if nulls else metrics_small
    a = _rows(feature_table(m, n_buckets=1))
    b = _rows(feature_table(m, n_buckets=13))
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-12)


def test_global_series_bucketed_equals_single(spark, metrics_small):
    a = _rows(feature_table(metrics_small, partition_cols=(), keep=[S.KEY], n_buckets=1))
    b = _rows(feature_table(metrics_small, partition_cols=(), keep=[S.KEY], n_buckets=9))
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-12)


def _pandas_reference(pdf):
    """The reference's pandas rules per host (with forward fill = ffill)."""
    out = []
    means = {c: pdf[c].mean() for c in S.LAG_COLS}
    for _, g in pdf.sort_values([S.TS, S.KEY]).groupby(S.HOST, sort=False):
        g = g.copy()
        for w in S.ROLLING_WINDOWS:
            for c in S.ROLLING_COLS:
                g[f"{c}_rolling_mean_{w}"] = g[c].rolling(window=w, min_periods=1).mean()
                g[f"{c}_rolling_max_{w}"] = g[c].rolling(window=w, min_periods=1).max()
        for n in S.LAGS:
            for c in S.LAG_COLS:
                g[f"{c}_lag_{n}"] = g[c].shift(n).fillna(means[c])
        g = g.ffill().fillna(0)
        out.append(g)
    return pd.concat(out)


def test_pandas_parity_with_gaps(spark, metrics_small):
    m = null_fixture(metrics_small)
    got = _rows(feature_table(m, n_buckets=5))
    ref = _pandas_reference(m.toPandas()).sort_values(S.KEY).reset_index(drop=True)
    for c in S.ROLLING_COLS_OUT + S.LAG_COLS_OUT + S.METRIC_COLS:
        np.testing.assert_allclose(got[c].astype(float), ref[c].astype(float), rtol=1e-9, err_msg=c)


def test_ties_in_time_use_the_key(spark):
    rows = [(i, 1, "2024-01-01 00:00:00", float(i)) for i in range(6)]
    df = spark.createDataFrame(rows, "event_id long, host_id long, ts string, cpu_usage double").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )
    spec = HistorySpec(lags=[("cpu_lag_1", "cpu_usage", 1)])
    for nb in (1, 3):
        got = [r["cpu_lag_1"] for r in history_features(df, spec, n_buckets=nb).orderBy(S.KEY).collect()]
        assert got == [None, 0.0, 1.0, 2.0, 3.0, 4.0]


def test_one_row_series_and_leading_nulls(spark):
    rows = [(1, 1, "2024-01-01 00:00:00", None), (2, 2, "2024-01-01 00:01:00", 5.0), (3, 2, "2024-01-01 00:02:00", None)]
    df = spark.createDataFrame(rows, "event_id long, host_id long, ts string, cpu_usage double").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )
    got = {r[S.KEY]: r["cpu_usage"] for r in forward_fill(df, ["cpu_usage"], n_buckets=1).collect()}
    assert got == {1: None, 2: 5.0, 3: 5.0}


def test_bucketed_forward_fill_crosses_many_empty_ranges(spark):
    # a value early, then a long gap of NULLs over many ranges
    rows = [(i, 7, f"2024-01-01 00:{i:02d}:00", 3.0 if i == 0 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "event_id long, host_id long, ts string, cpu_usage double").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )
    got = [r["cpu_usage"] for r in forward_fill(df, ["cpu_usage"], n_buckets=10).orderBy(S.KEY).collect()]
    assert got == [3.0] * 40


def test_sub_ranges_equal_plain_ranges(spark, metrics_small, monkeypatch):
    """Beyond the quantile-range cap, quantile ranges are cut into equal-width
    sub-ranges; results stay those of the per-series form."""
    import strainmeter.operators.windows as W

    monkeypatch.setattr(W, "MAX_QUANTILE_RANGES", 4)
    plan = W.range_bounds(metrics_small, F.col(S.KEY), 30)
    assert plan.sub > 1 and plan.n_buckets >= 30
    m = null_fixture(metrics_small)
    a = _rows(feature_table(m, n_buckets=1))
    b = _rows(feature_table(m, n_buckets=30))
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-12)
    bucketed = W.with_range_bucket(metrics_small, F.col(S.KEY), plan).orderBy(S.KEY).select(W.BUCKET).toPandas()[W.BUCKET]
    assert bucketed.is_monotonic_increasing and bucketed.nunique() > 8


@pytest.mark.parametrize("nb", [1, 4])
def test_alert_island_at_series_start(spark, nb):
    from strainmeter.operators.monitor import sustained_alerts

    ps = [0.9] * 11 + [0.1] + [0.95] * 3 + [0.2] + [0.85] * 9
    rows = [(i, 1, f"2024-01-01 00:{i:02d}:00", p) for i, p in enumerate(ps)]
    df = spark.createDataFrame(rows, "event_id long, host_id long, ts string, failure_probability double").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )
    got = sorted((r["island_start"].minute, r["fired_at"].minute, r["island_end"].minute, r["n_rows"]) for r in sustained_alerts(df, n_buckets=nb).collect())
    assert got == [(0, 5, 10, 11), (16, 21, 24, 9)]
