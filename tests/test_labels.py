"""failure_label: next-failure form against brute force, per series and
split over ranges far narrower than the horizon."""

import pandas as pd
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.operators.monitor import failure_label
from strainmeter.sources.io import read_table

SF = "/root/testdata/sf0.001"


def _events(spark):
    e = read_table(spark, SF, "events")
    return e.select(S.KEY, (F.col("user_id") % 4).alias(S.HOST), F.col("ts").cast("timestamp_ntz").alias(S.TS), "event_type")


def _brute(pdf: pd.DataFrame, horizon_s: int) -> dict:
    out = {}
    hz = pd.Timedelta(seconds=horizon_s)
    for _, g in pdf.groupby(S.HOST):
        fails = g.loc[g["event_type"] == "error", S.TS].sort_values().to_numpy()
        for k, t in zip(g[S.KEY], g[S.TS]):
            lo = fails.searchsorted(t.to_datetime64(), side="right")  # strictly after t
            out[k] = int(lo < len(fails) and fails[lo] <= (t + hz).to_datetime64())
    return out


def test_failure_label_equals_brute_force(spark):
    e = _events(spark)
    pdf = e.toPandas()
    # a horizon of a few events' spacing, so it spans many narrow ranges
    span = (pdf[S.TS].max() - pdf[S.TS].min()).total_seconds()
    for horizon in (3600, max(1, int(span / 200))):
        want = _brute(pdf, horizon)
        for nb in (1, 7, 64):
            got = failure_label(e, F.col("event_type") == "error", horizon_seconds=horizon, n_buckets=nb)
            rows = {r[S.KEY]: r[S.LABEL] for r in got.select(S.KEY, S.LABEL).collect()}
            assert rows == want, (horizon, nb)


def test_failure_label_copies_no_rows(spark):
    """The split form keeps one row per input row before the window."""
    e = _events(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = failure_label(e, F.col("event_type") == "error", horizon_seconds=3600, n_buckets=64)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Generate" not in p and "Union" not in p
