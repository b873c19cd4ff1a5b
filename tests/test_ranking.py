"""Two-level rank, running sums, AUC and KS against brute force."""

import itertools

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.fixtures import drift_pair, fixture_score
from strainmeter.functions.exprs import order_micros
from strainmeter.operators import evaluate as EV
from strainmeter.operators.monitor import ks_drift
from strainmeter.operators.ranking import ranked, running_sums


@pytest.mark.parametrize("nb", [1, 7])
def test_ranked_equals_row_number(spark, metrics_small, nb):
    w = Window.partitionBy(S.LABEL).orderBy(S.TS, S.KEY)
    exp = {r[0]: r[1] for r in metrics_small.select(S.KEY, F.row_number().over(w)).collect()}
    got = ranked(metrics_small, [S.TS, S.KEY], order_micros(S.TS), partition_cols=[S.LABEL], out="rk", total_out="n", n_buckets=nb)
    assert {r[S.KEY]: r["rk"] for r in got.collect()} == exp


def test_running_sums(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("o"), (F.col("id") % 3).alias("v"))
    got = {r["o"]: r["cum_v"] for r in running_sums(df, "o", ["v"], n_buckets=6, exclusive=True).collect()}
    acc, exp = 0, {}
    for i in range(100):
        exp[float(i)] = acc
        acc += i % 3
    assert got == exp


def _auc_brute(ys, ps):
    pos = [p for y, p in zip(ys, ps) if y == 1]
    neg = [p for y, p in zip(ys, ps) if y != 1]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return s / (len(pos) * len(neg))


def test_auc_brute_force(spark, metrics_small):
    m = fixture_score(metrics_small).withColumn("failure_probability", F.round("failure_probability", 2))  # many ties
    pdf = m.select(S.LABEL, "failure_probability").toPandas()
    exp = _auc_brute(pdf[S.LABEL].tolist(), pdf["failure_probability"].tolist())
    for nb in (1, 5):
        assert EV.roc_auc(m, n_buckets=nb).first()["auc"] == pytest.approx(exp, abs=1e-12)


def test_auc_one_class_is_null(spark, metrics_small):
    m = fixture_score(metrics_small).withColumn(S.LABEL, F.lit(0))
    assert EV.roc_auc(m).first()["auc"] is None


def test_ks_brute_force(spark, metrics_small):
    ref, cur = drift_pair(metrics_small)
    got = {r["column_name"]: r["ks_statistic"] for r in ks_drift(ref, cur, S.METRIC_COLS, n_buckets=4).collect()}
    a, b = ref.toPandas(), cur.toPandas()
    for c in S.METRIC_COLS:
        xa, xb = np.sort(a[c].to_numpy(float)), np.sort(b[c].to_numpy(float))
        grid = np.union1d(xa, xb)
        d = np.max(np.abs(np.searchsorted(xa, grid, "right") / len(xa) - np.searchsorted(xb, grid, "right") / len(xb)))
        assert got[c] == pytest.approx(d, abs=1e-12), c


def test_ks_flags_shifted_latency(spark):
    from strainmeter.sources.io import events_metrics

    m = events_metrics(spark, "/root/testdata/sf0.01")
    ref, cur = drift_pair(m)
    res = {r["column_name"]: r for r in ks_drift(ref, cur, S.METRIC_COLS).collect()}
    assert res["network_latency_ms"]["drift_detected"]
    assert not res["disk_usage"]["drift_detected"]


def test_ks_with_sub_ranges(spark, metrics_small, monkeypatch):
    import strainmeter.operators.windows as W

    monkeypatch.setattr(W, "MAX_QUANTILE_RANGES", 3)
    ref, cur = drift_pair(metrics_small)
    a = {r["column_name"]: r["ks_statistic"] for r in ks_drift(ref, cur, S.METRIC_COLS, n_buckets=1).collect()}
    b = {r["column_name"]: r["ks_statistic"] for r in ks_drift(ref, cur, S.METRIC_COLS, n_buckets=20).collect()}
    assert a == pytest.approx(b, abs=1e-12)


def test_exact_quantile_matches_numpy(spark, metrics_small):
    from strainmeter.operators.monitor import latency_quantile

    got = {r["bucket_start"]: r["p95"] for r in latency_quantile(metrics_small, "response_time_ms", 0.95, bucket="1 day", n_buckets=4).collect()}
    pdf = metrics_small.select(S.TS, "response_time_ms").toPandas()
    pdf["d"] = pdf[S.TS].dt.floor("D")
    for d, g in pdf.groupby("d"):
        assert got[d.to_pydatetime()] == pytest.approx(np.quantile(g["response_time_ms"], 0.95), abs=1e-9)


def test_offsets_broadcast_only_within_the_bound(spark, monkeypatch):
    """Above BROADCAST_ROWS the offset table is joined by shuffle on the
    keys the window shuffles by anyway; ranks are unchanged."""
    from strainmeter import session
    from strainmeter.operators.ranking import ranked

    df = spark.range(3000).selectExpr("id", "id % 2 AS g", "(id * 7919) % 3001 AS o")

    def run():
        r = ranked(df, ["o", "id"], F.col("o"), partition_cols=["g"], out="r", n_buckets=12)
        plan = r._jdf.queryExecution().executedPlan().toString()
        return sorted((x.id, x.r) for x in r.select("id", "r").collect()), plan

    # only the hint may broadcast (no size-based choice in this test)
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, pa = run()
        monkeypatch.setattr(session, "BROADCAST_ROWS", 10)
        b, pb = run()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    assert a == b
    assert "BroadcastExchange" in pa and "BroadcastExchange" not in pb


def _exact_p(n, m, d):
    """P(D >= d) over all orders of two samples."""
    worse = total = 0
    for chosen in itertools.combinations(range(n + m), n):
        i = j = 0
        most = 0.0
        own = set(chosen)
        for t in range(n + m):
            i, j = i + (t in own), j + (t not in own)
            most = max(most, abs(i / n - j / m))
        total += 1
        worse += most >= d - 1e-12
    return worse / total


def test_exact_ks_p_values_equal_enumeration(spark):
    from strainmeter.operators.monitor import ks_exact_sql

    cases = [(n, m, k / (n * m)) for n, m in ((1, 1), (1, 5), (3, 4), (5, 5), (6, 3), (7, 5)) for k in range(0, n * m + 1, max(1, n * m // 6))]
    df = spark.createDataFrame(cases, "n_ref long, n_cur long, ks_statistic double")
    got = df.withColumn("p", F.expr(ks_exact_sql())).collect()
    assert len(got) == len(cases)
    for r in got:
        assert r.p == pytest.approx(_exact_p(r.n_ref, r.n_cur, r.ks_statistic), abs=1e-12), r


def test_small_samples_get_the_exact_law(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 12), rng.normal(1.2, 1, 9)
    frames = [spark.createDataFrame([(float(v),) for v in x], "v double") for x in (a, b)]
    r = ks_drift(*frames).first()
    assert r.p_value == pytest.approx(_exact_p_fast(12, 9, r.ks_statistic), abs=1e-12)
    big = [spark.range(n).select(F.rand(s).alias("v")) for n, s in ((300, 1), (200, 2))]
    r = ks_drift(*big).first()
    exact = _exact_p_fast(300, 200, r.ks_statistic)
    assert r.n_ref * r.n_cur > 10_000 and r.p_value == pytest.approx(exact, abs=0.05)


def _exact_p_fast(n, m, d):
    k = round(d * n * m)
    row = [1.0 if j * n < k else 0.0 for j in range(m + 1)]
    for j in range(1, m + 1):
        row[j] = min(row[j], row[j - 1])
    for i in range(1, n + 1):
        new = [row[0] if i * m < k else 0.0]
        for j in range(1, m + 1):
            new.append((i * row[j] + j * new[-1]) / (i + j) if abs(i * m - j * n) < k else 0.0)
        row = new
    return 1 - row[-1]


def test_merged_sketches_keep_the_rank(spark):
    from strainmeter.operators.monitor import merged_quantile, quantile_sketches

    rows = spark.range(60_000).select(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 4)").alias(S.TS), F.when(F.col("id") % 50 == 0, float("nan")).when(F.col("id") % 51 == 0, None).otherwise(F.exp(F.randn(4))).alias("v")).cache()
    for q in (0.5, 0.95):
        name = f"p{round(q * 100)}"
        days = merged_quantile(quantile_sketches(rows, "v", bucket="10 minutes"), q)
        joined = rows.filter("v IS NOT NULL AND NOT isnan(v)").withColumn("bucket_start", F.date_trunc("day", S.TS).cast("timestamp_ntz")).join(days, "bucket_start")
        for r in joined.groupBy("bucket_start", "n").agg((F.count_if(F.col("v") <= F.col(name)) / F.first("n")).alias("rank"), F.count(F.lit(1)).alias("c")).collect():
            assert r.c == r.n and abs(r.rank - q) <= 0.0133
