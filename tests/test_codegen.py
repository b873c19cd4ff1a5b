"""Expressions that keep plans inside generated code and hash aggregates:
the packed order key, lambda-free arrays, the plain validity predicate."""

import datetime as dt
import random

from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.functions import exprs as X
from strainmeter.operators import clean as C
from strainmeter.operators.monitor import latest_features, sustained_alerts

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _edge_rows(n=2000, seed=7):
    rnd = random.Random(seed)
    edge_ts = [dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999), dt.datetime(1970, 1, 1), None, dt.datetime(1969, 12, 31, 23, 59, 59, 999999)]
    edge_k = [-(2**63), 2**63 - 1, 0, -1, None, 1]
    rows = []
    for i in range(n):
        t = rnd.choice(edge_ts) if rnd.random() < 0.3 else dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=rnd.randint(-(10**12), 10**12))
        k = rnd.choice(edge_k) if rnd.random() < 0.3 else rnd.randint(-(10**6), 10**6)
        rows.append((i % 7, t, k))
    return rows


def test_packed_order_equals_struct_order(spark):
    df = spark.createDataFrame(_edge_rows(), "g int, ts timestamp_ntz, k bigint")
    pk = X.packed_order_sql(df, ["ts", "k"])
    assert pk is not None
    got = df.groupBy("g").agg(
        F.expr("max_by(struct(ts, k), struct(ts, k))").alias("s_max"),
        F.expr(f"max_by(struct(ts, k), {pk})").alias("p_max"),
        F.expr("min_by(struct(ts, k), struct(ts, k))").alias("s_min"),
        F.expr(f"min_by(struct(ts, k), {pk})").alias("p_min"),
    )
    assert got.filter("NOT (s_max <=> p_max) OR NOT (s_min <=> p_min)").count() == 0
    keys = [r.p for r in df.orderBy("ts", "k").selectExpr(f"{pk} AS p").collect()]
    assert all(a <= b for a, b in zip(keys, keys[1:]))
    assert len(set(keys)) == df.distinct().select("ts", "k").distinct().count()


def test_packed_order_plans_a_hash_aggregate(spark):
    df = spark.createDataFrame(_edge_rows(200), "g int, ts timestamp_ntz, k bigint")
    p = _plan(df.groupBy("g").agg(F.expr(f"max_by(k, {X.packed_order_sql(df, ['ts', 'k'])})")))
    assert "HashAggregate" in p and "SortAggregate" not in p


def test_packed_order_refuses_what_does_not_fit(spark):
    df = spark.createDataFrame([(1, 2, 3, "x")], "a bigint, b bigint, c bigint, s string")
    assert X.packed_order_sql(df, ["a", "b"]) is None  # 130 bits
    assert X.packed_order_sql(df, ["s"]) is None
    assert X.order_key_sql(df, ["s"]) == "struct(`s`)"


def test_compact_equals_array_compact(spark):
    df = spark.range(200).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS a", "CASE WHEN id % 5 = 0 THEN NULL ELSE id * 2 END AS b")
    parts = ["CASE WHEN a > 50 THEN 'A' END", "CASE WHEN b > 100 THEN 'B' WHEN b > 20 THEN 'b' END", "CAST(NULL AS STRING)"]
    mine = X.compact_sql(parts)
    ref = "array_compact(array(" + ", ".join(parts) + "))"
    assert df.filter(f"NOT ({mine} <=> {ref})").count() == 0
    assert df.selectExpr(f"{X.compact_sql([])} AS e").first()["e"] == []


def test_texts_follow_codes(spark):
    df = E.queries()["recommendations"](spark, SF)
    codes = df.select(F.split("recommendation_codes", ",").alias("c"))
    out = codes.select("c", X.recommendation_texts("c").alias("t")).collect()
    for r in out:
        assert r["t"] == [S.RECOMMENDATION_TEXT[c] for c in r["c"]]


def test_valid_predicate_equals_empty_code_array(spark):
    from strainmeter.fixtures import invalid_fixture
    from strainmeter.sources.io import events_metrics

    m = invalid_fixture(events_metrics(spark, SF))
    checked = C.validate_readings(m).withColumn("_ok", F.expr(C.valid_sql(present=m.columns)))
    assert checked.filter(F.col("_ok") != F.col("is_valid")).count() == 0
    assert checked.filter(~F.col("is_valid")).count() > 0
    good, bad = C.split_valid(m)
    assert good.count() + bad.count() == m.count()


def test_hot_paths_stay_in_generated_code(spark):
    """Scoring and validation plans have no lambda and no operator outside
    whole-stage code generation; the max_by aggregates are hash based."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        qs = E.queries()
        for name in ("score_batch", "validate_readings", "recommendations", "batch_summary"):
            p = _plan(qs[name](spark, SF))
            assert "lambdafunction" not in p, name
        for name in ("latest_features", "sustained_alert", "rolling_global"):
            p = _plan(qs[name](spark, SF))
            assert "SortAggregate" not in p and "lambdafunction" not in p, name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_latest_and_alerts_keep_struct_fallback(spark, metrics_small):
    """With an order the packed key cannot hold, the struct forms still run
    and agree."""
    m = metrics_small.withColumn("failure_probability", F.expr("(cpu_usage + memory_usage) / 200"))
    a = latest_features(m, m, ["cpu_usage"]).orderBy(S.HOST).collect()
    b = latest_features(m.withColumn(S.KEY, F.col(S.KEY).cast("decimal(20,0)")), m, ["cpu_usage"]).orderBy(S.HOST).collect()
    assert a == b
    x = sustained_alerts(m).orderBy(S.HOST, "island_start").collect()
    y = sustained_alerts(m.withColumn(S.KEY, F.col(S.KEY).cast("decimal(20,0)"))).orderBy(S.HOST, "island_start").collect()
    assert x == y


def test_order_micros_ignore_the_session_zone(spark):
    """Two wall-clock times of a DST gap stay apart, and every value equals
    its UTC reading, whatever the session zone."""
    vals = ["2024-03-10 02:30:00.123456", "2024-03-10 03:30:00.123456", "1969-12-31 23:59:59.999999", "0001-01-01 00:00:00", "9999-12-31 23:59:59.999999"]
    df = spark.createDataFrame([(v,) for v in vals], "s string").selectExpr("CAST(s AS TIMESTAMP_NTZ) AS ts", "0L AS k")
    pk = X.packed_order_sql(df, ["ts", "k"])
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = {}
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got[tz] = [(r.us, r.p) for r in df.select(X.order_micros("ts").alias("us"), F.expr(pk).alias("p")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got["UTC"] == got["America/New_York"]
    us = [u for u, _ in got["UTC"]]
    assert us[1] - us[0] == 3600 * 10**6 and us[2] == -1 and us[3] == -62135596800000000
