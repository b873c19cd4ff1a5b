"""Streams equal the batch operators over several micro-batches (state
carried between them), in whatever order rows come within the late bound."""

import datetime as dt
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.fixtures import fixture_score
from strainmeter.operators import features as FE
from strainmeter.operators import monitor as MO
from strainmeter.operators.windows import column_means
from strainmeter.session import shared_path
from strainmeter.streaming import stateful as ST
from strainmeter.streaming.sources import folder_stream, read_batches, run_to_table, run_to_tables


def _landing(spark, metrics, parts=4):
    """The metric table written as ``parts`` files in time order."""
    base = shared_path(spark, "landing")
    bounds = metrics.approxQuantile("event_id", [i / parts for i in range(1, parts)], 0.0)
    edges = [-1] + [int(b) for b in bounds] + [1 << 60]
    for i in range(parts):
        chunk = metrics.filter((F.col(S.KEY) > edges[i]) & (F.col(S.KEY) <= edges[i + 1]))
        chunk.coalesce(1).write.parquet(f"{base}/b{i:03d}")
        time.sleep(1.1)
    return base + "/*/*.parquet"


def _frames(a, b):
    a, b = (x.orderBy(S.KEY).toPandas() for x in (a, b))
    pd.testing.assert_frame_equal(a[b.columns], b, check_exact=False, rtol=1e-12, check_dtype=False)


def _due(df, minutes=10):
    """Rows whose bound has passed at the end of the stream."""
    last = df.agg(F.max(S.TS)).first()[0]
    return F.col(S.TS) <= F.lit(last - dt.timedelta(minutes=minutes)).cast("timestamp_ntz")


def _dense(metrics, spark):
    """A row every 20 seconds over few hosts, with gaps, NaN and infinities."""
    m = metrics.withColumn(S.TS, F.expr("timestamp_ntz'2024-01-01 00:00:00.000123' + make_dt_interval(0, 0, 0, event_id * 20)"))
    m = m.withColumn(S.HOST, F.col(S.KEY) % 3)
    odd = {c: F.when(F.col(S.KEY) % 13 == i, None).when(F.col(S.KEY) % 29 == i, float("nan")).otherwise(F.col(c)) for i, c in enumerate(("cpu_usage", "memory_usage", "response_time_ms"))}
    return m.withColumns(odd | {"error_count": F.when(F.col(S.KEY) % 17 < 3, None).otherwise(F.col("error_count"))})


def _delivered(spark, df, at, parts):
    """``df`` written as files in the order of the column expression ``at``."""
    base = shared_path(spark, "landing")
    rows = df.withColumn("_at", at)
    edges = rows.approxQuantile("_at", [i / parts for i in range(1, parts)], 0.0)
    for i, (lo, hi) in enumerate(zip([-float("inf"), *edges], [*edges, float("inf")])):
        rows.filter((F.col("_at") > lo) & (F.col("_at") <= hi)).drop("_at").coalesce(1).write.parquet(f"{base}/b{i:03d}")
        time.sleep(1.1)
    return base + "/*/*.parquet"


def test_history_stream_equals_batch(spark, metrics_small):
    path = _landing(spark, metrics_small, parts=3)
    stream = folder_stream(spark, path, metrics_small.schema, max_files=1)
    fill = column_means(metrics_small, S.LAG_COLS)
    tables = ST.late_apart(ST.stream_history_features(stream, fill), shared_path(spark, "t-history"))
    _frames(read_batches(spark, tables["rows"]), FE.feature_table(metrics_small).filter(_due(metrics_small)))
    assert read_batches(spark, tables["late"]).count() == 0


def test_shuffled_delivery_gives_the_batch_rows(spark, metrics_small):
    """Deliveries up to 10 minutes late, NaN and NULL readings; then rows an
    hour late, which change nothing and come to the side table; and a host
    that falls silent, whose state goes away."""
    m = _dense(metrics_small, spark)
    silent = m.filter(F.col(S.KEY) < 40).withColumns({S.HOST: F.lit(99).cast("long"), S.KEY: F.col(S.KEY) + 100_000})
    m = m.unionByName(silent).cache()
    seconds = F.expr("unix_micros(CAST(ts AS TIMESTAMP)) / 1e6")
    delay = F.pmod(F.xxhash64(S.KEY), F.lit(599))
    late = m.filter((F.col(S.KEY) % 50 == 7) & (F.col(S.HOST) < 99)).withColumns({S.KEY: F.col(S.KEY) + 200_000, "cpu_usage": F.lit(99.0)})
    sent = m.withColumn("d", seconds + delay).unionByName(late.withColumn("d", seconds + 7200))
    path = _delivered(spark, sent.drop("d"), F.when(F.col(S.KEY) >= 200_000, seconds + 7200).otherwise(seconds + delay), 6)
    stream = folder_stream(spark, path, m.schema, max_files=1)
    fill = column_means(m.withColumn("cpu_usage", F.expr("nanvl(cpu_usage, NULL)")).withColumn("memory_usage", F.expr("nanvl(memory_usage, NULL)")), S.LAG_COLS)
    base = shared_path(spark, "t-shuffled")
    tables = ST.late_apart(ST.stream_history_features(stream, fill, idle="1 hour", grace="3 hours"), base)
    end = m.agg(F.max(S.TS)).first()[0] - dt.timedelta(minutes=10)
    got, missed = (read_batches(spark, tables[t]) for t in ("rows", "late"))
    # a row so late that its host's later rows were processed is missed, and
    # changes nothing; one that comes before that is in order
    in_order = late.join(missed.select(S.KEY), S.KEY, "left_anti")
    all_rows = m.unionByName(in_order.select(*m.columns))
    _frames(got, FE.feature_table(all_rows, lag_fill=fill).filter(F.col(S.TS) <= F.lit(end).cast("timestamp_ntz")))
    assert missed.count() > 0.5 * late.count() and missed.filter(F.col(S.KEY) < 200_000).count() == 0
    assert ST.late_counts(spark, tables["late"]).agg(F.sum("n_late")).first()[0] == missed.count()
    left = spark.read.format("statestore").load(f"{base}/checkpoint").select("key.*").collect()
    assert {r[0] for r in left} == {0, 1, 2}


def test_alert_stream_equals_batch(spark, metrics_small):
    m = _dense(metrics_small, spark).fillna(50.0)
    seconds = F.expr("unix_micros(CAST(ts AS TIMESTAMP)) / 1e6")
    path = _delivered(spark, m, seconds + F.pmod(F.xxhash64(S.KEY), F.lit(599)), 4)
    scored = fixture_score(folder_stream(spark, path, m.schema, max_files=1))
    out = spark.read.parquet(run_to_table(ST.stream_sustained_alert(scored, above=0.4, for_seconds=90), "t-alert"))
    batch = MO.sustained_alerts(fixture_score(m), above=0.4, for_seconds=90)
    batch = batch.filter(F.col("fired_at") <= F.lit(m.agg(F.max(S.TS)).first()[0] - dt.timedelta(minutes=10)).cast("timestamp_ntz"))
    key = ["host_id", "island_start", "fired_at"]
    assert sorted(map(tuple, out.select(*key).collect())) == sorted(map(tuple, batch.select(*key).collect()))
    assert out.count() > 10


def test_a_stopped_run_doubles_and_loses_nothing(spark, metrics_small):
    """A run that ends between the two tables' writes, one that ends before
    the batch is noted as done, and one that goes through."""
    from strainmeter.fixtures import fixture_model, invalid_fixture

    m = invalid_fixture(metrics_small).cache()
    path = _landing(spark, m, parts=4)
    base = shared_path(spark, "t-once")

    def scored():
        return ST.stream_score_readings(folder_stream(spark, path, m.schema, max_files=1), fixture_model(), "fixture", S.MODEL_INPUTS, as_of="2024-02-01 00:00:00")

    class Stopped(Exception):
        pass

    routes = {"predictions": lambda b: b.filter(F.col("violations").isNull()).drop("violations"), "quarantine": lambda b: b.filter(F.col("violations").isNotNull())}
    for stop_at, between in ((1, True), (2, False)):
        seen = []

        def quarantine(b, stop_at=stop_at, between=between, seen=seen):
            seen.append(1)
            if between and len(seen) > stop_at:
                raise Stopped("between two tables")
            return routes["quarantine"](b)

        def after(b, stop_at=stop_at, seen=seen):
            if len(seen) > 1:
                raise Stopped("after both tables")
            return b.limit(0)

        stopped = routes | {"quarantine": quarantine} | ({} if between else {"z_after": after})
        with pytest.raises(Exception, match="between two tables|after both tables"):
            run_to_tables(scored(), stopped, base)
    tables = run_to_tables(scored(), routes, base)
    good, bad = (read_batches(spark, tables[t]) for t in ("predictions", "quarantine"))
    ids = [r.reading_id for r in good.collect()] + [r.reading_id for r in bad.collect()]
    assert sorted(ids) == sorted(r[S.KEY] for r in m.collect())
    assert bad.count() > 0 and bad.filter("size(violations) = 0").count() == 0
    run_to_tables(scored(), routes, base)  # nothing new: nothing more
    assert read_batches(spark, tables["predictions"]).count() == good.count()


@pytest.mark.parametrize("approx", [False, True])
def test_late_rows_dropped_by_watermark(spark, approx):
    """A row 40 minutes behind the latest event, arriving after the
    watermark (10-minute bound) has moved past it, does not reach the
    roll-up. Chained aggregations filter late rows with the watermark of the
    batch before, so the late file comes two batches after the first."""
    base = shared_path(spark, "late")
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    files = [
        [(1, "2024-01-01 10:00:00", 1, "click", 1.0, "{}"), (2, "2024-01-01 11:00:00", 1, "click", 2.0, "{}")],
        [(3, "2024-01-01 11:30:00", 1, "click", 3.0, "{}")],
        [(4, "2024-01-01 10:40:00", 1, "error", 5.0, "{}")],
    ]
    for i, rows in enumerate(files):
        df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
        df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{base}/b{i}")
        time.sleep(1.1)
    stream = folder_stream(spark, base + "/*/*.parquet", schema, max_files=1)
    out = spark.read.parquet(run_to_table(ST.stream_rollup(stream, approx_distinct=approx), f"t-late-{approx}"))
    assert out.agg(F.sum("n_errors")).first()[0] in (None, 0)
    assert out.agg(F.sum("n_events")).first()[0] >= 1


def test_score_stream_equals_batch(spark, metrics_small):
    from strainmeter.plans import train as TR
    from strainmeter.plans.score import score_batch

    train = FE.feature_table(metrics_small)
    model = TR.fit_model(train, TR.ModelSpec("logistic_regression", dict(maxIter=50), scaled=True))
    path = _landing(spark, metrics_small, parts=2)
    stream = folder_stream(spark, path, metrics_small.schema, max_files=1)
    as_of = "2024-02-01 00:00:00"
    out = spark.read.parquet(run_to_table(ST.stream_score_readings(stream, model, "logistic_regression", S.MODEL_INPUTS, as_of=as_of), "t-score"))
    readings = metrics_small.select(F.col(S.KEY).alias("reading_id"), S.HOST, S.TS, *S.METRIC_COLS, "hour", "day_of_week")
    batch, _ = score_batch(readings, model, "logistic_regression", as_of=as_of)
    cols = ["reading_id", "failure_probability", "failure_risk", "confidence", "recommendation_codes"]
    assert sorted(map(tuple, out.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))


def test_rollup_windows_ignore_the_session_zone(spark):
    """Event time read without the session zone: rows in a DST gap fall in
    the same 5-minute windows as the batch roll-up, in any session zone."""
    base = shared_path(spark, "dst")
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    rows = [
        (1, "2024-03-10 01:58:00", 1, "click", 1.0, "{}"),
        (2, "2024-03-10 02:31:00", 1, "error", 2.0, "{}"),  # no such wall-clock time in New York
        (3, "2024-03-10 03:32:00", 1, "click", 3.0, "{}"),
        (4, "2024-03-10 05:00:00", 1, "click", 4.0, "{}"),  # moves the watermark past the others
    ]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{base}/b0")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stream = folder_stream(spark, base + "/*/*.parquet", schema)
        out = spark.read.parquet(run_to_table(ST.stream_rollup(stream), "t-dst"))
        got = sorted((r.window_start, r.n_events, r.n_errors) for r in out.collect())
        batch = MO.sample_rollup(spark.read.parquet(f"{base}/b0"))
        want = sorted((r.window_start, r.n_events, r.n_errors) for r in batch.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [w for w in want if w[0] < pd.Timestamp("2024-03-10 04:50:00")]
    assert any(w[0] == pd.Timestamp("2024-03-10 02:30:00") and w[2] == 1 for w in got)
