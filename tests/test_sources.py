"""Named errors, JSON layouts, typed CSV, both sides of a batch."""

import json

import pytest
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.fixtures import fixture_score, invalid_fixture
from strainmeter.operators import clean as C
from strainmeter.operators.features import feature_table
from strainmeter.plans.score import score_readings, with_rejected
from strainmeter.session import shared_path
from strainmeter.sources import io as IO


def test_missing_column_is_named(spark, metrics_small):
    path = shared_path(spark, "lacking")
    metrics_small.drop("cpu_usage").write.parquet(path)
    with pytest.raises(IO.MissingColumnError, match="cpu_usage"):
        IO.scan_metrics(spark, path)


def test_pretty_printed_batch_body(spark):
    path = shared_path(spark, "body")
    body = [{"reading_id": i, "cpu_usage": 10.5 + i, "error_count": i} for i in range(2)]
    spark.createDataFrame([(json.dumps(body, indent=2),)], "value string").coalesce(1).write.text(path)
    got = IO.read_readings_json(spark, path, layout="files").orderBy("reading_id").collect()
    assert [(r["reading_id"], r["cpu_usage"], r["host_id"]) for r in got] == [(0, 10.5, None), (1, 11.5, None)]


def test_unknown_layout(spark):
    with pytest.raises(ValueError, match="layout"):
        IO.read_readings_json(spark, "/nowhere", layout="table")


def test_feature_csv_keeps_types(spark, metrics_small):
    ft = feature_table(metrics_small)
    path = shared_path(spark, "ft-csv")
    IO.write_table(ft, path, fmt="csv", partition_by=[])
    back = IO.scan_features(spark, path, fmt="csv")
    assert dict(back.dtypes) == dict(ft.dtypes)
    assert back.exceptAll(ft.select(*back.columns)).count() == 0


def test_every_reading_is_scored_or_rejected(spark, metrics_small):
    m = invalid_fixture(metrics_small)
    valid, bad = C.split_valid(m)
    both = with_rejected(score_readings(fixture_score(valid), as_of="2024-02-01 00:00:00").select(S.KEY, "failure_probability"), bad)
    assert both.count() == m.count()
    assert both.filter("violations IS NOT NULL").count() == bad.count() > 0
    assert both.filter("violations IS NOT NULL AND failure_probability IS NOT NULL").count() == 0


def test_late_stream_rows_leave_the_state_alone(spark):
    import pandas as pd

    from pyspark.sql import types as T

    from strainmeter.streaming import stateful as ST

    class State:
        exists, get, hasTimedOut, timer = False, None, False, None

        def __init__(self):
            self.watermark = 0

        def update(self, value):
            self.exists, self.get = True, value

        def remove(self):
            self.exists, self.get = False, None

        def getCurrentWatermarkMs(self):
            return self.watermark

        def setTimeoutTimestamp(self, at):
            assert at >= self.watermark
            self.timer = at

    names = [S.KEY, S.TS, "v"]
    kind = T.StructType([T.StructField(S.KEY, T.LongType()), T.StructField(S.TS, T.TimestampNTZType()), T.StructField("v", T.DoubleType())])
    parts = ST._history_fn([("m3", "v", "mean", 3)], [("l1", "v", 1)], {}, ["v"], [S.TS, S.KEY, "v"], [S.KEY, "v", "m3", "l1", "is_late"], 2)
    fn = ST._in_event_time(*parts, kind, "10 minutes", "10 minutes", "1 hour")
    state = State()
    at = lambda t: int(pd.Timestamp(t).value // 10**6)

    def batch(*rows, seen=None, timer=False):
        state.watermark = at(seen) - 600_000 if seen else 0
        state.hasTimedOut = timer
        pdf = pd.DataFrame([(i, pd.Timestamp(t), v) for i, t, v in rows], columns=names)
        got = list(fn((1,), iter([] if timer else [pdf]), state))
        return pd.concat(got).set_index(S.KEY) if got else None

    assert batch((2, "2024-01-01 00:01", 2.0), (1, "2024-01-01 00:00", 1.0)) is None  # nothing is due yet
    got = batch((3, "2024-01-01 00:02", 3.0), seen="2024-01-01 00:11")
    assert got.index.tolist() == [1, 2] and got["m3"].tolist() == [1.0, 1.5]
    got = batch((4, "2024-01-01 00:00:30", 9.0), seen="2024-01-01 00:11:30")
    assert got.loc[4, ["m3", "l1", "is_late"]].tolist() == [9.0, 9.0, True] and len(got) == 1
    assert state.timer < at("2024-01-01 00:02") and state.timer >= at("2024-01-01 00:01:30") - 600_000 - 1
    got = batch(seen="2024-01-01 00:30", timer=True)
    assert got.loc[3, ["m3", "l1", "is_late"]].tolist() == [2.0, 2.0, False]
    assert state.exists and batch(seen="2024-01-01 00:50", timer=True) is None and state.exists
    assert batch(seen="2024-01-01 02:00", timer=True) is None and not state.exists
    with pytest.raises(ValueError):
        ST._in_event_time(*parts, kind, "10 minutes", "5 minutes", "1 hour")


def test_a_large_micro_batch_is_processed_in_bounded_frames(monkeypatch):
    """One host's rows in any order, far more than are sorted at once: frames
    are bounded, all rows but the last 10 minutes come out in the first
    micro-batch, and the state keeps those alone."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    from pyspark.sql import types as T

    from strainmeter.streaming import stateful as ST

    monkeypatch.setattr(ST, "RUN_ROWS", 500)
    monkeypatch.setattr(ST, "BLOCK_ROWS", 20)

    class State:
        exists, hasTimedOut, held = False, False, None
        update = lambda self, value: setattr(self, "held", value)
        getCurrentWatermarkMs = lambda self: 0
        setTimeoutTimestamp = lambda self, at: None

    kind = T.StructType([T.StructField(S.KEY, T.LongType()), T.StructField(S.TS, T.TimestampNTZType()), T.StructField("v", T.DoubleType())])
    n, rng = 6000, np.random.default_rng(3)
    rows = pd.DataFrame({S.KEY: np.arange(n), S.TS: pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n) // 3, unit="s"), "v": rng.random(n)})
    rows.loc[rng.random(n) < 0.1, "v"] = np.nan
    parts = ST._history_fn([("m3", "v", "mean", 3)], [("l1", "v", 1)], {}, ["v"], [S.TS, S.KEY, "v"], [S.KEY, "v", "m3", "l1", "is_late"], 2)
    whole, _ = parts[0]((1,), rows, None)
    for sent in (rows, rows.iloc[::-1], rows.sample(frac=1, random_state=5), pd.concat([rows[rows.index % 2 == 0], rows[rows.index % 2 == 1]])):
        sizes, state = [], State()

        def process(key, pdf, inner):
            sizes.append(len(pdf))
            return parts[0](key, pdf, inner)

        fn = ST._in_event_time(process, parts[1], kind, "10 minutes", "10 minutes", "1 hour")
        got = pd.concat(fn((1,), iter([sent.iloc[i : i + 130] for i in range(0, n, 130)]), state), ignore_index=True)
        assert max(sizes) <= 500 and not got["is_late"].any()
        due = n - 3 * 600
        pd.testing.assert_frame_equal(got, whole.iloc[:due].reset_index(drop=True), check_dtype=False)
        with pa.ipc.open_stream(state.held[0]) as r:
            assert r.read_all().num_rows == n - due


def test_bodies_that_cannot_be_read_are_reported(spark):
    path = shared_path(spark, "bodies")
    good = {"reading_id": 1, "cpu_usage": 1.5, "ts": "2024-01-01T00:00:00.000001"}
    lines = [json.dumps([good, good | {"reading_id": 2}]), json.dumps([good, {"reading_id": "x"}, 7, None, {}]), json.dumps([good, good])[:-9], "not json", json.dumps({"reading_id": 3}), "", "[]", "null"]
    spark.createDataFrame([(v,) for v in lines], "value string").write.text(path)
    got = IO.read_bodies(spark, path).collect()
    assert sorted(r.reading_id for r in got if r.body_error is None and r.reading_id) == [1, 1, 2]
    assert sum(r.body_error is None for r in got) == 4  # {} is a reading without fields
    assert sorted(r.raw for r in got if r.body_error == IO.MALFORMED_BODY) == sorted([lines[2], lines[3], lines[4], lines[7]])
    assert sorted(str(r.raw) for r in got if r.body_error == IO.MALFORMED_READING) == sorted(["7", "None", '{"reading_id":"x"}'])
    assert IO.read_readings_json(spark, path, layout="bodies").count() == 4


def _files(spark, path):
    return set(spark.read.parquet(path).inputFiles())


def test_writes_make_few_files_and_leave_other_days(spark):
    m = IO.events_metrics(spark, "/root/testdata/sf0.01").repartition(40)
    path = shared_path(spark, "days")
    IO.write_table(m, path)
    days = m.select(F.to_date(S.TS)).distinct().count()
    assert len(_files(spark, path)) <= days + 1
    before = {f for f in _files(spark, path) if "2024-01-03" not in f}
    IO.write_table(m.filter(F.to_date(S.TS) == F.lit("2024-01-03")).limit(5), path, replace="partitions")
    assert before < _files(spark, path) and len(_files(spark, path)) == len(before) + 1
    assert spark.read.parquet(path).filter("event_date = DATE'2024-01-03'").count() == 5
    with pytest.raises(ValueError):
        IO.write_table(m, path, replace="rows")


def test_time_bounds_prune_days(spark, metrics_small):
    path = shared_path(spark, "pruned")
    odd = metrics_small.withColumn("cpu_usage", F.when(F.col(S.KEY) % 5 == 0, float("nan")).otherwise(F.col("cpu_usage")))
    IO.write_table(odd, path)
    got = IO.scan_metrics(spark, path, since="2024-01-03 12:00:00", until="2024-01-05 00:00:00")
    plan = got._jdf.queryExecution().executedPlan().toString()
    prunes = plan[plan.index("PartitionFilters: [") :].split("]")[0]
    assert "event_date" in prunes and ">=" in prunes and "<=" in prunes
    want = metrics_small.filter("ts >= '2024-01-03 12:00:00' AND ts < '2024-01-05 00:00:00'")
    assert got.count() == want.count() > 0
    assert got.filter("cpu_usage IS NULL").count() == want.filter("event_id % 5 = 0").count()
    assert got.filter(F.isnan("cpu_usage")).count() == 0
    assert IO.scan_features(spark, path, since="2024-01-04 00:00:00").count() == metrics_small.filter("ts >= '2024-01-04'").count()


def test_fingerprint_follows_rewrites(spark, metrics_small):
    path = shared_path(spark, "print")
    metrics_small.write.parquet(path)
    a = IO.table_fingerprint(spark, path)
    assert a == IO.table_fingerprint(spark, path)
    metrics_small.limit(10).write.mode("overwrite").parquet(path)
    assert a != IO.table_fingerprint(spark, path)
