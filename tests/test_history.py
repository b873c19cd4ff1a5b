"""Incremental scoring with the keyed history table, fills of the fit, and
point-in-time lookups."""

import datetime as dt

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.fixtures import fixture_model, invalid_fixture
from strainmeter.operators import clean as C
from strainmeter.operators import features as FE
from strainmeter.operators import monitor as MO
from strainmeter.plans.history import LATE_CODE, HistoryStore, reading_rows, score_incremental
from strainmeter.session import shared_path

AS_OF = "2024-02-01 00:00:00"


def _readings(metrics):
    """Rejected readings, a hot host, a host that is seen once, and one
    without a name."""
    k = F.col(S.KEY)
    host = F.when(k % 3 == 0, 0).when(k == 500, 77).when(k % 11 == 1, None).otherwise(k % 4 + 1).cast("long")
    return invalid_fixture(metrics).withColumn(S.HOST, host).drop(S.LABEL, "is_weekend", "is_business_hours").withColumnRenamed(S.KEY, "reading_id").cache()


def _frame(df):
    return df.orderBy(S.KEY).toPandas().reset_index(drop=True)


@pytest.mark.parametrize("rows_per_bucket", [2_000_000, 40])
def test_batches_give_the_feature_table(spark, metrics_small, rows_per_bucket):
    readings = _readings(metrics_small)
    valid, bad = C.split_valid(readings)
    fills = FE.lag_fills(valid)
    store = HistoryStore(spark, shared_path(spark, "t-history"), rows_per_bucket)
    period = F.floor(F.dayofmonth(S.TS) / 8)
    preds, rejected, version = [], [], 0
    for p in range(4):
        batch = readings.filter(period == p)
        if p == 2:  # a run that stopped half way: the batch is repeated
            score_incremental(batch.limit(20), store, version, fixture_model(), "fixture", fills, as_of=AS_OF)
        good, no, version = score_incremental(batch, store, version, fixture_model(), "fixture", fills, as_of=AS_OF, with_inputs=S.MODEL_INPUTS)
        preds.append(_frame(good.select(S.KEY, S.HOST, *S.MODEL_INPUTS)))
        rejected += [(r[S.KEY], tuple(r.violations)) for r in no.collect()]
        tail, carry = store.read(version)
        most = tail.groupBy(S.HOST).count().agg(F.max("count")).first()[0]
        assert most <= 4 and carry.groupBy(S.HOST).count().filter("count > 1").count() == 0
    got = pd.concat(preds).sort_values(S.KEY).reset_index(drop=True)
    want = _frame(FE.feature_table(reading_rows(valid), lag_fill=fills).select(S.KEY, S.HOST, *S.MODEL_INPUTS))
    pd.testing.assert_frame_equal(got, want, check_exact=False, rtol=1e-12, check_dtype=False)
    assert sorted(rejected) == sorted((r.reading_id, tuple(r.violations)) for r in bad.collect())


def test_late_readings_are_rejected_with_their_code(spark, metrics_small):
    readings = _readings(metrics_small)
    store = HistoryStore(spark, shared_path(spark, "t-late"))
    fills = FE.lag_fills(readings)
    early, rest = (readings.filter(c) for c in (F.dayofmonth(S.TS) < 10, F.dayofmonth(S.TS) >= 10))
    _, _, version = score_incremental(rest, store, 0, fixture_model(), "fixture", fills, as_of=AS_OF)
    one = early.filter(f"reading_id % 7 = 2 AND {C.valid_sql()}").withColumn(S.HOST, F.lit(2).cast("long"))
    new = one.limit(1).withColumn(S.HOST, F.lit(1234).cast("long"))
    preds, rejected, after = score_incremental(one.unionByName(new.withColumn("reading_id", F.lit(10**9))), store, version, fixture_model(), "fixture", fills, as_of=AS_OF)
    assert [r[S.KEY] for r in preds.collect()] == [10**9]
    assert {tuple(r.violations) for r in rejected.collect()} == {(LATE_CODE,)} and rejected.count() == one.count()
    before, now = ({r[S.HOST]: r.m for r in store.read(v)[0].groupBy(S.HOST).agg(F.max(S.KEY).alias("m")).collect()} for v in (version, after))
    assert now == before | {1234: 10**9}


def test_history_scoring_takes_the_fills_of_the_fit(spark, metrics_small):
    from strainmeter.plans.score import score_batch

    readings = metrics_small.select(F.col(S.KEY).alias("reading_id"), S.HOST, S.TS, *S.METRIC_COLS, "hour", "day_of_week")
    with pytest.raises(ValueError):
        score_batch(readings, fixture_model(), "fixture", mode="history")

    class Keep:
        def transform(self, df):
            self.seen = df
            return fixture_model().transform(df)

    keep = Keep()
    score_batch(readings, keep, "fixture", mode="history", lag_fill={c: -7.0 for c in S.LAG_COLS})
    first = keep.seen.filter(f"cpu_usage_lag_1 = -7 AND memory_usage_lag_2 = -7 AND error_count_lag_1 = -7").count()
    assert first == readings.select(S.HOST).distinct().count()


def test_fills_of_a_registry(spark):
    from strainmeter.plans.registry import Registry

    reg = Registry(spark, shared_path(spark, "t-fills"))
    reg.save_fills({"cpu_usage": 1.5, "memory_usage": None})
    assert reg.fills() == {"cpu_usage": 1.5, "memory_usage": None}


def _lookup_tables(spark, metrics):
    rows = metrics.select(S.KEY, F.when(F.col(S.KEY) % 3 == 0, 0).otherwise(F.col(S.KEY) % 5).cast("long").alias(S.HOST), F.expr("CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ)").alias(S.TS), F.when(F.col(S.KEY) % 4 > 0, F.col("cpu_usage")).alias("cpu_usage"), "memory_usage")
    asked = metrics.select((F.col(S.KEY) % 300).alias("request"), F.when(F.col(S.KEY) % 2 == 0, 0).otherwise(F.col(S.KEY) % 7).cast("long").alias(S.HOST), F.expr("CAST(date_trunc('HOUR', ts + INTERVAL 5 HOURS) AS TIMESTAMP_NTZ)").alias("as_of"))
    return rows, asked


@pytest.mark.parametrize("options", [{}, {"rows_per_bucket": 60}, {"n_buckets": 16}])
def test_lookups_equal_an_as_of_join(spark, metrics_small, options):
    rows, asked = _lookup_tables(spark, metrics_small)
    names = ["cpu_usage", "memory_usage"]
    got = MO.features_as_of(asked, rows, names, **options)
    assert got.columns == ["request", S.HOST, "as_of", "feature_ts", *names]
    rows_pd, asked_pd = rows.toPandas(), asked.toPandas()  # noqa: F841  (read by DuckDB)
    want = duckdb.sql(
        "WITH l AS (SELECT * FROM rows_pd QUALIFY row_number() OVER (PARTITION BY host_id, ts ORDER BY event_id DESC) = 1)"
        " SELECT a.request, a.host_id, a.as_of, l.ts, l.cpu_usage, l.memory_usage FROM asked_pd AS a ASOF LEFT JOIN l ON a.host_id = l.host_id AND a.as_of >= l.ts"
    ).fetchall()
    plain = lambda rs: sorted((tuple(None if v != v else v for v in r) for r in rs), key=repr)
    assert plain(map(tuple, got.collect())) == plain(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_lookups_of_odd_requests(spark):
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    rows = spark.createDataFrame([(1, 5, t(1), 1.0), (2, 5, t(1), None), (3, 5, t(3), 3.0), (4, None, t(2), 4.0), (5, 6, None, 5.0)], "event_id long, host_id long, ts timestamp_ntz, a double")
    asked = spark.createDataFrame([("x", 5, t(0)), ("x", 5, t(1)), ("x", 5, t(1)), ("y", 5, t(2, 59)), ("y", 5, t(9)), ("z", None, t(2)), ("z", 6, t(9)), ("z", 7, t(9)), ("n", 5, None)], "_row string, host_id long, as_of timestamp_ntz")
    got = sorted((tuple(r) for r in MO.features_as_of(asked, rows, ["a"]).collect()), key=repr)
    assert got == sorted([("x", 5, t(0), None, None), ("x", 5, t(1), t(1), None), ("x", 5, t(1), t(1), None), ("y", 5, t(2, 59), t(1), None), ("y", 5, t(9), t(3), 3.0), ("z", None, t(2), t(2), 4.0), ("z", 6, t(9), None, None), ("z", 7, t(9), None, None), ("n", 5, None, None, None)], key=repr)
    young = {(r._row, r.as_of): r.a for r in MO.features_as_of(asked, rows, ["a"], max_age="2 HOURS").filter("host_id = 5").collect()}
    assert young["y", t(9)] is None and MO.features_as_of(asked.limit(0), rows, ["a"]).count() == 0
    assert MO.features_as_of(asked, rows.limit(0), ["a"]).filter("a IS NOT NULL").count() == 0


def test_a_batch_reads_its_own_period(spark, monkeypatch):
    from strainmeter.plans.catalog import q_models

    seen = []
    real = q_models.score_incremental

    def noted(readings, *args, **options):
        seen.append(readings._jdf.queryExecution().executedPlan().toString())
        return real(readings, *args, **options)

    monkeypatch.setattr(q_models, "score_incremental", noted)
    n = q_models.q_score_incremental(spark, "/root/testdata/sf0.001").count()
    assert n == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert len(seen) == 3 and all("PartitionFilters: [isnotnull(_period" in plan for plan in seen)
