"""Model properties: better than a constant score, same seed same model,
save / load same scores, registry choice rules."""

import pytest
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.operators import evaluate as EV
from strainmeter.operators import features as FE
from strainmeter.operators import split as SP
from strainmeter.plans import train as TR
from strainmeter.plans.registry import Registry, best_by_auc, promotion_gate
from strainmeter.session import shared_path


@pytest.fixture(scope="module")
def parts(spark, metrics_small):
    ft = SP.stratified_split(FE.feature_table(metrics_small)).cache()
    return ft.filter(~F.col("is_test")), ft.filter("is_test")


SMALL = {
    "logistic_regression": TR.ModelSpec("logistic_regression", dict(maxIter=100), scaled=True),
    "boosted_trees": TR.ModelSpec("boosted_trees", dict(maxIter=5, maxDepth=3, seed=42)),
    "random_forest": TR.ModelSpec("random_forest", dict(numTrees=10, maxDepth=5, seed=42)),
}


@pytest.mark.parametrize("name", sorted(SMALL))
def test_beats_constant_and_is_repeatable(spark, parts, name):
    train, test = parts
    m1 = TR.fit_model(train, SMALL[name])
    auc = TR.evaluate_model(m1, test).first()["auc"]
    assert auc > 0.7
    m2 = TR.fit_model(train, SMALL[name])
    p1 = [r[0] for r in TR.score_model(m1, test).orderBy(S.KEY).select("failure_probability").collect()]
    p2 = [r[0] for r in TR.score_model(m2, test).orderBy(S.KEY).select("failure_probability").collect()]
    assert p1 == pytest.approx(p2, abs=1e-9)


def test_save_load_same_scores(spark, parts):
    train, test = parts
    m = TR.fit_model(train, SMALL["logistic_regression"])
    reg = Registry(spark, shared_path(spark, "reg-test"))
    reg.save_model("logistic_regression", m)
    back = reg.load("logistic_regression")
    a = [r[0] for r in TR.score_model(m, test).orderBy(S.KEY).select("failure_probability").collect()]
    b = [r[0] for r in TR.score_model(back, test).orderBy(S.KEY).select("failure_probability").collect()]
    assert a == b


def test_choice_rules(spark):
    rows = [("random_forest", 0, 0.9), ("logistic_regression", 1, 0.9), ("boosted_trees", 2, 0.8)]
    rec = spark.createDataFrame(rows, "model string, insert_pos int, auc double")
    assert best_by_auc(rec).first()["model"] == "random_forest"  # tie: first inserted
    gate = {(r["model"], r["stage"]): r["passed"] for r in promotion_gate(rec).collect()}
    assert gate[("random_forest", "production")] and not gate[("random_forest", "staging")]


def test_balanced_weights_sum_to_n(spark, metrics_small):
    w = EV.balanced_weights(metrics_small)
    total = w.agg(F.sum("weight")).first()[0]
    assert total == pytest.approx(metrics_small.count())


def test_written_split_table_reads_back_as_boolean(spark, metrics_small):
    from strainmeter.plans.workflow import prepared_parts

    train, test = prepared_parts(metrics_small, path=shared_path(spark, "parts-test"))
    assert train.count() + test.count() == metrics_small.count()
    assert "is_test" not in train.columns


def test_history_scoring_uses_the_feature_table(spark, parts, metrics_small):
    from strainmeter.plans.score import score_batch

    train, test = parts
    m = TR.fit_model(train, SMALL["logistic_regression"])
    readings = metrics_small.select(F.col(S.KEY).alias("reading_id"), S.HOST, S.TS, *S.METRIC_COLS, "hour", "day_of_week")
    hist, bad = score_batch(readings, m, "logistic_regression", as_of="2024-02-01 00:00:00", mode="history", lag_fill=FE.lag_fills(metrics_small))
    assert hist.count() == metrics_small.count() and bad.count() == 0
    # history inputs are the feature table's: scoring the table directly gives the same probabilities
    direct = {r[S.KEY]: r["failure_probability"] for r in TR.score_model(m, FE.feature_table(metrics_small)).select(S.KEY, "failure_probability").collect()}
    got = {r["reading_id"]: r["failure_probability"] for r in hist.collect()}
    for k, v in got.items():
        assert v == pytest.approx(round(direct[k], 4), abs=1e-4)


def test_fit_table_has_an_even_file_for_every_core(spark, metrics_small):
    from strainmeter.plans.workflow import prepared_parts

    train, _ = prepared_parts(metrics_small, path=shared_path(spark, "parts-even"))
    rows = [r["count"] for r in train.groupBy(F.input_file_name()).count().collect()]
    assert len(rows) == spark.sparkContext.defaultParallelism
    assert max(rows) < 2 * sum(rows) / len(rows)


def test_fits_run_together_and_the_forest_leaves_cores(spark, parts, monkeypatch):
    """The three fits wait for each other: one after the other would not end."""
    import threading

    from strainmeter.plans import workflow as WF

    train, test = parts
    met, real = threading.Barrier(3, timeout=60), TR.build_pipeline
    monkeypatch.setattr(TR, "build_pipeline", lambda *a: (met.wait(), real(*a))[1])
    reg = Registry(spark, shared_path(spark, "reg-together"))
    got = WF.train_models(train, test, reg, specs=SMALL)
    assert sorted(r["model"] for r in got.collect()) == sorted(SMALL)
    assert TR.forest_tasks(train) == max(1, spark.sparkContext.defaultParallelism // 2)


def test_folds_are_fitted_together(spark, metrics_small, monkeypatch):
    import threading

    table = SP.stratified_folds(FE.feature_table(metrics_small)).cache()
    met, real = threading.Barrier(S.N_FOLDS, timeout=60), TR.build_pipeline
    monkeypatch.setattr(TR, "build_pipeline", lambda *a: (met.wait(), real(*a))[1])
    mean, std = TR.cross_validate(table, SMALL["logistic_regression"])
    assert mean[0] > 0.7 and std[0] >= 0


def test_folds_at_once_are_those_that_memory_caches(spark, monkeypatch):
    import threading

    from strainmeter import session

    held = session.cache_bytes(spark)
    assert held > 1 << 28
    assert TR.folds_at_once(spark, 10, 46) > S.N_FOLDS
    assert TR.folds_at_once(spark, held // (8 * 46) // 2, 46) == 2
    assert TR.folds_at_once(spark, held, 46) == 1
    running, most, lock = [0], [0], threading.Lock()

    def call():
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        spark.range(1000).count()
        with lock:
            running[0] -= 1
        return most[0]

    assert max(session.together(spark, [call] * 5, 1)) == 1
    monkeypatch.setattr(TR, "folds_at_once", lambda *a: most.append(a) or 2)
    table = SP.stratified_folds(FE.feature_table(metrics := spark.range(400).selectExpr(
        "id AS event_id", "id % 4 AS host_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id AS INT)) AS timestamp",
        "double(id * 37 % 101) AS cpu_usage", "double(id * 53 % 101) AS memory_usage", "50D AS disk_usage", "20D AS network_latency_ms",
        "1 AS error_count", "100D AS response_time_ms", "1 AS active_connections", "int(id * 37 % 101 > 60) AS failure_within_hour",
        "1 AS hour", "1 AS day_of_week", "0 AS is_weekend", "0 AS is_business_hours").withColumnRenamed("timestamp", S.TS))).cache()
    mean, _ = TR.cross_validate(table, SMALL["boosted_trees"])
    assert mean[0] > 0.7 and most[-1][1:] == (metrics.count(), len(S.MODEL_INPUTS))


def test_parts_are_prepared_once_for_fits_and_their_metrics(spark, monkeypatch, tmp_path):
    from strainmeter.plans import workflow as WF

    calls, real = [], WF.prepared_parts
    monkeypatch.setattr(WF, "prepared_parts", lambda *a, **b: (calls.append(1), real(*a, **b))[1])
    monkeypatch.setattr(TR, "DEFAULT_SPECS", SMALL)
    monkeypatch.setattr(WF, "registry_of", lambda *a: Registry(spark, str(tmp_path / "reg")))
    reg = WF.trained_registry(spark, "/root/testdata/sf0.001")
    got = {r["model"]: r["auc"] for r in WF.evaluated(spark, "/root/testdata/sf0.001", reg).collect()}
    assert len(calls) == 1
    again = WF.trained_registry(spark, "/root/testdata/sf0.001")  # nothing to fit: the given table is read
    then = {r["model"]: r["auc"] for r in WF.evaluated(spark, "/root/testdata/sf0.001", again).collect()}
    assert len(calls) == 2 and then == pytest.approx(got) and len(got) == 3
