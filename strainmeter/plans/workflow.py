"""End-to-end runs: metric table -> written feature table -> exact split ->
three fits -> records, registry, choice -> batch scoring."""

from __future__ import annotations

import datetime as dt
import hashlib
import os
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import strainmeter
from strainmeter import schema as S
from strainmeter.operators import features as FE
from strainmeter.operators import split as SP
from strainmeter.operators.clean import inf_to_zero
from strainmeter.plans import train as TR
from strainmeter.plans.registry import RECORD_SCHEMA, Registry, best_by_auc, now_ntz, registry_for
from strainmeter.session import shared_path, together
from strainmeter.sources import io as IO


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """The written split table; partition discovery reads ``is_test`` as a
    string, so it is cast back (a filter on it still prunes partitions)."""
    return spark.read.parquet(path).withColumn("is_test", F.col("is_test").cast("boolean"))


def prepared_parts(metrics: DataFrame, path: str | None = None, fills: dict[str, float | None] | None = None) -> tuple[DataFrame, DataFrame]:
    """Feature table with the stratified split, written once to the shared
    folder (cuts the window lineage; every fit reads the written table)."""
    spark = metrics.sparkSession
    ft = SP.stratified_split(inf_to_zero(FE.feature_table(metrics, lag_fill=fills), S.MODEL_INPUTS))
    out = path or shared_path(spark, "features-split")
    # partitioned by part: fits read only the train files, scoring only test
    TR.dealt(ft, metrics.count(), ["is_test"]).write.mode("overwrite").partitionBy("is_test").parquet(out)
    back = read_parts(spark, out)
    return back.filter(~F.col("is_test")).drop("is_test"), back.filter(F.col("is_test")).drop("is_test")


def train_models(
    train: DataFrame,
    test: DataFrame,
    registry: Registry,
    names: list[str] | None = None,
    specs: dict[str, TR.ModelSpec] | None = None,
    inputs: list[str] = S.MODEL_INPUTS,
) -> DataFrame:
    """Fit, evaluate and save the models, all at a time; append one record per
    model."""
    spark = train.sparkSession
    specs = specs or TR.DEFAULT_SPECS
    names = names or S.MODEL_ORDER
    # MLlib caches what each fit iterates on; the written table is re-read
    n_train, n_test = train.count(), test.count()
    registry.save_manifest(inputs)

    def fitted(name: str):
        model = TR.fit_model(train, specs[name], inputs, alone=len(names) == 1)
        registry.save_model(name, model)
        return TR.evaluate_model(model, test).first()

    for name, m in zip(names, together(spark, [partial(fitted, n) for n in names])):
        rec = [
            (
                name,
                S.MODEL_ORDER.index(name),
                now_ntz(),
                len(inputs),
                n_train,
                n_test,
                m["auc"],
                m["accuracy"],
                m["precision"],
                m["recall"],
                m["f1"],
            )
        ]
        registry.append_records(spark.createDataFrame(rec, RECORD_SCHEMA))
    return registry.latest_records()


def source_hash() -> str:
    """Hash of the package's sources outside its optional parts: fits aren't
    shared between versions of the code."""
    root = os.path.dirname(os.path.abspath(strainmeter.__file__))
    found = hashlib.sha1()
    for part in ("functions", "operators", "plans", "sources"):
        for folder, _, names in sorted(os.walk(os.path.join(root, part))):
            for n in sorted(n for n in names if n.endswith(".py")):
                with open(os.path.join(folder, n), "rb") as f:
                    found.update(f.read())
    return found.hexdigest()[:16]


def registry_of(spark: SparkSession, sf_dir: str) -> Registry:
    """The registry of fits on ``sf_dir``'s metric table: its folder is named
    by path, file fingerprint (rewritten data gets new fits), parameters, the
    fixed values behind features, fill and split, and the code."""
    events = IO.table_path(sf_dir, "events")
    fixed = sorted((k, v) for k, v in vars(S).items() if k.isupper())
    key = f"{strainmeter.__version__}|{source_hash()}|{events}|{IO.table_fingerprint(spark, events)}|{sorted(TR.DEFAULT_SPECS.items())!r}|{fixed!r}"
    return registry_for(spark, key)


def trained_registry(spark: SparkSession, sf_dir: str, names: list[str] | None = None, refit: bool = False) -> Registry:
    """The registry with the models ``names``, fitting those it lacks (the
    fits are shared by every query of a run), or all of them (``refit``)."""
    names = names or S.MODEL_ORDER
    reg = registry_of(spark, sf_dir)
    missing = names if refit else [n for n in names if n not in set(reg.available())]
    if missing:
        metrics = IO.events_metrics(spark, sf_dir)
        fills = FE.lag_fills(metrics)
        train, test = prepared_parts(metrics, fills=fills)
        reg.save_fills(fills)
        train_models(train, test, reg, missing)
        reg.test_part = test
    return reg


def evaluated(spark: SparkSession, sf_dir: str, reg: Registry) -> DataFrame:
    """Metrics of every saved model on the test part of ``sf_dir``'s table (as
    this call's fits have written it, if there were any)."""
    test = reg.test_part if reg.test_part is not None else prepared_parts(IO.events_metrics(spark, sf_dir), fills=reg.fills())[1]
    names = reg.available()
    rows = []
    for name, m in zip(names, together(spark, [lambda n=n: TR.evaluate_model(reg.load(n), test).first() for n in names])):
        rows.append((name, S.MODEL_ORDER.index(name), m["auc"], m["accuracy"], m["precision"], m["recall"], m["f1"]))
    return spark.createDataFrame(rows, "model STRING, insert_pos INT, auc DOUBLE, accuracy DOUBLE, precision DOUBLE, recall DOUBLE, f1 DOUBLE")


def comparison(metrics: DataFrame, choose: str = "preference") -> DataFrame:
    """Model comparison with the best-by-AUC flag (the first inserted wins
    ties) and the scoring choice."""
    best = best_by_auc(metrics).first()["model"]
    have = {r["model"] for r in metrics.select("model").collect()}
    chosen = best if choose == "best_auc" else next(n for n in S.MODEL_PREFERENCE if n in have)
    names = ["model", "auc", "accuracy", "precision", "recall", "f1"]
    return metrics.select(*names, (F.col("model") == best).alias("is_best_auc"), (F.col("model") == chosen).alias("is_scoring_choice"))


def predicted(metrics: DataFrame, model, model_name: str, fills: dict[str, float | None] | None = None) -> DataFrame:
    """Positive-class probability of every row of a metric table, from its
    feature table."""
    rows = inf_to_zero(FE.feature_table(metrics, lag_fill=fills), S.MODEL_INPUTS)
    return TR.score_model(model, rows).select(S.KEY, "failure_probability", F.lit(model_name).alias("model_used"))


def scored_readings(metrics: DataFrame, model, model_name: str, manifest: list[str] = S.MODEL_INPUTS, as_of: dt.datetime | None = None) -> DataFrame:
    """Every raw reading once: scored (point features), or rejected with its
    violations (missing, NaN, infinite or out of range)."""
    from strainmeter.plans.score import score_batch, with_rejected

    readings = metrics.select(F.col(S.KEY).alias("reading_id"), S.HOST, S.TS, *S.METRIC_COLS, "hour", "day_of_week")
    return with_rejected(*score_batch(readings, model, model_name, manifest=manifest, as_of=as_of))


def end_to_end(spark: SparkSession, sf_dir: str, as_of: dt.datetime | None = None, choose: str = "preference", readings: DataFrame | None = None) -> DataFrame:
    """Features -> fits -> registry -> score every raw reading of the table
    (or ``readings``) with the chosen model."""
    reg = trained_registry(spark, sf_dir)
    name = reg.choose(choose)
    metrics = readings if readings is not None else IO.events_metrics(spark, sf_dir)
    return scored_readings(metrics, reg.load(name), name, reg.manifest(), as_of)
