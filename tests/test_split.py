"""Exact splits: class shares, sizes, folds, time order."""

import math

from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.operators import split as SP


def test_stratified_shares(spark, metrics_small):
    s = SP.stratified_split(metrics_small, n_buckets=4)
    c = {(r[S.LABEL], r["is_test"]): r["n"] for r in s.groupBy(S.LABEL, "is_test").agg(F.count("*").alias("n")).collect()}
    for y in (0, 1):
        n = c[(y, True)] + c[(y, False)]
        assert c[(y, True)] == math.ceil(0.2 * n)


def test_time_split_is_the_latest(spark, metrics_small):
    s = SP.time_split(metrics_small, n_buckets=3)
    last_train = s.filter(~F.col("is_test")).agg(F.max(S.TS)).first()[0]
    first_test = s.filter("is_test").agg(F.min(S.TS)).first()[0]
    assert last_train <= first_test
    assert s.filter("is_test").count() == math.ceil(0.2 * metrics_small.count())


def test_folds_balanced(spark, metrics_small):
    f = SP.stratified_folds(metrics_small, n_buckets=3)
    counts = [r["n"] for r in f.groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert len(counts) == 5 and max(counts) - min(counts) <= 2


def test_split_is_mixed_over_ids_and_follows_the_seed(spark):
    from strainmeter.sources.io import events_metrics

    s = SP.stratified_split(events_metrics(spark, "/root/testdata/sf0.01"))
    shares = s.groupBy((F.col(S.KEY) / 1000).cast("int").alias("d")).agg(F.avg(F.col("is_test").cast("int")).alias("x")).collect()
    assert len(shares) == 10 and all(0.15 <= r["x"] <= 0.25 for r in shares)
    keys = spark.range(2**63 - 200, 2**63 - 1).select(SP.shuffled_key(F.col("id")).alias("a"), SP.shuffled_key(F.col("id"), 7).alias("b"))
    rows = keys.collect()
    assert len({r["a"] for r in rows}) == len(rows) and all(0 <= r["a"] < 2**60 for r in rows)
    assert sorted(range(len(rows)), key=lambda i: rows[i]["a"]) != sorted(range(len(rows)), key=lambda i: rows[i]["b"])
