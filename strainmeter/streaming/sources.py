"""Stream sources and sinks: file streams over the given tables or a landing
folder, sinks written to the shared folder with a checkpoint location."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strainmeter.session import shared_path
from strainmeter.sources.adapt import events_to_metrics


#: Files of a micro-batch: a host's rows of one are in a task's memory at once.
MAX_FILES = 256


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int = MAX_FILES) -> DataFrame:
    """A file stream over one table of ``sf_dir`` (files picked by name)."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    return r.option("maxFilesPerTrigger", max_files).parquet(sf_dir)


def folder_stream(spark: SparkSession, path: str, schema, max_files: int = MAX_FILES) -> DataFrame:
    """A file stream over a landing folder (new files = new rows)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def metrics_stream(events_stream: DataFrame) -> DataFrame:
    """The metric rule applied to a stream of events (stateless)."""
    return events_to_metrics(events_stream)


def _run(df: DataFrame, start, state_partitions: int | None) -> None:
    """Start a query and wait for its end (``availableNow``). Stateful
    operators keep the shuffle-partition count the query starts with (it is
    stored in the checkpoint): ``state_partitions`` (default 2 x the cluster's
    parallelism) is set for the start only."""
    spark = df.sparkSession
    n = state_partitions or 2 * spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        q: StreamingQuery = start(df.writeStream.trigger(availableNow=True))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def run_to_table(
    df: DataFrame,
    name: str,
    mode: str = "append",
    path: str | None = None,
    state_partitions: int | None = None,
) -> str:
    """Run a streaming query to completion (``availableNow``) into a Parquet
    table in the shared folder; the checkpoint makes it restartable."""
    out = path or shared_path(df.sparkSession, f"stream-{name}")
    _run(df, lambda w: w.format("parquet").outputMode(mode).option("checkpointLocation", out + "-checkpoint").start(out), state_partitions)
    return out


BATCH_ID = "batch_id"


def run_to_tables(df: DataFrame, routes: dict[str, Callable[[DataFrame], DataFrame]], base: str, state_partitions: int | None = None) -> dict[str, str]:
    """Run a streaming query to completion into several tables under ``base``
    (one per route: name -> rows of a micro-batch), each micro-batch exactly
    once.

    A micro-batch overwrites its own folder ``<table>/batch_id=<n>`` in every
    table. A run that ends between two writes, or before the engine has noted
    the batch as done, repeats that batch with the same rows and the same id
    when it is started again on the same ``base``, so nothing is doubled or
    lost. The batch is computed once for all tables."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, rows in routes.items():
                rows(batch).write.mode("overwrite").parquet(f"{base}/{name}/{BATCH_ID}={batch_id}")
        finally:
            batch.unpersist()

    _run(df, lambda w: w.outputMode("append").option("checkpointLocation", f"{base}/checkpoint").foreachBatch(write).start(), state_partitions)
    return {name: f"{base}/{name}" for name in routes}


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All micro-batches of a table of ``run_to_tables``."""
    return spark.read.parquet(path).drop(BATCH_ID)
