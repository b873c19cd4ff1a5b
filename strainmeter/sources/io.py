"""Scans and writes of metric, feature, reading and prediction tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from strainmeter import schema as S
from strainmeter.operators.clean import nan_to_null
from strainmeter.sources.adapt import events_to_metrics


DATE_COL = "event_date"  # partition column of tables written by day

# text formats keep microseconds (Spark's default writes milliseconds only)
TS_TEXT_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


class MissingInputError(FileNotFoundError):
    """Named error for a missing input table."""


class MissingColumnError(ValueError):
    """Named error for columns an input table must have."""


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def table_fingerprint(spark: SparkSession, path: str) -> str:
    """Total bytes, file count and latest modification time of a table's
    files (one file or a folder), from the file system's metadata: a cache
    keyed by it is not served for data rewritten at the same path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    st, held = fs.getFileStatus(p), fs.getContentSummary(p)  # two calls, however many files
    names = fs.listStatus(p) if st.isDirectory() else [st]
    latest = max([st.getModificationTime(), *(n.getModificationTime() for n in names)])
    return f"{held.getLength()}:{held.getFileCount()}:{latest}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _read(spark, table_path(sf_dir, name), "parquet")


def _read(spark: SparkSession, path: str, fmt: str, schema=None, **options) -> DataFrame:
    try:
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.options(**options).format(fmt).load(path)
    except AnalysisException as e:  # path does not exist
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise MissingInputError(f"input table not found: {path}") from e
        raise


def events_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric table derived from the ``events`` test table."""
    return events_to_metrics(read_table(spark, sf_dir, "events"))


def between_times(df: DataFrame, since=None, until=None, ts: str = S.TS) -> DataFrame:
    """Rows with since <= ts < until. Where the table is partitioned by day
    (``write_table``), the same bounds on ``event_date`` prune its folders: a
    filter on ``ts`` alone only reaches the files' row groups."""
    for bound, keep, prune in ((since, "{0} >= {1}", "{0} >= CAST({1} AS DATE)"), (until, "{0} < {1}", "{0} <= CAST({1} AS DATE)")):
        if bound is None:
            continue
        at = f"TIMESTAMP_NTZ'{bound if isinstance(bound, str) else bound.isoformat(sep=' ')}'"
        df = df.filter(keep.format(f"`{ts}`", at))
        if DATE_COL in df.columns:
            df = df.filter(prune.format(f"`{DATE_COL}`", at))
    return df


def _without_nan(df: DataFrame) -> DataFrame:
    """NaN read as missing: NULL."""
    return nan_to_null(df, [c for c, t in df.dtypes if t in ("double", "float")])


def scan_metrics(spark: SparkSession, path: str, fmt: str = "parquet", since=None, until=None) -> DataFrame:
    """Read a raw metric table with the fixed schema (CSV: header, timestamp
    parsed as TIMESTAMP_NTZ), NaN as NULL, with since <= ts < until."""
    if fmt == "csv":
        raw = _read(spark, path, "csv", schema=_csv_schema(S.METRICS_SCHEMA), header="true")
        raw = raw.withColumn(S.TS, F.to_timestamp_ntz(F.col(S.TS)))
    else:
        raw = _read(spark, path, fmt)
        missing = [f.name for f in S.METRICS_SCHEMA.fields if f.name not in raw.columns]
        if missing:
            raise MissingColumnError(f"{path} lacks {', '.join(missing)}")
    rows = between_times(raw, since, until)
    return _without_nan(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.METRICS_SCHEMA.fields]))


def scan_features(spark: SparkSession, path: str, fmt: str = "parquet", since=None, until=None) -> DataFrame:
    """Read a feature table written by ``write_table``, NaN as NULL, with
    since <= ts < until. CSV carries no types: they come from the feature
    list; other columns stay text."""
    if fmt != "csv":
        return _without_nan(between_times(_read(spark, path, fmt), since, until))
    text = _read(spark, path, "csv", header="true")
    missing = [c for c in S.FEATURE_COLS if c not in text.columns]
    if missing:
        raise MissingColumnError(f"{path} lacks {', '.join(missing)}")
    types = dict.fromkeys(S.FEATURE_COLS, "int") | dict.fromkeys(S.DOUBLE_FEATURES, "double")
    types |= {S.TS: "timestamp_ntz", S.KEY: "bigint", S.HOST: "bigint"}
    typed = text.select(*[F.col(c).cast(types.get(c, "string")).alias(c) for c in text.columns])
    return _without_nan(between_times(typed, since, until))


def _csv_schema(schema):
    return T.StructType([T.StructField(f.name, T.StringType() if f.name == S.TS else f.dataType, True) for f in schema.fields])


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, date_col: str | None = S.TS, replace: str = "table"
) -> str:
    """Write a table, by default partitioned by the sample date so that later
    scans prune by day.

    Rows are rebalanced by partition before the write: AQE makes each day's
    part of the shuffle one file or, beyond the advisory partition size
    (``session.cluster_settings``: 256 MiB), as many as its bytes need, so
    there are about bytes / advisory size + days files, whatever the number
    of tasks. ``replace='table'`` overwrites all, ``'partitions'`` only the
    partitions that ``df`` has rows of."""
    if replace not in ("table", "partitions"):
        raise ValueError(f"unknown replace {replace!r}")
    out = df
    parts = list(partition_by or [])
    if partition_by is None and date_col and date_col in df.columns:
        out = df.withColumn(DATE_COL, F.to_date(F.col(date_col)))
        parts = [DATE_COL]
    w = (out.hint("rebalance", *[F.col(c) for c in parts]) if parts else out).write.mode("overwrite")
    if parts:
        w = w.partitionBy(*parts).option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    if fmt == "csv":
        w.options(**TS_TEXT_OPTIONS).option("header", "true").csv(path)
    elif fmt == "json":
        w.options(**TS_TEXT_OPTIONS).json(path)
    else:
        w.format(fmt).save(path)
    return path


BODY_ERROR = "body_error"
MALFORMED_BODY, MALFORMED_READING = "body:malformed", "reading:malformed"


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """Readings of batch bodies (a JSON array a line), and what couldn't be
    read: columns of a reading, ``body_error`` and ``raw``.

    A line that isn't a JSON array comes back whole as one row with
    ``body:malformed``; an element that isn't a reading (a value of another
    type, not an object) as one row with ``reading:malformed``, beside the
    body's good readings. Good rows have neither. An empty line or array has
    no rows."""
    corrupt = "_corrupt"
    text = _read(spark, path, "text").filter(F.trim("value") != "")
    body = text.select("value", F.from_json("value", "array<string>").alias("items"))
    # a broken end leaves an array cut short or NULL: only a parse that holds
    # the whole line counts
    whole = F.coalesce(F.json_array_length("value").isNotNull() & F.col("items").isNotNull(), F.lit(False))
    typed = T.StructType([*S.READING_SCHEMA.fields, T.StructField(corrupt, T.StringType())])
    items = body.filter(whole).select(F.explode("items").alias("raw"))
    parsed = items.select("raw", F.from_json("raw", typed, TS_TEXT_OPTIONS | {"columnNameOfCorruptRecord": corrupt}).alias("r"))
    names = [f.name for f in S.READING_SCHEMA.fields]
    wrong = F.col("raw").isNull() | F.col("r").isNull() | F.col(f"r.{corrupt}").isNotNull()
    read = parsed.select(
        *[F.when(~wrong, F.col(f"r.{c}")).alias(c) for c in names],
        F.when(wrong, F.lit(MALFORMED_READING)).alias(BODY_ERROR),
        F.when(wrong, F.col("raw")).alias("raw"),
    )
    lost = body.filter(~whole).select(F.lit(MALFORMED_BODY).alias(BODY_ERROR), F.col("value").alias("raw"))
    return read.unionByName(lost, allowMissingColumns=True)


def read_readings_json(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Readings with the fixed schema from JSON: ``lines`` holds a reading a
    line, ``bodies`` a batch body (an array of readings) a line, ``files`` one
    batch body a file, over any number of lines. ``read_bodies`` also gives
    what bodies hold that can't be read."""
    if layout == "bodies":
        return read_bodies(spark, path).filter(F.col(BODY_ERROR).isNull()).drop(BODY_ERROR, "raw")
    if layout not in ("lines", "files"):
        raise ValueError(f"unknown layout {layout!r}")
    return _read(spark, path, "json", schema=S.READING_SCHEMA, multiLine=str(layout == "files").lower(), **TS_TEXT_OPTIONS)


def write_readings_bodies(readings: DataFrame, path: str, size: int = 1000) -> str:
    """Batch bodies of consecutive ids, at most ``size`` readings each, one a line."""
    fields = F.struct(*[F.col(f.name) for f in S.READING_SCHEMA.fields])
    bodies = readings.groupBy(F.floor(F.col("reading_id") / size)).agg(F.collect_list(fields).alias("body"))
    bodies.select(F.to_json("body", TS_TEXT_OPTIONS).alias("value")).write.mode("overwrite").text(path)
    return path


def write_readings_json(readings: DataFrame, path: str) -> str:
    readings.write.mode("overwrite").options(**TS_TEXT_OPTIONS).json(path)
    return path


def write_predictions(predictions: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write predictions and return the envelope summary (count, time), from
    the written table: the scoring plan runs once."""
    predictions.write.mode("overwrite").format(fmt).save(path)
    return prediction_envelope(predictions.sparkSession.read.schema(predictions.schema).format(fmt).load(path))


def prediction_envelope(predictions: DataFrame) -> DataFrame:
    return predictions.agg(F.count(F.lit(1)).alias("count"), F.max("timestamp").alias("timestamp"))
