"""Sharding by a two-pass external shuffle.

Law ``key``: a row's shard depends on its id and the number of shards only
(highest md5 of shard number and id wins), so one more shard takes rows into
itself and moves no other. Pass 1 scatters the rows of each shard into
memory-sized buckets by a seeded hash. Pass 2 shuffles each bucket by
Fisher-Yates with a generator seeded by bucket, and writes it to its shard's
folder. A row's slot is its place in the bucket behind the rows of the
shard's earlier buckets; those counts are read from the written table.

Buckets whose hash gathers too much (repeated rows) are salted by row number
into as many parts as their size asks for, so none outgrows a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strainmeter.llm.tables import ship, small_or_shuffled
from strainmeter.session import shared_path

SHARDS = 8
SEED = 2024
BUCKET_BYTES = 12 << 20


def shard_of(key, shards: int, seed: int = SEED):
    """Column with the shard of ``key`` out of ``shards``."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    draws = [F.struct(F.md5(F.concat(F.lit(f"{seed}:{i}:"), text)).alias("h"), F.lit(i).alias("i")) for i in range(shards)]
    return F.greatest(*draws)["i"] if shards > 1 else F.lit(0)


def fisher_yates(n: int, seed: int, *bucket: int) -> np.ndarray:
    """A uniform permutation of range(n), the same for the same seeds."""
    out = np.arange(n)
    rng = np.random.default_rng([seed, *bucket])
    swap = rng.integers(0, np.arange(n, 0, -1)) if n else out
    for i in range(n - 1):
        j = i + int(swap[i])
        out[i], out[j] = out[j], out[i]
    return out


def _shuffler(seed: int):
    def shuffle(bucket: pa.Table) -> pa.Table:
        keys = [int(bucket[c][0].as_py()) for c in ("_shard", "_bucket", "_part")]
        bucket = bucket.combine_chunks().sort_by([("_mark", "ascending"), ("_row", "ascending")])
        bucket = bucket.take(pa.array(fisher_yates(bucket.num_rows, seed, *keys)))
        return bucket.drop_columns(["_mark", "_row"]).append_column("_place", pa.array(np.arange(bucket.num_rows), pa.int64()))

    return shuffle


def written_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs``, all columns, to ``path`` in shard folders and return
    the written rows with _size (bytes of the text plus 1), _crc32 (of the
    text), _shard, _grown (with one more shard) and _slot (gapless from 0 in a
    shard).

    A null text has no bytes; all null ids are one key. Repeated rows are
    rows of their own. An empty table writes nothing and gives no rows."""
    spark = docs.sparkSession
    ship(spark)
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*names.values())
    key, text = F.col(names[id_col]), F.col(names[text_col])
    body = F.coalesce(text, F.lit("")).cast("binary")
    rows = rows.withColumns({"_size": F.octet_length(body).cast("long") + 1, "_crc32": F.crc32(body), "_shard": shard_of(key, shards, seed), "_grown": shard_of(key, shards + 1, seed)})
    rows = rows.withColumn("_mark", F.xxhash64(F.lit(seed), key, "_crc32", "_size"))
    total = rows.agg(F.sum("_size")).first()[0] or 0
    buckets = max(1, -(-int(total) // (bucket_bytes * shards)))
    rows = rows.withColumn("_bucket", F.pmod("_mark", F.lit(buckets)).cast("int"))
    sizes = rows.groupBy("_shard", "_bucket").agg(F.sum("_size").alias("n")).where(F.col("n") > 2 * bucket_bytes)
    large = [(r["_shard"], r["_bucket"], -(-r["n"] // bucket_bytes)) for r in sizes.limit(10_001).collect()]
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    if large:
        parts = spark.createDataFrame(large, "_shard int, _bucket int, _parts long") if len(large) <= 10_000 else sizes.select("_shard", "_bucket", F.ceil(F.col("n") / bucket_bytes).alias("_parts"))
        rows = rows.join(small_or_shuffled(parts, len(large), 10_000), ["_shard", "_bucket"], "left")
        rows = rows.withColumn("_part", F.pmod(F.xxhash64("_row"), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    else:
        rows = rows.withColumn("_part", F.lit(0))
    rows = rows.select(*names.values(), "_size", "_crc32", "_shard", "_grown", "_bucket", "_part", "_mark", "_row")
    schema = rows.drop("_mark", "_row").schema.add("_place", "long")
    rows.groupBy("_shard", "_bucket", "_part").applyInArrow(_shuffler(seed), schema).write.partitionBy("_shard").parquet(path)

    got = spark.read.schema(schema).parquet(path)
    counts = got.groupBy("_shard", "_bucket", "_part").agg(F.count(F.lit(1)).alias("n"))
    behind = Window.partitionBy("_shard").orderBy("_bucket", "_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_shard", "_bucket", "_part", F.coalesce(F.sum("n").over(behind), F.lit(0)).alias("_start"))
    got = got.join(small_or_shuffled(starts, buckets * shards + sum(x[2] for x in large) if len(large) <= 10_000 else 1 << 40), ["_shard", "_bucket", "_part"])
    return got.select(*[F.col(v).alias(k) for k, v in names.items()], "_size", "_crc32", "_shard", "_grown", (F.col("_start") + F.col("_place")).alias("_slot"))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """Shards of ``docs`` in the shared folder, described: id, size,
    text_crc32, law, shard, slot, grown_shard, a row per document."""
    rows = written_shards(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), shared_path(docs.sparkSession, "shards"), shards, "_id", "_text")
    return rows.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc32").alias("text_crc32"), F.lit("key").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.col("_grown").alias("grown_shard"))
