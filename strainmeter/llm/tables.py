"""Tables in the shared folder, package shipping and small plan helpers for
the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strainmeter.session import shared_path

BATCH_ROWS = 1000
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of a cluster, once a session
    (a zip of its sources; Spark sends it to each executor), and keep Arrow
    batches of whole texts small: Spark's 10,000 rows are for numbers."""
    sc = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="strainmeter-"), "strainmeter.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: the
    lineage ends there and a lost executor costs nothing already written."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, upper and lower case apart."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def small_or_shuffled(df: DataFrame, rows: int, bound: int = 200_000) -> DataFrame:
    """Broadcast hint for a side of at most ``bound`` narrow rows (counted
    before); beyond it Spark joins by shuffle."""
    return F.broadcast(df) if rows <= bound else df


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of an undirected edge list (u, v: long) as rows
    (node, comp), comp the smallest node: alternating large-star and
    small-star rounds (Kiveris et al., 2014), each a written table.

    No component is ever gathered: a hub's edges meet in an aggregate with
    map-side combine and in joins that AQE splits. Nodes without an edge to
    another node aren't in the result."""
    lo, hi = F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")
    now = written(edges.where("u <> v").select(hi, lo).distinct(), name)

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        after = state(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots)
