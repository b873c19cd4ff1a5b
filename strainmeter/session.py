"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

# number of rows one window / rank bucket should hold at most (sets how many
# range buckets a long ordered series is cut into)
DEFAULT_ROWS_PER_BUCKET = 2_000_000
# a table that is one series is cut for every core, into ranges of at least so
# many rows
LEAST_RANGE_ROWS = 250_000
# rows of one partition of a table that model fits iterate on
FIT_ROWS_PER_TASK = 250_000
# small side tables below this many rows may be broadcast
BROADCAST_ROWS = 1_000_000


# JVM option for driver and executors: wide projections generate methods
# over HotSpot's 8000-byte JIT limit, which would otherwise stay interpreted
JIT_HUGE_METHODS = "-XX:-DontCompileHugeMethods"


def cluster_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of Parquet with
    ``total_cores`` task slots (e.g. 100 TB on 1000 executors x 8 cores).

    Scan splits and shuffle partitions of about ``target_partition_bytes``
    keep a task's share within executor memory (sorts and window buffers
    spill beyond it). Shuffles start with at least one partition per
    target-sized piece of the input (and at least 2 waves of tasks); AQE
    coalesces small ones, splits skewed join partitions and turns joins
    into broadcasts only when the runtime size is below its threshold.
    Nothing here sets a checkpoint folder: the cluster names the shared one
    in ``spark.checkpoint.dir``."""
    pieces = max(1, -(-int(input_bytes) // target_partition_bytes))
    shuffle = max(2 * total_cores, pieces)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.extraJavaOptions": JIT_HUGE_METHODS,
        "spark.executor.extraJavaOptions": JIT_HUGE_METHODS,
    }


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "strainmeter") -> SparkSession:
    """A local session configured like the tests and the bench (UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.extraJavaOptions", JIT_HUGE_METHODS)
        .config("spark.executor.extraJavaOptions", JIT_HUGE_METHODS)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A cluster names it in its configuration. Only a local master (tests,
    bench) gets a fresh scratch folder when it is unset; on a cluster a
    machine-local folder would not survive the loss of that machine, so
    the setting is required there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (written tables and checkpoints go there)")
        conf_dir = tempfile.mkdtemp(prefix="strainmeter-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", conf_dir)
        except Exception:  # a core setting; some versions refuse it at runtime
            pass
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_root(spark: SparkSession) -> str:
    """The shared folder itself (not the per-application subfolder Spark
    creates under it for RDD checkpoints)."""
    ensure_checkpoint_dir(spark)
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return conf_dir or spark.sparkContext.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def together(spark: SparkSession, calls: list[Callable[[], T]], at_once: int | None = None) -> list[T]:
    """Results of independent ``calls``, each in a thread of its own (so many
    at once): the jobs of one use the cores that those of another leave idle."""
    with ThreadPoolExecutor(max(1, min(len(calls), at_once or len(calls)))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(c)) for c in calls]]


def cache_bytes(spark: SparkSession) -> int:
    """Memory that cached rows may take, on all executors together."""
    held = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().valuesIterator()
    total = 0
    while held.hasNext():
        total += held.next()._1()
    return total


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, whatever folder they start in: a
    zip of its sources that Spark serves to the executors, once a session."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="strainmeter-code-"), "strainmeter-streams"), "zip", os.path.dirname(root), "strainmeter")
    sc.addPyFile(made)
    _shipped.add(sc.applicationId)


_shipped: set[str] = set()
