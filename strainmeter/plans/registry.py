"""Model registry on shared storage: one ``PipelineModel`` folder per model,
the ordered input manifest as a table, an append-only table of fit records,
the model choice and the promotion gate."""

from __future__ import annotations

import datetime as dt
import hashlib
import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from strainmeter import schema as S
from strainmeter.session import shared_root

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("insert_pos", T.IntegerType()),
        T.StructField("trained_at", T.TimestampNTZType()),
        T.StructField("feature_count", T.IntegerType()),
        T.StructField("n_train", T.LongType()),
        T.StructField("n_test", T.LongType()),
        T.StructField("auc", T.DoubleType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
    ]
)


class Registry:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self.test_part: DataFrame | None = None  # of the fits made through this object

    # paths
    def model_path(self, name: str) -> str:
        return f"{self.base}/models/{name}"

    @property
    def records_path(self) -> str:
        return f"{self.base}/records"

    @property
    def manifest_path(self) -> str:
        return f"{self.base}/manifest"

    @property
    def fills_path(self) -> str:
        return f"{self.base}/fills"

    # writes
    def save_model(self, name: str, model: PipelineModel) -> None:
        model.write().overwrite().save(self.model_path(name))

    def save_manifest(self, inputs: list[str]) -> None:
        rows = [(i, n) for i, n in enumerate(inputs)]
        self.spark.createDataFrame(rows, "pos INT, name STRING").coalesce(1).write.mode("overwrite").json(self.manifest_path)

    def save_fills(self, fills: dict[str, float | None]) -> None:
        """The lag fills of the fit (column -> mean)."""
        self.spark.createDataFrame(list(fills.items()), "name STRING, mean DOUBLE").coalesce(1).write.mode("overwrite").parquet(self.fills_path)

    def append_records(self, records: DataFrame) -> None:
        records.select(*[f.name for f in RECORD_SCHEMA.fields]).coalesce(1).write.mode("append").parquet(self.records_path)

    # reads
    def manifest(self) -> list[str]:
        rows = self.spark.read.schema("pos INT, name STRING").json(self.manifest_path).orderBy("pos").collect()
        return [r["name"] for r in rows]

    def fills(self) -> dict[str, float | None]:
        """Lag fills of the fit: what serving fills gaps with too."""
        return {r["name"]: r["mean"] for r in self.spark.read.schema("name STRING, mean DOUBLE").parquet(self.fills_path).collect()}

    def records(self) -> DataFrame:
        return self.spark.read.schema(RECORD_SCHEMA).parquet(self.records_path)

    def latest_records(self) -> DataFrame:
        """Latest fit record per model."""
        w = Window.partitionBy("model").orderBy(F.col("trained_at").desc(), F.col("insert_pos").desc())
        return self.records().withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")

    def load(self, name: str) -> PipelineModel:
        return PipelineModel.load(self.model_path(name))

    def available(self) -> list[str]:
        try:
            return [r["model"] for r in self.latest_records().select("model").collect()]
        except AnalysisException:
            return []

    def choose(self, mode: str = "preference") -> str:
        """``preference``: boosted > forest > logistic among the saved models
        (the reference's scoring rule); ``best_auc``: highest AUC, the first
        inserted winning ties."""
        if mode == "preference":
            have = set(self.available())
            for n in S.MODEL_PREFERENCE:
                if n in have:
                    return n
            raise ValueError("no models in the registry")
        if mode == "best_auc":
            return best_by_auc(self.latest_records()).first()["model"]
        raise ValueError(f"unknown choice {mode!r}")

    def info(self, first_n: int = 20) -> DataFrame:
        """Model info view: fit date, feature count, models, first names."""
        man = self.manifest()
        rec = self.latest_records()
        return rec.agg(
            F.max("trained_at").alias("trained_at"),
            F.max("feature_count").alias("feature_count"),
            F.sort_array(F.collect_set("model")).alias("models"),
        ).withColumn("first_features", F.slice(F.array(*[F.lit(n) for n in man]), 1, first_n))


def best_by_auc(records: DataFrame) -> DataFrame:
    """One row: the model with the highest AUC; ties go to the first inserted."""
    return records.agg(F.max_by("model", F.struct(F.col("auc"), -F.col("insert_pos"))).alias("model"))


def promotion_gate(records: DataFrame, metric: str = "auc", thresholds: dict[str, float] | None = None) -> DataFrame:
    """Per model and stage: does the metric reach the stage threshold?"""
    th = thresholds or S.STAGE_THRESHOLDS
    stages = F.array(*[F.struct(F.lit(k).alias("stage"), F.lit(float(v)).alias("threshold")) for k, v in th.items()])
    return (
        records.select("model", F.col(metric).alias("value"), F.explode(stages).alias("s"))
        .select("model", "s.stage", "s.threshold", "value", (F.col("value") >= F.col("s.threshold")).alias("passed"))
    )


def registry_for(spark: SparkSession, key: str) -> Registry:
    """A registry folder under the shared checkpoint folder, named by a key
    (data location and parameters), so fits are shared between runs."""
    base = shared_root(spark)
    h = hashlib.sha1(key.encode()).hexdigest()[:16]
    return Registry(spark, os.path.join(base, f"model-registry-{h}"))


def now_ntz() -> dt.datetime:
    return dt.datetime.now()
