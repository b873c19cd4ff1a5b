"""Aggregates and classification metrics (whole-table, partial + final
aggregation; nothing collected but a handful of scalars)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainmeter import schema as S
from strainmeter.operators.ranking import running_sums
from strainmeter.session import DEFAULT_ROWS_PER_BUCKET


def _ratio0(num: Column, den: Column) -> Column:
    """num / den, 0 on an empty denominator (zero_division=0)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def confusion_metrics(df: DataFrame, label: str = S.LABEL, pred: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """tp, fp, tn, fn, accuracy, precision, recall, f1 (per ``by`` group)."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    agg = df.groupBy(*(by or [])).agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(y & ~p).alias("fn"),
    )
    return _with_rates(agg)


def _score_counts(df: DataFrame, label: str, score: str, rows_per_bucket: int, n_buckets: int | None) -> DataFrame:
    """(score, positives, negatives, negatives below) per distinct score."""
    y = F.col(label) == 1
    per_score = df.groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.count_if(y).cast("long").alias("_pos"), F.count_if(~y).cast("long").alias("_neg")
    )
    return running_sums(per_score, "_s", ["_neg"], rows_per_bucket=rows_per_bucket, n_buckets=n_buckets, exclusive=True)


def _auc_expr() -> Column:
    num = F.sum(F.col("_pos").cast("double") * (F.col("cum__neg").cast("double") + F.col("_neg").cast("double") / 2))
    pn = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return F.when(pn == 0, F.lit(None).cast("double")).otherwise(num / pn)


def roc_auc(
    df: DataFrame,
    label: str = S.LABEL,
    score: str = "failure_probability",
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    n_buckets: int | None = None,
) -> DataFrame:
    """Exact area under the ROC curve (Mann-Whitney, ties count one half).

    Rows are grouped by distinct score (partial aggregation), negatives below
    each score come from a two-level running sum over the distinct scores,
    and one final aggregate gives sum(pos x (neg_below + neg / 2)) / (P x N).
    NULL when one class is absent."""
    return _score_counts(df, label, score, rows_per_bucket, n_buckets).agg(_auc_expr().alias("auc"))


def evaluate_scores(
    df: DataFrame,
    label: str = S.LABEL,
    score: str = "failure_probability",
    threshold: float = S.CLASS_THRESHOLD,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    n_buckets: int | None = None,
) -> DataFrame:
    """Class at p > threshold, then AUC + accuracy, precision, recall, F1, all
    from the per-score count table in one final aggregate."""
    cum = _score_counts(df, label, score, rows_per_bucket, n_buckets)
    above = F.col("_s") > threshold
    agg = cum.agg(
        _auc_expr().alias("auc"),
        F.sum(F.when(above, F.col("_pos")).otherwise(0)).cast("long").alias("tp"),
        F.sum(F.when(above, F.col("_neg")).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when(~above, F.col("_neg")).otherwise(0)).cast("long").alias("tn"),
        F.sum(F.when(~above, F.col("_pos")).otherwise(0)).cast("long").alias("fn"),
    )
    return _with_rates(agg)


def _with_rates(agg: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    out = agg.withColumns(
        {"accuracy": _ratio0(tp + tn, tp + fp + tn + fn), "precision": _ratio0(tp, tp + fp), "recall": _ratio0(tp, tp + fn)}
    )
    pr = F.col("precision") + F.col("recall")
    return out.withColumn("f1", F.when(pr == 0, F.lit(0.0)).otherwise(2 * F.col("precision") * F.col("recall") / pr))


# ---------------------------------------------------------------------------
# table aggregates
# ---------------------------------------------------------------------------
def failure_rate(df: DataFrame, label: str = S.LABEL, by: list[str] | None = None, with_total: bool = False) -> DataFrame:
    """Rows and label mean per group; ``with_total`` adds the whole table as
    group 'all' in the same pass (rollup)."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.avg(F.col(label).cast("double")).alias("failure_rate")]
    if not (with_total and by):
        return df.groupBy(*(by or [])).agg(*aggs)
    out = df.rollup(*by).agg(*aggs, F.grouping_id().alias("_gid"))
    return out.withColumns({c: F.when(F.col("_gid") > 0, F.lit("all")).otherwise(F.col(c)) for c in by}).drop("_gid")


def class_counts(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    y = F.col(label) == 1
    return df.agg(F.count_if(~y).cast("long").alias("n_neg"), F.count_if(y).cast("long").alias("n_pos"))


def class_balance(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """negatives / positives (the boosted model's positive weight)."""
    c = class_counts(df, label)
    return c.withColumn(
        "neg_per_pos", F.when(F.col("n_pos") == 0, F.lit(None).cast("double")).otherwise(F.col("n_neg") / F.col("n_pos"))
    )


def balanced_weights(df: DataFrame, label: str = S.LABEL, out: str = "weight") -> DataFrame:
    """weight = n / (2 x n_class) per row ('balanced' class weights). The two
    class counts come from one aggregate (two scalars)."""
    row = class_counts(df, label).first()
    n_neg, n_pos = int(row["n_neg"]), int(row["n_pos"])
    n = n_neg + n_pos
    w_pos = n / (2.0 * n_pos) if n_pos else 0.0
    w_neg = n / (2.0 * n_neg) if n_neg else 0.0
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(w_pos)).otherwise(F.lit(w_neg)))


def column_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long form (column, n, mean, std_pop, std_samp): one pass for all
    columns, then unpivoted."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__sdp"), F.stddev_samp(x).alias(f"{c}__sds")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__n`, `{c}__mean`, `{c}__sdp`, `{c}__sds`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column, n, mean, std_pop, std_samp)")
