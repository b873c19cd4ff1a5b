"""Streaming queries: each runs a Structured Streaming query over the given
``events`` table (``availableNow``) into a table in the shared folder and
returns that table. The twins are those of the batch forms."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strainmeter import oracle_sql as O
from strainmeter import schema as S
from strainmeter.fixtures import fixture_model, fixture_score, invalid_fixture
from strainmeter.operators.windows import column_means
from strainmeter.plans.catalog import ORACLES as SQL
from strainmeter.plans.catalog import q_monitor, q_scoring, register  # noqa: F401  (they register the batch twins)
from strainmeter.plans.checks import rounded
from strainmeter.session import shared_path
from strainmeter.sources.io import events_metrics
from strainmeter.streaming import stateful as ST
from strainmeter.streaming.sources import metrics_stream, read_batches, run_to_table, table_stream

AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)


def _both_sides_sql() -> str:
    preds, envelope = SQL["score_batch"], SQL["batch_envelope"]
    return (
        "SELECT event_id, failure_probability, failure_risk, confidence, recommendation_codes, model_used, timestamp, '' AS violations"
        f" FROM ({preds})\nUNION ALL BY NAME SELECT event_id, violations FROM ({envelope}) WHERE violations <> ''"
    )


@register("stream_score", _both_sides_sql())
def q_stream_score(spark, sf_dir):
    """Readings scored as they arrive (stateless, point features, fixture
    model) into a predictions and a quarantine table, each micro-batch once."""
    stream = invalid_fixture(metrics_stream(table_stream(spark, sf_dir, "events")))
    preds = ST.stream_score_readings(stream, fixture_model(), "fixture", S.MODEL_INPUTS, as_of=AS_OF)
    tables = ST.score_tables(preds, shared_path(spark, "stream-score"))
    both = [read_batches(spark, tables[t]).withColumnRenamed("reading_id", S.KEY) for t in ("predictions", "quarantine")]
    cols = [S.KEY, "failure_probability", "failure_risk", "confidence", "recommendation_codes", "model_used", "timestamp", "violations"]
    out = both[0].unionByName(both[1], allowMissingColumns=True).select(*cols)
    return out.withColumns({"recommendation_codes": F.array_join("recommendation_codes", ","), "violations": F.coalesce(F.array_join("violations", ","), F.lit(""))})


@register("stream_rollup", f"SELECT * FROM ({SQL['sample_rollup']}) WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'")
def q_stream_rollup(spark, sf_dir):
    """5-minute roll-up per host with a 10-minute watermark; closed windows."""
    out = ST.stream_rollup(table_stream(spark, sf_dir, "events"))
    return rounded(spark.read.parquet(run_to_table(out, "rollup")))


#: Rows whose late bound has passed (in milliseconds, as watermarks are).
DUE_SQL = "date_trunc('milliseconds', ts) <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL '10 minutes'"


@register("stream_history_features", f"SELECT * FROM ({O.feature_sql()}) WHERE {DUE_SQL}")
def q_stream_history_features(spark, sf_dir):
    """True rolling / lag / forward-filled features on a stream (keyed state
    per host, event-time order); lag gaps take the table means, as the batch
    form. Rows of the last 10 minutes are still held."""
    fill = column_means(events_metrics(spark, sf_dir), S.LAG_COLS)
    out = ST.stream_history_features(metrics_stream(table_stream(spark, sf_dir, "events")), fill)
    tables = ST.late_apart(out, shared_path(spark, "stream-history"))
    return rounded(read_batches(spark, tables["rows"]))


@register("stream_sustained_alert", f"SELECT host_id, island_start, fired_at FROM ({SQL['sustained_alert']}) WHERE {DUE_SQL.replace('ts)', 'fired_at)', 1)}")
def q_stream_sustained_alert(spark, sf_dir):
    """Alerts fired when the fixture score stays above 0.8 for 5 minutes."""
    scored = fixture_score(metrics_stream(table_stream(spark, sf_dir, "events")))
    return spark.read.parquet(run_to_table(ST.stream_sustained_alert(scored), "alert"))
