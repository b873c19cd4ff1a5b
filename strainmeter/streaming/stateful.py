"""Stateful stream operators with ``applyInPandasWithState``, in event time.

Rows are held per host until ``late_bound`` (10 minutes) of event time has
passed, by the watermark or by the host's own rows, then processed in (ts, key)
order: deliveries shuffled within the bound give the batch operators' rows
exactly. A row that comes after its host's
later rows were processed is late: it is marked ``is_late`` and changes no
other row.

The engine's watermark trails by ``grace`` (a day), not by the bound: rows late
by up to that still reach the operator, which sends them to the side table
(``sources.run_to_tables``); only rows beyond it are dropped by the engine,
which counts them in the query progress. The processing mark is the watermark
plus grace minus bound. Event-time timers release rows of hosts that get no
more data, and remove the state of a host that was silent for ``idle``.

The state of a host is bounded: the rows of the last ``late_bound``, the last
rows a row frame or lag needs (4), the last non-null value of each
forward-filled column, or the open island of an alert. So is a worker's memory,
however many rows of a host one micro-batch brings (``_Sorted``).
"""

from __future__ import annotations

import json
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strainmeter import schema as S
from strainmeter.functions import exprs as X
from strainmeter.operators.clean import nan_to_null
from strainmeter.operators.features import row_local_features
from strainmeter.session import ship_package
from strainmeter.streaming.sources import read_batches, run_to_tables

ORDER_STATE = T.StructType(
    [
        T.StructField("held", T.BinaryType()),  # rows not yet due, as an Arrow stream
        T.StructField("inner", T.StringType()),  # the operator's own state, JSON
        T.StructField("at", T.StringType()),  # last processed (ts, key)
        T.StructField("key", T.LongType()),
        T.StructField("seen", T.LongType()),  # latest event time, ms
    ]
)
EVENT_TIME = "_event_time"
GRACE = "1 day"
IDLE = "7 days"


def milliseconds(interval: str) -> int:
    return int(pd.Timedelta(interval) // pd.Timedelta(milliseconds=1))


def _to_py(v):
    if v is None or (isinstance(v, float) and np.isnan(v)):
        return None
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.floating,)):
        return float(v)
    if isinstance(v, (pd.Timestamp, np.datetime64)):
        return pd.Timestamp(v).isoformat()
    return v


def _late(pdf: pd.DataFrame, at: str | None, key: int | None) -> pd.Series:
    """Rows not after the last row processed, (``at``, ``key``)."""
    if at is None:
        return pd.Series(False, index=pdf.index)
    seen = pd.Timestamp(at)
    before = pdf[S.KEY] <= key if key is not None else pd.Series(True, index=pdf.index)  # a null key is the last
    return (pdf[S.TS] < seen) | ((pdf[S.TS] == seen) & before)


def _ms(ts: pd.Series) -> pd.Series:
    return ts.astype("datetime64[us]").astype("int64") // 1000


#: Rows of a host that are sorted at once, and rows read at a time of those put aside.
RUN_ROWS, BLOCK_ROWS = 100_000, 2_000


class _Sorted:
    """Rows of one host, given frame by frame, in (ts, key) order (nulls last,
    equal ones as given). Up to ``RUN_ROWS`` rows are sorted as they are; more
    are put aside in sorted temporary files and read again block by block."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema = schema
        self.frames: list[pd.DataFrame] = []
        self.n = 0
        self.files: list = []

    def _taken(self) -> pd.DataFrame:
        rows = pd.concat(self.frames, ignore_index=True) if self.frames else pd.DataFrame(columns=self.schema.names)
        self.frames, self.n = [], 0
        return rows.sort_values([S.TS, S.KEY], kind="mergesort").reset_index(drop=True)

    def _put_aside(self) -> None:
        file = tempfile.TemporaryFile()
        with pa.ipc.new_stream(file, self.schema) as w:
            w.write_table(pa.Table.from_pandas(self._taken(), schema=self.schema, preserve_index=False), max_chunksize=BLOCK_ROWS)
        file.seek(0)
        self.files.append(file)

    def add(self, rows: pd.DataFrame) -> None:
        if self.n and self.n + len(rows) > RUN_ROWS:
            self._put_aside()
        if len(rows):
            self.frames.append(rows)
            self.n += len(rows)

    def read(self) -> Iterator[pd.DataFrame]:
        if not self.files:
            if self.n:
                yield self._taken()
            return
        self._put_aside()
        unread = {i: iter(pa.ipc.open_stream(f)) for i, f in enumerate(self.files)}
        blocks: dict[int, pd.DataFrame] = {}
        ready, n = [], 0
        while unread or blocks:
            for i in list(unread):
                if i not in blocks:
                    block = next(unread[i], None)
                    if block is None:
                        del unread[i]
                    else:
                        blocks[i] = block.to_pandas().assign(_file=i)
            if not blocks:
                break
            # rows up to the first of the blocks' ends are complete: what isn't
            # read yet comes after its own block's end
            order = [S.TS, S.KEY, "_file"]
            end = pd.concat([x[order].iloc[-1:] for x in blocks.values()], ignore_index=True).sort_values(order).iloc[0]
            near = [i for i, x in blocks.items() if pd.isna(end[S.TS]) or x[S.TS].iloc[0] <= end[S.TS]]
            rows = pd.concat([blocks[i].assign(_end=np.arange(len(blocks[i])) == len(blocks[i]) - 1) for i in near], ignore_index=True)
            rows["_end"] &= rows["_file"] == end["_file"]
            rows = rows.sort_values(order).reset_index(drop=True)
            cut = int(rows["_end"].to_numpy().argmax()) + 1
            left = rows.iloc[cut:].drop(columns="_end")
            for i in near:
                blocks[i] = left[left["_file"] == i]
                if not len(blocks[i]):
                    del blocks[i]
            ready.append(rows.iloc[:cut].drop(columns=["_file", "_end"]))
            n += cut
            if n >= RUN_ROWS // 2:
                yield from self._parts(ready)
                ready, n = [], 0
        if n:
            yield from self._parts(ready)

    @staticmethod
    def _parts(ready: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(ready, ignore_index=True)
        for a in range(0, len(rows), RUN_ROWS):
            yield rows.iloc[a : a + RUN_ROWS].reset_index(drop=True)


def _in_event_time(process: Callable, late_rows: Callable, schema: T.StructType, late_bound: str, grace: str, idle: str):
    """State function that gives ``process(key, rows, inner)`` each host's
    rows in (ts, key) order once they are due; it returns (output rows, new
    inner state). ``late_rows(rows)`` makes the output of late rows."""
    bound, slack, silent = (milliseconds(x) for x in (late_bound, grace, idle))
    if slack < bound:
        raise ValueError("the grace must not be shorter than the late bound")
    arrow = to_arrow_schema(schema)
    columns = [f.name for f in schema.fields]

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, inner, at, last_key, seen = state.get if state.exists else (None, None, None, None, None)
        watermark = state.getCurrentWatermarkMs()
        mark = watermark + slack - bound if watermark > 0 else None
        order = _Sorted(arrow)
        if held is not None:
            with pa.ipc.open_stream(held) as r:
                order.add(r.read_pandas())
        for rows in [] if state.hasTimedOut else pdfs:
            rows = rows[columns]
            if len(rows):
                seen = max(seen or 0, int(_ms(rows[S.TS]).max()))
                late = _late(rows, at, last_key)
                if late.any():
                    yield late_rows(rows[late])
                order.add(rows[~late])
        # what the host's own rows have left behind is due too
        passed = [m for m in (seen - bound if seen else None, mark) if m is not None]
        limit = max(passed, default=-(1 << 63))
        kept = []
        for rows in order.read():
            due = (_ms(rows[S.TS]) <= limit) & (rows[S.TS].notna() | (mark is not None))
            ready = rows[due].reset_index(drop=True)
            if not due.all():
                kept.append(rows[~due])
            if len(ready):
                out, new_inner = process(key, ready, json.loads(inner) if inner else None)
                inner = json.dumps(new_inner)
                at, last_key = ready[S.TS].iloc[-1].isoformat(), _to_py(ready[S.KEY].iloc[-1])
                last_key = int(last_key) if last_key is not None else None
                yield out
        rows = pd.concat(kept, ignore_index=True) if kept else pd.DataFrame(columns=columns)
        if len(rows):
            sink = pa.BufferOutputStream()
            table = pa.Table.from_pandas(rows, schema=arrow, preserve_index=False)
            with pa.ipc.new_stream(sink, table.schema) as w:
                w.write_table(table)
            held = sink.getvalue().to_pybytes()
            timer = int(_ms(rows[S.TS]).min()) + bound - slack - 1
        else:
            held = None
            timer = (seen or 0) + silent - slack
            if state.hasTimedOut and timer < watermark:
                state.remove()
                return
        state.update((held, inner, at, last_key, seen))
        state.setTimeoutTimestamp(max(timer, watermark, 1))

    return fn


def _by_host(rows: DataFrame, process: Callable, late_rows: Callable, out: T.StructType, late_bound: str, grace: str, idle: str) -> DataFrame:
    ship_package(rows.sparkSession)  # before the function is made: it carries the file list
    fn = _in_event_time(process, late_rows, rows.schema, late_bound, grace, idle)
    timed = rows.withColumn(EVENT_TIME, F.expr(X.ntz_to_instant_sql(S.TS))).withWatermark(EVENT_TIME, grace)
    return timed.groupBy(S.HOST).applyInPandasWithState(fn, out, ORDER_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def _history_fn(spec_rolling, spec_lags, lag_fill, ffill_cols, src_cols, out_cols, lookback):
    def process(key, pdf: pd.DataFrame, inner: dict | None) -> tuple[pd.DataFrame, dict]:
        tail = pd.DataFrame(inner["tail"] if inner else [], columns=src_cols)
        last: dict = inner["last"] if inner else {}
        out = pdf.assign(is_late=False)
        n_tail = len(tail)
        hist = pd.concat([tail, pdf[src_cols]], ignore_index=True) if n_tail else pdf[src_cols].copy()
        for name, src, how, n in spec_rolling:
            s = pd.to_numeric(hist[src], errors="coerce").astype("float64")
            r = s.rolling(window=n, min_periods=1)
            val = (r.mean() if how == "mean" else r.max()).iloc[n_tail:].reset_index(drop=True)
            # forward fill of an all-NULL frame: the last value seen
            seen = s.ffill()
            if src in last and last[src] is not None:
                seen = seen.fillna(float(last[src]))
            out[name] = val.fillna(seen.iloc[n_tail:].reset_index(drop=True))
        for name, src, n in spec_lags:
            s = pd.to_numeric(hist[src], errors="coerce").astype("float64")
            val = s.shift(n).iloc[n_tail:].reset_index(drop=True)
            fill = lag_fill.get(src)
            out[name] = val.fillna(fill) if fill is not None else val
        new_last = dict(last)
        for c in ffill_cols:
            col = out[c]
            if c in last and last[c] is not None and col.isna().any():
                first = last[c]
                if pd.api.types.is_datetime64_any_dtype(col):
                    first = pd.Timestamp(first)
                col = pd.concat([pd.Series([first]), col], ignore_index=True).ffill().iloc[1:].reset_index(drop=True)
            else:
                col = col.ffill()
            out[c] = col
            nn = pdf[c].dropna()
            if len(nn):
                new_last[c] = _to_py(nn.iloc[-1])
        for _, src, _, _ in spec_rolling:
            nn = hist[src].dropna()
            if len(nn):
                new_last[src] = _to_py(nn.iloc[-1])
        keep_tail = hist.iloc[-lookback:] if lookback else hist.iloc[0:0]
        return out[out_cols], {"tail": [[_to_py(v) for v in row] for row in keep_tail.itertuples(index=False, name=None)], "last": new_last}

    def late_rows(pdf: pd.DataFrame) -> pd.DataFrame:
        """Late rows with their own values as history."""
        own = pdf.assign(is_late=True)
        for name, src, *_ in [*spec_rolling, *spec_lags]:
            own[name] = pd.to_numeric(own[src], errors="coerce").astype("float64")
        return own[out_cols]

    return process, late_rows


def stream_history_features(
    metrics: DataFrame,
    lag_fill: dict[str, float | None],
    keep: list[str] | None = None,
    late_bound: str = S.LATE_BOUND,
    grace: str = GRACE,
    idle: str = IDLE,
) -> DataFrame:
    """The feature table's rows over a stream of metric rows, keyed by host:
    ``keep`` columns, 48 features and ``is_late``. A row comes out once
    ``late_bound`` of event time has passed after it."""
    keep = keep or [S.KEY, S.HOST]
    local = row_local_features(nan_to_null(metrics, [c for c, t in metrics.dtypes if t in ("double", "float")]))
    rolling, lags = S.rolling_names(), S.lag_names()
    never = set(S.STRESS_COLS) | set(keep) | {S.LABEL, S.TS}
    ffill_cols = [c for c in local.columns if c not in never]
    src_cols = [S.TS, S.KEY] + sorted({s for _, s, _, _ in rolling} | {s for _, s, _ in lags})
    lookback = max([n - 1 for *_, n in rolling] + [n for *_, n in lags])
    in_fields = {f.name: f for f in local.schema.fields}
    out_fields = [in_fields[c] for c in local.columns] + [T.StructField(n, T.DoubleType()) for n in S.ROLLING_COLS_OUT + S.LAG_COLS_OUT]
    out_fields.append(T.StructField("is_late", T.BooleanType()))
    process, late_rows = _history_fn(rolling, lags, lag_fill, ffill_cols, src_cols, [f.name for f in out_fields], lookback)
    res = _by_host(local, process, late_rows, T.StructType(out_fields), late_bound, grace, idle)
    filled = res.fillna(0, subset=[c for c in S.FEATURE_COLS if c != S.TS])
    return filled.select(*keep, *S.FEATURE_COLS, "is_late")


def _alert_fn(above: float, for_seconds: int):
    span = pd.Timedelta(seconds=for_seconds)
    columns = [S.HOST, "island_start", "fired_at"]

    def process(key, pdf: pd.DataFrame, inner: dict | None) -> tuple[pd.DataFrame, dict]:
        hot_prev, start, fired = (inner["hot"], inner["start"], inner["fired"]) if inner else (False, None, False)
        hot = (pdf["failure_probability"] > above).to_numpy(bool)
        before = np.concatenate([[bool(hot_prev)], hot[:-1]])
        # island 0 is the open one of the state, if any
        island = np.cumsum(hot & ~before)
        starts = pdf[S.TS].where(hot & ~before)
        if start is not None:
            starts = starts.mask(island == 0, pd.Timestamp(start))
        starts = starts.ffill()
        due = hot & (pdf[S.TS] >= starts + span).to_numpy(bool)
        if fired:
            due &= island > 0
        alerts = pd.DataFrame({S.HOST: key[0], "island_start": starts, "fired_at": pdf[S.TS]})[due]
        alerts = alerts[~pd.Series(island[due], index=alerts.index).duplicated()]
        open_island = bool(hot[-1])
        return alerts[columns], {
            "hot": open_island,
            "start": starts.iloc[-1].isoformat() if open_island else None,
            "fired": open_island and bool((due & (island == island[-1])).any() or (fired and island[-1] == 0)),
        }

    def late_rows(pdf: pd.DataFrame) -> pd.DataFrame:
        """Late rows open or close no island."""
        return pd.DataFrame({c: pdf[S.TS if c != S.HOST else S.HOST] for c in columns}).iloc[0:0]

    return process, late_rows


def stream_sustained_alert(
    scored: DataFrame,
    above: float = S.ALERT_ABOVE,
    for_seconds: int = S.ALERT_FOR_SECONDS,
    late_bound: str = S.LATE_BOUND,
    grace: str = GRACE,
    idle: str = IDLE,
) -> DataFrame:
    """Alert rows (host, island start, firing time) once a host's probability
    has stayed above the bound for ``for_seconds`` and ``late_bound`` has
    passed after the firing row."""
    schema = T.StructType(
        [
            T.StructField(S.HOST, T.LongType()),
            T.StructField("island_start", T.TimestampNTZType()),
            T.StructField("fired_at", T.TimestampNTZType()),
        ]
    )
    src = scored.select(S.HOST, S.TS, S.KEY, "failure_probability")
    return _by_host(src, *_alert_fn(above, for_seconds), schema, late_bound, grace, idle)


def stream_rollup(
    events: DataFrame, late_bound: str = S.LATE_BOUND, window: str = S.ROLLUP_WINDOW, n_hosts: int = 16, approx_distinct: bool = False
) -> DataFrame:
    """5-minute roll-up per host on a stream: rows later than ``late_bound``
    behind the watermark are dropped (counted in the query progress);
    windows are emitted once closed (append).

    Distinct users are exact by default: a first windowed aggregation per
    (host, window, user), chained into the per-window one (streams reject
    COUNT DISTINCT); ``approx_distinct`` uses one HyperLogLog aggregation."""
    e = events.withColumn("event_time", F.expr(X.ntz_to_instant_sql("ts"))).withColumn(S.HOST, F.col("user_id") % n_hosts)
    e = e.withWatermark("event_time", late_bound)
    if approx_distinct:
        agg = e.groupBy(S.HOST, F.window("event_time", window).alias("w")).agg(
            F.count(F.lit(1)).alias("n_events"),
            F.count_if(F.col("event_type") == "error").alias("n_errors"),
            F.avg("value").alias("mean_value"),
            F.max("value").alias("max_value"),
            F.approx_count_distinct("user_id").alias("n_users"),
        )
    else:
        per_user = e.groupBy(S.HOST, F.window("event_time", window).alias("w0"), "user_id").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("event_type") == "error").alias("ne"),
            F.sum("value").alias("sv"),
            F.max("value").alias("mv"),
        )
        agg = per_user.groupBy(S.HOST, F.window(F.window_time("w0"), window).alias("w")).agg(
            F.sum("n").alias("n_events"),
            F.sum("ne").alias("n_errors"),
            (F.sum("sv") / F.sum("n")).alias("mean_value"),
            F.max("mv").alias("max_value"),
            F.count(F.lit(1)).alias("n_users"),
        )
    return agg.select(
        S.HOST,
        F.expr(X.instant_to_ntz_sql("w.start")).alias("window_start"),
        F.expr(X.instant_to_ntz_sql("w.end")).alias("window_end"),
        "n_events",
        "n_errors",
        "mean_value",
        "max_value",
        "n_users",
    )


def stream_score_readings(metrics: DataFrame, model, model_name: str, manifest: list[str], as_of=None) -> DataFrame:
    """Stateless scoring of a reading stream: the batch scoring plan as is;
    rejected readings come with their violations."""
    from strainmeter.plans.score import score_batch, with_rejected

    readings = metrics.select(F.col(S.KEY).alias("reading_id"), S.HOST, S.TS, *S.METRIC_COLS, "hour", "day_of_week")
    preds, bad = score_batch(readings, model, model_name, manifest=manifest, as_of=as_of)
    return with_rejected(preds, bad).withColumn("recommendations", X.recommendation_texts("recommendation_codes"))


def score_tables(scored: DataFrame, base: str) -> dict[str, str]:
    """Run a stream of ``stream_score_readings`` into the tables
    ``predictions`` and ``quarantine`` (rejected readings with their codes)
    under ``base``, each micro-batch exactly once."""
    given = ["failure_probability", "failure_risk", "confidence", "recommendations", "model_used", "timestamp", "recommendation_codes"]
    names = [c for c in scored.columns if c not in given and c != "violations"]
    return run_to_tables(
        scored,
        {
            "predictions": lambda b: b.filter(F.col("violations").isNull()).drop("violations"),
            "quarantine": lambda b: b.filter(F.col("violations").isNotNull()).select(*names, "violations"),
        },
        base,
    )


def late_apart(rows: DataFrame, base: str) -> dict[str, str]:
    """Run a stream with an ``is_late`` column into the tables ``rows`` and
    ``late`` (late rows with their own values as history) under ``base``."""
    return run_to_tables(
        rows, {"rows": lambda b: b.filter(~F.col("is_late")).drop("is_late"), "late": lambda b: b.filter("is_late").drop("is_late")}, base
    )


def late_counts(spark: SparkSession, late_path: str) -> DataFrame:
    """Late rows per host: count, first and last time."""
    return read_batches(spark, late_path).groupBy(S.HOST).agg(F.count(F.lit(1)).alias("n_late"), F.min(S.TS).alias("first_ts"), F.max(S.TS).alias("last_ts"))
