"""Class balance by synthetic rows (SMOTE) over the seven metrics, with the
neighbours found by brute force in the second engine."""

from __future__ import annotations

from pyspark.sql import functions as F

from strainmeter import oracle_sql as O
from strainmeter import schema as S
from strainmeter.operators import oversample as OS
from strainmeter.plans.catalog import register
from strainmeter.plans.checks import rounded
from strainmeter.sources.io import events_metrics

#: Multipliers of the metrics in distances: one over a usual size of each.
SCALE = {
    "cpu_usage": 0.01,
    "memory_usage": 0.01,
    "disk_usage": 0.01,
    "network_latency_ms": 0.005,
    "error_count": 0.1,
    "response_time_ms": 0.0005,
    "active_connections": 0.01,
}


def _smote_sql() -> str:
    cols = S.METRIC_COLS
    dist = "CAST(0 AS DOUBLE)"
    for c in cols:
        d = f"(a.{c} * CAST({SCALE[c]!r} AS DOUBLE) - b.{c} * CAST({SCALE[c]!r} AS DOUBLE))"
        dist = f"({dist} + {d} * {d})"
    bits = lambda kind: f"CAST('0x' || substr({OS.draw('source', 'copy', kind, S.SPLIT_SEED)}, 1, {OS.UNIT_DIGITS}) AS BIGINT)"
    order = f"CAST('0x' || substr(md5('{S.SPLIT_SEED}:' || event_id), 1, {S.SPLIT_DIGITS}) AS BIGINT)"
    names = ", ".join(cols)
    return O.with_ctes(
        O.METRICS_CTE,
        "mi AS (SELECT event_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols) + f" FROM metrics WHERE {S.LABEL} = 1)",
        f"pt AS (SELECT min(event_id) AS point, {names} FROM mi GROUP BY {names})",
        f"nn AS (SELECT point, near, r FROM (SELECT a.point, b.point AS near, row_number() OVER (PARTITION BY a.point ORDER BY {dist}, b.point) AS r"
        f" FROM pt AS a JOIN pt AS b ON a.point <> b.point) WHERE r <= {OS.K})",
        "sz AS (SELECT point, count(*) AS n FROM nn GROUP BY point)",
        f"ct AS (SELECT count_if({S.LABEL} = 1) AS have, count_if({S.LABEL} <> 1) - count_if({S.LABEL} = 1) AS need FROM metrics)",
        f"rk AS (SELECT mi.event_id AS source, pt.point, row_number() OVER (ORDER BY {order}, mi.event_id) AS place FROM mi JOIN pt USING ({names}))",
        "cp AS (SELECT source, point, unnest(range(1, CAST(need // have + CASE WHEN place <= need % have THEN 1 ELSE 0 END AS BIGINT) + 1)) AS copy FROM rk, ct WHERE need > 0)",
        f"dr AS (SELECT cp.source, cp.copy, nn.near AS neighbour, {bits('u')} / CAST({16**OS.UNIT_DIGITS} AS DOUBLE) AS u"
        f" FROM cp JOIN sz USING (point) JOIN nn ON nn.point = cp.point AND nn.r = 1 + {bits('n')} % sz.n)",
    ) + (
        "\nSELECT dr.source, dr.neighbour, CAST(dr.copy AS INT) AS copy, "
        + O.r("dr.u")
        + " AS u, "
        + ", ".join(f"{O.r(f'x.{c} + dr.u * (y.{c} - x.{c})')} AS {c}" for c in cols)
        + f", 1 AS {S.LABEL}\nFROM dr JOIN mi AS x ON x.event_id = dr.source JOIN mi AS y ON y.event_id = dr.neighbour"
    )


@register("smote_oversample", _smote_sql())
def q_smote_oversample(spark, sf_dir):
    """Synthetic minority rows that level the classes: exact neighbours among
    all minority rows over the seven metrics."""
    made = OS.synthetic_rows(events_metrics(spark, sf_dir), S.METRIC_COLS, scale=SCALE)
    return rounded(made.withColumn("copy", F.col("copy").cast("int")))
