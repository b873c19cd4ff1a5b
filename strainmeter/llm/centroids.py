"""Integer k-means with a PCA-rotated filter.

Vectors become integers floor(64 x); all assignments, sums and centroids are
exact integers, so the result doesn't depend on partitions or retries.

Filter: the vectors' second moments, summed over all rows, give a rotation
whose leading directions hold most of the spread. Stored with each vector are
its ``LEADING`` rotated coordinates p and the norm r of the rest. For a
centroid with p', r' the squared distance is at least
|p - p'|^2 + (r - r')^2 (the rest's own distance is at least the difference of
its norms). The centroid of the least bound is measured in integers; only
centroids whose bound isn't above that distance are measured too, the others
can't win. A float margin keeps every centroid that rounding could hide, so
the filter saves work and never changes a result.

Each round reads the written vectors once: tasks return, for every centroid,
the sums of its vectors' components (K x width rows a task, whatever its
rows), which are added exactly as decimals; K centroids go to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainmeter.llm.tables import ship, written

WIDTH = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
LEADING = 16
SEED = "1"
#: Beyond this, squared distances of int64 could overflow: Python integers.
WIDE = 1 << 27
LIMB = 1 << 40
_LONG = (1 << 63) - 1


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE x) of finite doubles, exactly: int64, or Python integers if
    one of them is beyond ``WIDE``. (SCALE is a power of two, so the product
    is exact unless it overflows, hence the integer product for large x.)"""
    if not x.size or np.abs(x).max() * SCALE < WIDE:
        return np.floor(x * SCALE).astype(np.int64)
    whole = lambda v: int(v) * SCALE if abs(v) >= 2.0**53 else int(np.floor(v * SCALE))
    return np.array([whole(v) for v in x.ravel().tolist()], object).reshape(x.shape)


def rotation(total: np.ndarray, moments: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and orthonormal directions, widest spread first."""
    mean = total / max(n, 1)
    _, directions = np.linalg.eigh(moments / max(n, 1) - np.outer(mean, mean))
    return mean, np.ascontiguousarray(directions[:, ::-1])


def rotated(v: np.ndarray, mean: np.ndarray, directions: np.ndarray, leading: int = LEADING) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates and norm of the rest."""
    if v.dtype == object:  # not filtered, see nearest()
        return np.zeros((len(v), leading)), np.zeros(len(v))
    y = (v - mean) @ directions
    return y[:, :leading], np.sqrt((y[:, leading:] ** 2).sum(axis=1))


def nearest(v: np.ndarray, p: np.ndarray, r: np.ndarray, centres: np.ndarray, cp: np.ndarray, cr: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: the smaller number), exact squared distance,
    and how many distances were measured in integers. Blocks of wide integers
    are measured whole."""
    if v.dtype == object or centres.dtype == object:
        d = ((v.astype(object)[:, None, :] - centres.astype(object)[None, :, :]) ** 2).sum(axis=2)
        cluster = np.array([row.index(min(row)) for row in d.tolist()], np.int64)
        return cluster, d[np.arange(len(v)), cluster], d.size
    low = np.maximum(((p**2).sum(axis=1) + r**2)[:, None] + ((cp**2).sum(axis=1) + cr**2)[None, :] - 2 * (p @ cp.T + np.outer(r, cr)), 0.0)
    size = ((p**2).sum(axis=1) + r**2)[:, None] + ((cp**2).sum(axis=1) + cr**2)[None, :]
    first = low.argmin(axis=1)
    exact = lambda i, c: ((v[i] - centres[c]) ** 2).sum(axis=1)
    rows = np.arange(len(v))
    best = exact(rows, first) if len(v) else np.zeros(0, np.int64)
    cluster = first.copy()
    keep = low <= best.astype(np.float64)[:, None] * (1 + 1e-9) + size * 1e-9 + 1e-6
    keep[rows, first] = False
    measured = len(v) + int(keep.sum())
    for c in np.flatnonzero(keep.any(axis=0)).tolist():
        i = np.flatnonzero(keep[:, c])
        d = exact(i, np.full(len(i), c))
        won = (d < best[i]) | ((d == best[i]) & (c < cluster[i]))
        best[i[won]], cluster[i[won]] = d[won], c
    return cluster, best, measured


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _limbs(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Integers as sums of limb x LIMB^place, the limbs small enough to add."""
    place = 0
    while True:
        if values.dtype != object and (not values.size or np.abs(values).max() < LIMB):
            yield place, values.astype(np.int64)
            return
        values = values.astype(object)
        yield place, (values % LIMB).astype(np.int64)
        values, place = values // LIMB, place + 1
        if all(-LIMB < x < LIMB for x in values.ravel().tolist()):
            values = values.astype(np.int64)


def _moments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, moments = 0, np.zeros(width), np.zeros((width, width))
        for b in batches:
            with np.errstate(over="ignore", invalid="ignore"):  # seen by the caller
                v = np.floor(_matrix(b.column(0), width) * SCALE)
                moments += v.T @ v
            n, total = n + len(v), total + v.sum(axis=0)
        if n:
            cells = np.concatenate([[float(n)], total, moments.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells)), pa.int32()), pa.array(cells)], ["i", "x"])

    return run


class _Filter:
    """What a task needs to place vectors: rotation and centroids."""

    def __init__(self, mean: np.ndarray, directions: np.ndarray, centres: list[list[int]], leading: int) -> None:
        wide = any(abs(x) > WIDE for c in centres for x in c)
        self.centres = np.array(centres, object if wide else np.int64)
        self.cp, self.cr = rotated(self.centres, mean, directions, leading)
        self.width = len(mean)

    def __call__(self, b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        v = integers(_matrix(b.column("x"), self.width))
        cluster, best, _ = nearest(v, _matrix(b.column("p"), self.cp.shape[1]), b.column("r").to_numpy(), self.centres, self.cp, self.cr)
        return v, cluster, best


def _sums(place: _Filter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, width = place.centres.shape
        held: dict[int, np.ndarray] = {}
        count, added = np.zeros(k, np.int64), 0

        def out() -> pa.RecordBatch:
            parts = [(c, d, limb, s[c, d]) for limb, s in held.items() for c in range(k) if count[c] for d in range(width)]
            parts += [(c, -1, 0, count[c]) for c in range(k) if count[c]]
            columns = zip(*parts, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["c", "d", "limb", "s"])

        for b in batches:
            v, cluster, _ = place(b)
            for limb, part in _limbs(v):
                np.add.at(held.setdefault(limb, np.zeros((k, width), np.int64)), cluster, part)
            count += np.bincount(cluster, minlength=k)
            added += len(v)
            if added > 1 << 21:  # limbs below 2^40: sums stay below 2^62
                yield out()
                held, count, added = {}, np.zeros(k, np.int64), 0
        if added:
            yield out()

    return run


def _placed(place: _Filter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, cluster, best = place(b)
            fits = [d if d <= _LONG else None for d in best.tolist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(cluster, pa.int32()), pa.array(fits, pa.int64()), pa.array([str(d) if f is None else None for d, f in zip(best.tolist(), fits, strict=True)], pa.string())], ["id", "cluster", "distance", "far"])

    return run


def kept_vectors(table: DataFrame, id_col: str, vector_col: str, width: int = WIDTH) -> DataFrame:
    """(id, x) of the vectors with ``width`` components, all finite."""
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return table.select(F.col(id_col).alias("id"), x.alias("x")).where((F.size("x") == width) & ~bad)


def starts(kept: DataFrame, k: int = CENTROIDS, seed: str = SEED) -> list[list[int]]:
    """The k vectors with the smallest sha256 of "seed:id", in that order; ids
    that repeat: smaller components first; rows without an id come last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = kept.select("x", order.alias("h")).orderBy(F.col("h").asc_nulls_last(), "x").limit(k).collect()
    return [[int(i) for i in integers(np.array([r["x"]], float))[0].tolist()] for r in rows]


def refined(vectors: DataFrame, centres: list[list[int]], mean: np.ndarray, directions: np.ndarray, leading: int) -> list[list[int]]:
    """Centroids after one round: exact floor(sum / count); empty ones stay."""
    parts = vectors.mapInArrow(_sums(_Filter(mean, directions, centres, leading)), "c int, d int, limb int, s long")
    total: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("c", "d", "limb").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        total[r["c"], r["d"]] = total.get((r["c"], r["d"]), 0) + int(r["s"]) * LIMB ** r["limb"]
    return [[total[c, d] // total[c, -1] for d in range(len(old))] if (c, -1) in total else old for c, old in enumerate(centres)]


def clustered(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH, leading: int = LEADING, seed: str = SEED) -> DataFrame:
    """One row per kept row of ``table``: id, cluster, distance (squared),
    cluster_inertia, inertia and centroid_sha256.

    Rows whose vector is null, has another number of components, or a null or
    non-finite one, aren't in the result; an empty table gives an empty one.
    Repeated rows and ids are rows of their own, null ids too (they come last
    when starts are chosen). Fewer than k kept rows give as many centroids.
    Ties go to the smaller centroid. Sums and distances are exact at any size
    of the components; a distance or inertia beyond a long is null. Other
    columns aren't read."""
    spark = table.sparkSession
    ship(spark)
    kept = kept_vectors(table, id_col, vector_col, width)
    centres = starts(kept, k, seed)
    schema = f"{id_col} {dict(kept.dtypes)['id']}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centres:
        return spark.createDataFrame([], schema)
    cells = kept.select("x").mapInArrow(_moments(width), "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    flat = np.zeros(1 + width + width * width)
    for r in cells:
        flat[r["i"]] = r["x"]
    if not np.isfinite(flat).all():  # squares beyond doubles: any rotation is right, take none
        flat = np.concatenate([[1.0], np.zeros(width), np.eye(width).ravel()])
    mean, directions = rotation(flat[1 : 1 + width], flat[1 + width :].reshape(width, width), int(flat[0]))
    vectors = written(kept.mapInArrow(_rotated_rows(mean, directions, leading), f"id {dict(kept.dtypes)['id']}, x array<double>, p array<double>, r double"), "rotated")
    for _ in range(rounds):
        centres = refined(vectors, centres, mean, directions, leading)
    place = _Filter(mean, directions, centres, leading)
    out = written(vectors.mapInArrow(_placed(place), f"id {dict(kept.dtypes)['id']}, cluster int, distance long, far string"), "clusters")
    # at most k rows: sums over clusters, and over all
    far = F.coalesce(F.col("distance").cast("decimal(38,0)"), F.col("far").try_cast("decimal(38,0)"))
    known = F.count(far) == F.count(F.lit(1))
    sums = {r["cluster"]: int(r["s"]) if r["known"] and r["s"] is not None else None for r in out.groupBy("cluster").agg(F.sum(far).alias("s"), known.alias("known")).collect()}
    fits = lambda x: x if x is not None and x <= _LONG else None
    whole = fits(None if None in sums.values() else sum(sums.values()))
    rows = [(c, fits(s), whole, hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for c, s in sums.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(facts), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _rotated_rows(mean: np.ndarray, directions: np.ndarray, leading: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), len(mean))
            p, r = rotated(integers(x), mean, directions, leading)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * p.shape[1])
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("x"), pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(p).ravel())), pa.array(r)], ["id", "x", "p", "r"])

    return run


def _step_sql(i: int) -> str:
    """One assignment to the centroids of round i, as (vec_id, c, dist)."""
    return f"""a{i} AS (
  SELECT vec_id, c, dist FROM (
    SELECT v.vec_id, k.c, sum((v.x - k.x) * (v.x - k.x)) AS dist,
           row_number() OVER (PARTITION BY v.vec_id ORDER BY sum((v.x - k.x) * (v.x - k.x)), k.c) AS r
    FROM v JOIN c{i} AS k ON v.d = k.d GROUP BY v.vec_id, k.c) WHERE r = 1)"""


def _update_sql(i: int) -> str:
    return f"""c{i + 1} AS (
  SELECT k.c, k.d, coalesce(m.x, k.x) AS x FROM c{i} AS k LEFT JOIN (
    SELECT a.c, v.d, (sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) AS x
    FROM v JOIN a{i} AS a ON v.vec_id = a.vec_id GROUP BY a.c, v.d) AS m ON m.c = k.c AND m.d = k.d)"""


#: DuckDB SQL of the registered query (distinct vec_id, components of moderate size).
SQL = f"""WITH kept AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = {WIDTH} AND list_count(embedding) = {WIDTH}
    AND len(list_filter(embedding, lambda e: NOT isfinite(e))) = 0),
v AS (
  SELECT vec_id, d, CAST(floor({SCALE} * CAST(embedding[d] AS DOUBLE)) AS BIGINT) AS x
  FROM kept CROSS JOIN (SELECT unnest(range(1, {WIDTH + 1})) AS d) AS dims),
s AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || CAST(vec_id AS VARCHAR))) - 1 AS c
  FROM kept ORDER BY c LIMIT {CENTROIDS}),
c0 AS (SELECT s.c, v.d, v.x FROM s JOIN v ON s.vec_id = v.vec_id),
{", ".join(_step_sql(i) + ", " + _update_sql(i) for i in range(ROUNDS))}, {_step_sql(ROUNDS)},
h AS (SELECT c, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c)
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.dist AS BIGINT) AS distance,
       CAST(sum(a.dist) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.dist) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{ROUNDS} AS a JOIN h ON a.c = h.c"""
