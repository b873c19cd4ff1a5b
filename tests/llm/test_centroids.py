import hashlib
import math

import duckdb
import numpy as np
import pytest

from strainmeter.llm import centroids

from .conftest import collected

COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def brute(rows, k=16, rounds=3, width=64):
    """The contract in plain Python over (id, vector)."""
    kept = [(i, [math.floor(64 * c) if abs(c) < 2**50 else 64 * int(c) for c in x]) for i, x in rows if x is not None and len(x) == width and all(c is not None and math.isfinite(c) for c in x)]
    starts = sorted((r for r in kept if r[0] is not None), key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [x for _, x in (starts + sorted((r for r in kept if r[0] is None), key=lambda r: r[1]))[:k]]

    def place():
        out = []
        for _, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centres]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = [c for c, _ in place()]
        for c in set(at):
            own = [x for (_, x), a in zip(kept, at) if a == c]
            centres[c] = [sum(col) // len(own) for col in zip(*own)]
    at = place()
    whole = sum(d for _, d in at)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    fits = lambda x: x if x < 2**63 else None
    return sorted([(i, c, fits(d), fits(sum(e for b, e in at if b == c)), fits(whole), sha[c]) for (i, _), (c, d) in zip(kept, at)], key=repr)


@pytest.mark.parametrize("scale", [1.0, 0.02, 1e7, 1e30])
def test_clusters_equal_brute_force(spark, scale):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(240, 64)) * np.geomspace(1, 0.02, 64) @ np.linalg.qr(rng.normal(size=(64, 64)))[0] + rng.integers(0, 6, (240, 1)) * 0.7
    x[:20] = x[20:40]
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(rng.permutation(240), (x * scale).astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    assert collected(centroids.clustered(df), *COLUMNS) == brute(rows)


def test_filter_measures_fewer_and_changes_nothing():
    rng = np.random.default_rng(2)
    v = np.floor(rng.normal(size=(500, 64)) * np.geomspace(90, 1, 64)).astype(np.int64)
    mean, directions = centroids.rotation(v.sum(axis=0), v.T @ v, len(v))
    centres = v[:16]
    cluster, best, measured = centroids.nearest(v, *centroids.rotated(v, mean, directions), centres, *centroids.rotated(centres, mean, directions))
    d = ((v[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (cluster == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert measured < 0.3 * d.size


def test_limbs_add_up_at_any_size():
    values = np.array([[0, -1, 2**27, -(2**40)], [2**40, -(2**41) - 5, 3 * 2**100 + 7, -(2**99) - 1]], object)
    total = sum(part.astype(object) * centroids.LIMB**place for place, part in centroids._limbs(values))
    assert (total == values).all()


def test_odd_vectors(spark):
    unit = [1.0] + [0.0] * 63
    rows = [(1, unit), (1, unit), (1, [-c for c in unit]), (2, None), (3, []), (4, unit[:63]), (5, [float("nan")] * 64), (6, [None] + unit[1:]), (7, [float("inf")] + unit[1:]), (None, [0.5] * 64), (None, [0.25] * 64), (9, [3e38] * 64), (10, [-1e-20] * 64)]
    df = spark.createDataFrame([(i, x, "a", 1) for i, x in rows], "vec_id long, embedding array<float>, cluster string, id int")
    assert collected(centroids.clustered(df), *COLUMNS) == brute([(i, None if x is None else [None if c is None else float(np.float32(c)) for c in x]) for i, x in rows])
    wide = spark.createDataFrame([(1, [1.7e308] * 64), (2, [-1.7e308] * 64)], "vec_id long, embedding array<double>")
    assert [(r.cluster, r.distance) for r in centroids.clustered(wide).orderBy("vec_id").collect()] in ([(0, 0), (1, 0)], [(1, 0), (0, 0)])
    assert centroids.clustered(df.limit(0)).collect() == []
    assert centroids.clustered(df.where("embedding is null")).collect() == []


def test_sql_gives_the_same_rows(spark):
    path = "/root/testdata/sf0.001/embeddings.parquet"
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from read_parquet('{path}')")
    got = collected(centroids.clustered(spark.read.parquet(path)), *COLUMNS)
    assert got and got == sorted(con.sql(centroids.SQL).fetchall(), key=repr)
