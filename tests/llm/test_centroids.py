"""Centroid clustering against plain Lloyd rounds in integers."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import clash
from tresoria.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, clusters, rounds, dims):
    kept = []
    for vec_id, e in rows:
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e):
            v = tuple(math.floor(float(np.float32(x)) * 256) for x in e)
            kept.append((hashlib.sha256(f"2:{'' if vec_id is None else vec_id}".encode()).hexdigest(), v, vec_id))
    cent = [v for _, v, _ in sorted(kept, key=lambda x: x[:2])[:clusters]]

    def own(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cent]
        return min(far), far.index(min(far))

    for _ in range(rounds):
        to = [own(v)[1] for _, v, _ in kept]
        for k in range(len(cent)):
            mine = [v for (_, v, _), o in zip(kept, to) if o == k]
            if mine:
                cent[k] = tuple(sum(x) // len(mine) for x in zip(*mine))
    last = [(i, *own(v)) for _, v, i in kept]
    inertia = {k: sum(f for _, f, o in last if o == k) for k in range(len(cent))}
    return sorted(((i, k, far, inertia[k], sum(inertia.values()), hashlib.sha256(",".join(map(str, cent[k])).encode()).hexdigest())
                   for i, far, k in last), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def some(n, dims, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0, spread, dims)]) for i in range(n)]


def odd():
    ok = [0.25, -0.5, 1.0, 0.0]
    return [*some(60, 4), (100, None), (101, []), (102, ok[:3]), (103, [*ok, 1.0]), (104, [None, *ok[1:]]), (105, [float("nan"), *ok[1:]]),
            (106, [float("inf"), *ok[1:]]), (None, ok), (None, ok), (7, ok), (7, ok), (7, [-x for x in ok]), (107, [3e4, -3e4, 0.0, 1e-9])]


@pytest.mark.parametrize("bits", [1, 6, 8])
def test_equals_plain_rounds(spark, bits):
    rows = odd()
    df = spark.createDataFrame([(i, e, 0) for i, e in rows], SCHEMA).repartition(3)
    got = C.cluster(df, clusters=7, rounds=4, dims=4, bits=bits)
    assert rows_of(got) == brute(rows, 7, 4, 4)


def test_ties_go_to_the_smaller_number(spark):
    # integers 0 and 2 are equally far from 1; equal vectors share the smallest number
    rows = [(i, [x / 256]) for i, x in enumerate([0, 2, 1, 1, 1, 0, 2, 4, 3, 3])]
    df = spark.createDataFrame([(i, e, 0) for i, e in rows], SCHEMA)
    for rounds in (0, 1, 5):
        assert rows_of(C.cluster(df, clusters=5, rounds=rounds, dims=1)) == brute(rows, 5, rounds, 1)


def test_fewer_vectors_than_centroids_and_empty_tables(spark):
    rows = some(3, 4)
    df = spark.createDataFrame([(i, e, 0) for i, e in rows], SCHEMA)
    assert rows_of(C.cluster(df, dims=4)) == brute(rows, 40, 5, 4)
    none = C.cluster(df.limit(0), dims=4)
    assert none.collect() == [] and none.columns == C.cluster(df, dims=4).columns
    assert C.cluster(df, dims=5).collect() == []


def test_clashing_columns(spark):
    rows = some(30, 4)
    df = spark.createDataFrame([(i, e, 0) for i, e in rows], SCHEMA)
    wide = clash(df).withColumns({c: F.lit("x") for c in ("v", "x", "cells", "full", "cluster", "distance", "h", "at")})
    assert rows_of(C.cluster(wide, clusters=5, dims=4)) == brute(rows, 5, 5, 4)


def test_components_out_of_range_end_the_job(spark):
    df = spark.createDataFrame([(0, [1e30], 0), (1, [0.0], 0)], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        C.cluster(df, dims=1).collect()


def _cells(v, bits):
    inner = [np.unique(np.linspace(v[:, d].min() + 1, v[:, d].max(), (1 << bits) - 1).astype(np.int64)) for d in range(v.shape[1])]
    least, most = (np.zeros((v.shape[1], 1 << bits), dtype=np.int64) for _ in range(2))
    for d, q in enumerate(inner):
        k = len(q)
        least[d, 0], least[d, 1:k + 1], most[d, :k], most[d, k] = v[:, d].min(), q, q - 1, v[:, d].max()
    return C.Cells(bits, inner, least, most)


def test_intervals_hold_the_distance_and_decide_where_groups_are_apart():
    rng = np.random.default_rng(3)
    centroids = rng.integers(-3000, 3000, (6, 16))
    v = centroids[rng.integers(0, 6, 500)] + rng.integers(-20, 20, (500, 16))
    full = pa.array([r.astype("<i4").tobytes() for r in v], pa.binary())
    for bits in (2, 5, 8):
        cells = _cells(v, bits)
        packed = cells.pack(v)
        assert packed.shape == (500, -(-16 * bits // 8))
        own = cells.unpack(packed)
        look = C.Lookup(cells, centroids)
        far = ((v[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        low = sum(look.low[d][own[:, d]] for d in range(16))
        high = sum(look.high[d][own[:, d]] for d in range(16))
        assert (low <= far).all() and (far <= high).all()
        got, fetched = look.nearest(own, full)
        assert (got == far.argmin(axis=1)).all()
        assert bits < 5 or fetched == 0  # no full vector is read where the cells decide
