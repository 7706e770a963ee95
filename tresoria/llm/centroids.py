"""Centroid clustering over a vector-approximation file.

Lloyd's rounds in integers: every vector goes to its nearest centroid, every
centroid to the floor of its vectors' mean.  The VA-file holds for each vector a cell
of a few bits per dimension, and the full vector as packed bytes.  For a round, lookup
tables give the least and the greatest squared distance between each cell and each
centroid; a vector's sums over the dimensions bound its distance to every centroid.
Where one centroid's interval lies below all others the cells decide, and the packed
bytes stay unread; only where intervals overlap are they unpacked, and only the
centroids of those intervals are measured.

A round's sums follow from the round before: a task gives a vector its centroid under
the old and the new centroids, by cells where they decide, and unpacks it only if it
moved.  So a round is one scan of the file, with no state beside the centroids, and
one sum for each centroid and dimension from each task.

Spark reads rows, not single vectors of a Parquet file: the packed bytes come with the
cells in one scan.  A fetch by a join of row ids would shuffle all vectors in each
round.  What the intervals save is the unpacking and the measuring.

Scale: the input is read for the first centroids (a top-k), for the edges of the cells
(quantile sketches, one for each dimension) and for the file; then the file once a round.
Nothing is shuffled but sums and sketches; centroids and edges (``clusters`` and
``2 ** bits`` times the dimensions) are all that reaches the driver.

Defined results: a vector that is null, of another length, or with a null or
non-finite component is left out; a null id stays null and is hashed as the empty
text; repeated rows count each; ids with equal hashes start in order of their
components; equal distances go to the smaller number; fewer vectors than ``clusters`` give
that many centroids; an empty table gives no row; extra columns are ignored.
Components beyond ``LIMIT`` in size end the job with a message, since their squared
distances do not fit a long.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tresoria.session import materialize

CLUSTERS, ROUNDS, DIMS = 40, 5, 64
#: bits of a cell
BITS = 6
SCALE = 256
#: largest component after scaling: 64 squared differences of twice this fit a long
LIMIT = 1 << 27
#: rows measured at a time: bounds a task's memory
STEP = 2048


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(id, v) of the kept vectors; ``v`` holds floor(scale * x) of each component."""
    x = F.col(vec_col).cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    whole = lambda c: F.when(F.abs(c * scale) < LIMIT, F.floor(c * scale).cast("int")).when(
        finite(c), F.raise_error(F.lit(f"a component times {scale} is beyond {LIMIT}")).cast("int"))
    # a filter that Spark derives from a later explode may run before this one: no row left out may raise
    return vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).filter(
        (F.size("x") == dims) & F.forall("x", finite)).select(
            "id", F.when(F.size("x") == dims, F.transform("x", whole)).alias("v"))


def first_centroids(ints: DataFrame, clusters: int, salt: str) -> np.ndarray:
    """The vectors whose salted ids hash lowest, in ascending order of the hash."""
    h = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = ints.select(h.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


class Cells(NamedTuple):
    """Edges of the cells: cell j of dimension d holds the integers from ``least[d, j]`` to
    ``most[d, j]``; a component's cell is the number of ``inner`` edges at or below it."""

    bits: int
    inner: list[np.ndarray]
    least: np.ndarray
    most: np.ndarray

    @classmethod
    def fitted(cls, ints: DataFrame, dims: int, bits: int) -> Cells:
        """Cells of equal width between the outer thousandths of a dimension's components, from
        quantile sketches over all vectors; the first and the last cell reach to the extremes.  The
        edges only decide how tight the intervals are, never a result."""
        n = 1 << bits
        rows = ints.select(F.posexplode("v").alias("d", "c")).groupBy("d").agg(
            F.min("c").alias("lo"), F.max("c").alias("hi"), F.percentile_approx("c", [0.001, 0.999], 5000).alias("q")).collect()
        inner: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * dims
        least, most = np.zeros((dims, n), dtype=np.int64), np.zeros((dims, n), dtype=np.int64)
        for r in rows:
            first, last = r["q"]
            q = np.unique(first + (last - first + 1) * np.arange(1, n, dtype=np.int64) // n)
            q = q[(q > r["lo"]) & (q <= r["hi"])]
            d, k = r["d"], len(q)
            inner[d] = q
            least[d, 0], least[d, 1:k + 1], most[d, :k], most[d, k] = r["lo"], q, q - 1, r["hi"]
        return cls(bits, inner, least, most)

    def pack(self, v: np.ndarray) -> np.ndarray:
        """The cells of each row, ``bits`` bits each."""
        cells = np.empty(v.shape, dtype=np.uint8)
        for d, q in enumerate(self.inner):
            cells[:, d] = np.searchsorted(q, v[:, d], side="right")
        return np.packbits(np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - self.bits:].reshape(len(v), -1), axis=1)

    def unpack(self, packed: np.ndarray) -> np.ndarray:
        dims = len(self.inner)
        flat = np.unpackbits(packed, axis=1, count=dims * self.bits).reshape(len(packed), dims, self.bits)
        whole = np.zeros((len(packed), dims, 8), dtype=np.uint8)
        whole[:, :, 8 - self.bits:] = flat
        return np.packbits(whole, axis=2)[:, :, 0]


def va_file(ints: DataFrame, cells: Cells) -> DataFrame:
    """(id, cells, full): the approximations and the packed vectors, written to the shared folder."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, STEP):
                part = b.slice(lo, STEP)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
                v = flat.reshape(part.num_rows, -1).astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r.tobytes() for r in cells.pack(v)], pa.binary()),
                     pa.array([r.tobytes() for r in v], pa.binary())], names=["id", "cells", "full"])

    return materialize(ints.mapInArrow(run, "id long, cells binary, full binary"), "va-file")


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def _fetch(full: pa.Array, at: np.ndarray) -> np.ndarray:
    """The full vectors at these places of a batch."""
    return _matrix(full.take(pa.array(at)), "<i4").astype(np.int64)


class Lookup:
    """For given centroids: squared distance intervals of every cell, by dimension."""

    def __init__(self, cells: Cells, centroids: np.ndarray):
        self.centroids = centroids
        c = centroids.T[:, None, :]
        below, above = cells.least[:, :, None] - c, c - cells.most[:, :, None]
        self.low = np.maximum(np.maximum(below, above), 0) ** 2
        self.high = np.maximum(np.abs(below), np.abs(above)) ** 2

    def nearest(self, cells: np.ndarray, full: pa.Array) -> tuple[np.ndarray, int]:
        """Number of the nearest centroid of each row, and how many rows were fetched for it."""
        low = np.zeros((len(cells), len(self.centroids)), dtype=np.int64)
        high = np.zeros_like(low)
        for d in range(cells.shape[1]):
            low += self.low[d][cells[:, d]]
            high += self.high[d][cells[:, d]]
        maybe = low <= high.min(axis=1)[:, None]
        own = maybe.argmax(axis=1)
        several = np.flatnonzero(maybe.sum(axis=1) > 1)
        if len(several):
            v = _fetch(full, several)
            row, c = np.nonzero(maybe[several])
            exact = np.full((len(several), len(self.centroids)), np.iinfo(np.int64).max)
            exact[row, c] = ((v[row] - self.centroids[c]) ** 2).sum(axis=1)
            own[several] = exact.argmin(axis=1)  # the first of equal ones
        return own, len(several)


def _parts(batches, cells: Cells):
    for b in batches:
        for lo in range(0, b.num_rows, STEP):
            part = b.slice(lo, STEP)
            yield part, cells.unpack(_matrix(part.column(1), np.uint8)), part.column(2)


def moved_sums(file: DataFrame, cells: Cells, old: np.ndarray | None, new: np.ndarray) -> np.ndarray:
    """For each centroid of ``new`` the change against ``old`` of its vectors' sum and, in a last
    column, of their number; without ``old`` the whole sums."""
    sent = file.sparkSession.sparkContext.broadcast((cells, old, new))
    k, dims = new.shape

    def run(batches):
        cells, old, new = sent.value
        before, after = None if old is None else Lookup(cells, old), Lookup(cells, new)
        sums = np.zeros((k, dims + 1), dtype=np.int64)
        for _, cell, full in _parts(batches, cells):
            own, _ = after.nearest(cell, full)
            was = None if before is None else before.nearest(cell, full)[0]
            at = np.arange(len(own)) if was is None else np.flatnonzero(own != was)
            if len(at):
                v = np.column_stack((_fetch(full, at), np.ones(len(at), dtype=np.int64)))
                np.add.at(sums, own[at], v)
                if was is not None:
                    np.subtract.at(sums, was[at], v)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums.ravel()[at])], names=["at", "n"])

    rows = file.mapInArrow(run, "at long, n long").groupBy("at").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    out = np.zeros(k * (dims + 1), dtype=object)
    for r in rows:  # at most one for each centroid and dimension
        out[r["at"]] = int(r["n"])
    return out.reshape(k, dims + 1)


def fit(file: DataFrame, cells: Cells, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """The centroids after ``rounds`` rounds, or fewer where a round changes none."""
    old, sums = None, np.zeros((len(centroids), centroids.shape[1] + 1), dtype=object)
    for _ in range(rounds):
        sums = sums + moved_sums(file, cells, old, centroids)
        means = np.array([[x // s[-1] for x in s[:-1]] if s[-1] else c for s, c in zip(sums, centroids.tolist())], dtype=np.int64)
        old, centroids = centroids, means
        if np.array_equal(old, centroids):
            break
    return centroids


def assign(file: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector; the distance to the own centroid is measured."""
    sent = file.sparkSession.sparkContext.broadcast((cells, centroids))

    def run(batches):
        cells, centroids = sent.value
        lookup = Lookup(cells, centroids)
        for part, cell, full in _parts(batches, cells):
            own, _ = lookup.nearest(cell, full)
            far = ((_fetch(full, np.arange(len(own))) - centroids[own]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.int32()), pa.array(far, pa.int64())],
                                             names=["id", "cluster", "distance"])

    return file.mapInArrow(run, "id long, cluster int, distance long")


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", clusters: int = CLUSTERS,
            rounds: int = ROUNDS, dims: int = DIMS, bits: int = BITS, salt: str = "2:", scale: int = SCALE) -> DataFrame:
    """Id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of each kept vector."""
    if not 1 <= bits <= 8:
        raise ValueError("a cell has 1 to 8 bits")
    if dims > DIMS:
        raise ValueError(f"squared distances of over {DIMS} components may not fit a long")
    spark = vectors.sparkSession
    ints = integer_vectors(vectors, id_col, vec_col, dims, scale)
    start = first_centroids(ints, clusters, salt)
    if not len(start):
        return spark.createDataFrame([], f"{id_col} long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    cells = Cells.fitted(ints, dims, bits)
    file = va_file(ints, cells)
    final = fit(file, cells, start, rounds)
    own = materialize(assign(file, cells, final), "va-clusters")
    sums = {r["cluster"]: int(r["n"]) for r in own.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}  # one for each centroid
    named = [(i, sums.get(i, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
             for i, c in enumerate(final.tolist())]
    table = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return own.join(F.broadcast(table), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same rows in DuckDB: components in long form, rounds written out."""
    parts = ["""ints AS MATERIALIZED (
  SELECT row, vec_id, d, floor(256 * x)::BIGINT AS x FROM (
    SELECT row, vec_id, generate_subscripts(e, 1) AS d, unnest(e) AS x FROM (
      SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS e FROM embeddings)
    WHERE len(e) = 64)
  QUALIFY bool_and(x IS NOT NULL AND isfinite(x)) OVER (PARTITION BY row))""",
             f"""firsts AS (SELECT row, row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), list(x ORDER BY d)) - 1 AS k
  FROM ints GROUP BY row, vec_id ORDER BY k LIMIT {clusters})""",
             "c0 AS MATERIALIZED (SELECT k, d, x FROM ints JOIN firsts USING (row))"]
    for r in range(rounds + 1):
        parts.append(f"""own{r} AS MATERIALIZED (SELECT row, vec_id, arg_min(k, (far, k)) AS k, min(far) AS far FROM (
  SELECT row, vec_id, k, sum((ints.x - c{r}.x) * (ints.x - c{r}.x)) AS far FROM ints JOIN c{r} USING (d) GROUP BY row, vec_id, k)
  GROUP BY row, vec_id)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT k, d, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x
  FROM c{r} LEFT JOIN (SELECT k, d, sum(x) AS s, count(*) AS n FROM ints JOIN own{r} USING (row) GROUP BY k, d) USING (k, d))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, k::INTEGER AS cluster, far::BIGINT AS distance, (sum(far) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
  (sum(far) OVER ())::BIGINT AS inertia, centroid_sha256
FROM own{rounds} JOIN (SELECT k, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY k) USING (k)"""


ORACLE_SQL = _sql()
