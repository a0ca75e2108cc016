"""Centroid clustering in exact integers, with Orchard's search.

A vector's components become ``floor(scale * x)``; centroids stay integers
(floor of the exact mean), so no result depends on how rows are partitioned.

**Orchard search.** Every centroid has the list of all others by rising distance
from it. A vector starts at one centroid and walks that centroid's list; a
closer centroid (or one as close with a smaller number) is jumped to at once and
its list is walked from the front; centroids measured before are marked and
skipped. The walk ends when the next one in the list lies strictly beyond twice
the current distance from the current centroid: by the triangle inequality it,
and all behind it, are farther from the vector than the current centroid. At
exactly twice the distance it could still tie, so the comparison is strict.
Squared integers are compared (``d2(c, j) > 4 * d2(x, c)``). The walk runs over a
slice of vectors at a time in numpy.

**Rounds on Spark.** The kept vectors are packed once to 32-bit integers in the
shared folder. A round is one narrow pass: each task sends one sum for every
centroid and component, which are added up by a group-by on (centroid,
component), so a cluster that holds any share of the rows is no hot group. The
driver sees the k centroids and nothing that grows with the rows. The number of
centroids and of components bound what is sent to the tasks.

Components beyond ``SMALL`` (far outside any unit vector) are kept as decimal
strings and handled with Python's integers, one vector at a time, through the
same walk; sums travel in limbs of 60 bits, so they are exact at any size.

Defined results: a vector that is null, of another length, or has a null or
non-finite component is left out; a null id hashes as the empty string and is
returned as null; rows that repeat an id are vectors of their own (equal hashes:
by their components); fewer rows than k give fewer centroids; an empty table
gives no rows; a squared distance or sum beyond a long is null; further columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.llm._common import read_table
from sifter.session import materialise

#: Largest component of the numpy walk: 4 * 64 * (2 * SMALL)**2 fits in a long.
SMALL = 1 << 25
_LIMB = 60
_LONG = (1 << 63) - 1
_SLICE = 4096


def to_integer(x: float, scale: int) -> int:
    """floor(scale * x), exact for every finite double."""
    return math.floor(x * scale) if abs(x) < 1 << 40 else int(x) * scale


def distance2(a, b) -> int:
    return sum((x - y) ** 2 for x, y in zip(a, b))


class Orchard:
    """Nearest of the given integer centroids, ties to the smaller number."""

    def __init__(self, centroids: list[list[int]]):
        k = len(centroids)
        self.centroids = centroids
        d = [[distance2(a, b) for b in centroids] for a in centroids]
        self.near = [sorted((j for j in range(k) if j != c), key=lambda j: (d[c][j], j)) for c in range(k)]
        self.gaps = [[d[c][j] for j in self.near[c]] for c in range(k)]
        self.small = np.array([all(abs(x) <= SMALL for x in c) for c in centroids])
        self.start = int(np.argmax(self.small)) if k else 0
        # for the numpy walk; a gap beyond a long ends every walk just as well
        self.order = np.array([near + [0] for near in self.near], np.int64).reshape(k, k)
        self.gap = np.array([[min(g, 1 << 62) for g in gaps] + [1 << 62] for gaps in self.gaps], np.int64).reshape(k, k)
        self.table = np.array([c if s else [0] * len(c) for c, s in zip(centroids, self.small)], np.int64)

    def one(self, x: list[int]) -> tuple[int, int]:
        """(number, squared distance) for one vector of any size."""
        at = self.start
        best, seen, p = distance2(x, self.centroids[at]), {at}, 0
        while p < len(self.near[at]) and self.gaps[at][p] <= 4 * best:
            j = self.near[at][p]
            p += 1
            if j not in seen:
                seen.add(j)
                d = distance2(x, self.centroids[j])
                if (d, j) < (best, at):
                    at, best, p = j, d, 0
        return at, best

    def many(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The walk for the rows of ``v`` (components within ``SMALL``)."""
        m, k = len(v), len(self.centroids)
        at = np.full(m, self.start)
        if not self.small[self.start]:
            return self._each(v, np.arange(m), at, np.zeros(m, np.int64))
        best = self._measure(v, at)
        seen = np.zeros((m, k), bool)
        seen[:, self.start] = True
        p = np.zeros(m, np.int64)
        wide: list[np.ndarray] = []
        walk = np.arange(m)
        while len(walk):
            c, q = at[walk], p[walk]
            on = (q < k - 1) & (self.gap[c, q] <= 4 * best[walk])
            walk, j = walk[on], self.order[c[on], q[on]]
            p[walk] += 1
            new = ~seen[walk, j]
            a, j = walk[new], j[new]
            seen[a, j] = True
            if not self.small.all():  # a centroid beyond numpy's range: leave these rows to the exact walk
                far = ~self.small[j]
                if far.any():
                    wide.append(a[far])
                    walk = np.setdiff1d(walk, a[far], assume_unique=True)
                    a, j = a[~far], j[~far]
            d = self._measure(v[a], j)
            closer = (d < best[a]) | ((d == best[a]) & (j < at[a]))
            a = a[closer]
            at[a], best[a], p[a] = j[closer], d[closer], 0
        return self._each(v, np.concatenate(wide), at, best) if wide else (at, best)

    def _measure(self, v: np.ndarray, j: np.ndarray) -> np.ndarray:
        gap = v - self.table[j]
        return np.einsum("ij,ij->i", gap, gap)

    def _each(self, v: np.ndarray, rows: np.ndarray, at: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best = best.astype(object)
        for i in rows.tolist():
            at[i], best[i] = self.one(v[i].tolist())
        return at, best


def pack_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """``(id, small binary, wide array<string>)`` of the vectors that count:
    32-bit integers where all fit ``SMALL``, decimal strings otherwise."""
    v = F.col(f"`{vec_col}`")
    good = F.coalesce((F.size(v) == dims) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))), F.lit(False))
    rows = vectors.where(good).select(F.col(f"`{id_col}`").alias("id"), v.cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dims)
            fits = (np.abs(x) * scale < SMALL).all(axis=1)
            whole = np.floor(np.where(fits[:, None], x, 0.0) * scale).astype("<i4")
            small = [row.tobytes() if f else None for row, f in zip(whole, fits.tolist())]
            wide = [None if f else [str(to_integer(c, scale)) for c in row.tolist()] for row, f in zip(x, fits.tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(small, pa.binary()), pa.array(wide, pa.list_(pa.string()))],
                                             names=["id", "small", "wide"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, small binary, wide array<string>")


def _unpack(small: bytes | None, wide: list[str] | None) -> list[int]:
    return np.frombuffer(small, "<i4").tolist() if small is not None else [int(x) for x in wide]


def _slices(batch: pa.RecordBatch, dims: int):
    """(row numbers, vectors) of the small rows in slices, and the wide rows."""
    small, wide = batch.column("small"), batch.column("wide")
    is_small = small.is_valid().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(is_small)
    v = np.frombuffer(b"".join(x for x in small.to_pylist() if x is not None), "<i4").reshape(len(rows), dims)
    parts = [(rows[i:i + _SLICE], v[i:i + _SLICE].astype(np.int64)) for i in range(0, len(rows), _SLICE)]
    far = np.flatnonzero(~is_small)
    return parts, [(int(i), [int(x) for x in wide[int(i)].as_py()]) for i in far]


def _limbs(value: int) -> list[int]:
    """Signed value as 60-bit limbs, the last one signed."""
    out = []
    while not -(1 << _LIMB) <= value < 1 << _LIMB:
        out.append(value & ((1 << _LIMB) - 1))
        value >>= _LIMB
    return [*out, value]


def _sums(packed: DataFrame, centroids: list[list[int]], dims: int) -> dict[tuple[int, int], int]:
    """Exact sums by (centroid, component); component -1 counts the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchard = Orchard(centroids)
        totals = np.zeros((len(centroids), dims), np.int64)
        counts = np.zeros(len(centroids), np.int64)
        extra: dict[tuple[int, int], int] = {}
        for b in batches:
            parts, far = _slices(b, dims)
            for _, v in parts:
                at, _ = orchard.many(v)
                by = np.argsort(at, kind="stable")
                numbers, first = np.unique(at[by], return_index=True)
                totals[numbers] += np.add.reduceat(v[by], first, axis=0)
                counts += np.bincount(at, minlength=len(centroids))
            for _, x in far:
                c, _ = orchard.one(x)
                counts[c] += 1
                for d, value in enumerate(x):
                    extra[c, d] = extra.get((c, d), 0) + value
        rows = [(c, -1, 0, n) for c, n in enumerate(counts.tolist()) if n]
        for c, _, _, _ in list(rows):
            for d, s in enumerate(totals[c].tolist()):
                rows += [(c, d, i, limb) for i, limb in enumerate(_limbs(s + extra.get((c, d), 0)))]
        cols = list(zip(*rows)) if rows else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                         names=["c", "d", "limb", "value"])

    got = (packed.select("small", "wide").mapInArrow(run, "c int, d int, limb int, value bigint")
           .groupBy("c", "d", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect())
    out: dict[tuple[int, int], int] = {}
    for r in got:  # at most centroids x (components + 1) sums
        out[r.c, r.d] = out.get((r.c, r.d), 0) + (int(r.value) << (_LIMB * r.limb))
    return out


@dataclass
class Clustering:
    """``rows (id, cluster, distance)`` written in the shared folder, and the
    final centroids."""

    rows: DataFrame
    centroids: list[list[int]]


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 8, dims: int = 64,
            rounds: int = 10, scale: int = 1024, salt: str = "3") -> Clustering:
    """Lloyd rounds from the ``k`` vectors with the smallest hash of
    ``salt:id``; every vector is assigned by Orchard search."""
    packed = materialise(pack_vectors(vectors, id_col, vec_col, dims, scale), "vectors")
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = packed.orderBy(key, F.hex("small"), F.to_json("wide")).limit(k).collect()
    centroids = [_unpack(r.small, r.wide) for r in first]
    for _ in range(rounds if centroids else 0):
        sums = _sums(packed, centroids, dims)
        centroids = [[sums[c, d] // sums[c, -1] for d in range(dims)] if (c, -1) in sums else old
                     for c, old in enumerate(centroids)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchard = Orchard(centroids)
        for b in batches:
            number, distance = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, object)
            parts, far = _slices(b, dims)
            for rows, v in parts:
                number[rows], distance[rows] = orchard.many(v)
            for i, x in far:
                number[i], distance[i] = orchard.one(x)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(number), pa.array([int(d) if d <= _LONG else None for d in distance], pa.int64())],
                names=["id", "cluster", "distance"])

    kind = packed.schema["id"].dataType.simpleString()
    return Clustering(materialise(packed.mapInArrow(run, f"id {kind}, cluster int, distance bigint"), "clusters"), centroids)


def with_inertia(got: Clustering) -> DataFrame:
    """The rows with the sum of distances of their cluster and of all, and the
    hash of their final centroid. A small table of one row a centroid is
    broadcast."""
    spark = got.rows.sparkSession
    # a distance that is no long makes its sums null as well
    total = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    by = got.rows.groupBy("cluster").agg(total.alias("inertia")).collect()  # k rows at most
    sums = {r.cluster: None if r.inertia is None else int(r.inertia) for r in by}

    def as_long(x: int | None) -> int | None:
        return x if x is not None and x <= _LONG else None

    whole = None if None in sums.values() else sum(sums.values())
    table = spark.createDataFrame([(c, as_long(s), as_long(whole), ",".join(map(str, got.centroids[c]))) for c, s in sums.items()],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid string")
    return (got.rows.join(F.broadcast(table), "cluster")
            .select("id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("centroid", 256).alias("centroid_sha256")))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256 of all vectors of ``embeddings`` that count."""
    got = with_inertia(cluster(read_table(spark, sf_dir, "embeddings"), k=8, dims=64, rounds=10, scale=1024, salt="3"))
    return got.withColumnRenamed("id", "vec_id")


def _oracle(k: int = 8, dims: int = 64, rounds: int = 10) -> str:
    nearest = f"""
a{{r}} AS MATERIALIZED (
  SELECT rid, vec_id, v, best % {k} AS k, best // {k} AS d FROM (
    SELECT rid, any_value(vec_id) AS vec_id, any_value(kept.v) AS v,
           min(CAST(list_sum(list_transform(range(1, {dims + 1}), lambda i: (kept.v[i] - c.v[i]) * (kept.v[i] - c.v[i]))) AS BIGINT) * {k} + c.k) AS best
    FROM kept CROSS JOIN c{{r}} AS c GROUP BY rid))"""
    moved = """
c{n} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{r} AS c LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
      SELECT k, i, sum(x) AS s, count(*) AS n FROM (
        SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY k, i) GROUP BY k) AS m USING (k))"""
    steps = ",".join(nearest.format(r=r) + "," + moved.format(r=r, n=r + 1) for r in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dims}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, rid) - 1 AS k, v
  FROM (SELECT rid, v, sha256('3:' || vec_id) AS h FROM kept) ORDER BY h, rid LIMIT {k}),
{steps},
{nearest.format(r=rounds)}
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c ON a.k = c.k
"""


ORACLE = _oracle()
