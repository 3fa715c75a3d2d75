"""Centroid clustering by Yinyang's bounds, in whole numbers.

The centroids are put into groups once, by a few rounds of clustering them. A vector keeps an upper
bound of the distance to its own centroid and, for each group, a lower bound of the distances to that
group's other centroids. When centroids move, the bounds move with them by the distances they went. A vector
whose upper bound lies below all lower bounds stays without a look (global filter). Else its own
distance is computed and compared again; then only groups whose lower bound isn't above it are
scanned, all their centroids exactly (group filter).

Distances are squared and whole; bounds are roots in doubles, widened by more than their rounding, and
exclude only what is strictly farther. So the assignment of every round is that of a full scan, ties
included. Vectors and bounds are a table that each round reads once and writes once, without a
shuffle; every task adds its clusters' sums, so that the driver gets one sum for each centroid and
component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomend.llm.common import written

#: Centroids of a group, about, and rounds of grouping them.
PER_GROUP, GROUPING = 10, 5
#: Components beyond this count as it; a squared distance beyond LONG is returned as that.
LARGEST, LONG = 2**62, 2**63 - 1
#: Relative and absolute slack of bounds, far above the rounding of a few additions.
SLACK, LEAST_SLACK = 1e-9, 1e-6
STATE = "id long, v array<double>, cluster int, upper double, lower array<double>, distance long, {more}"
SUMS = "of int, n long, sums array<decimal(38,0)>"


def usable(vector: Column, size: int) -> Column:
    """Of that size, and without null, NaN or infinite components."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce((F.size(vector) == size) & ~F.exists(vector, odd), F.lit(False))


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as a double, which holds it exactly; at most LARGEST either way."""
    bound = float(LARGEST)
    cut = lambda x: F.greatest(F.least(scale * x.cast("double"), F.lit(bound)), F.lit(-bound))
    return F.transform(vector, lambda x: F.when(F.abs(cut(x)) < 2.0**53, F.floor(cut(x)).cast("double")).otherwise(cut(x)))


def _kind(v: np.ndarray, centroids: np.ndarray) -> type:
    """What holds every sum of a squared distance exactly: doubles, else 64-bit integers, else Python's."""
    largest = max(np.abs(v).max(initial=0), np.abs(centroids).max(initial=0))
    room = 4 * max(1, v.shape[1]) * int(largest) ** 2
    return np.float64 if room < 2**53 else np.int64 if room < 2**62 else object


def squares(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of v to all centroids, exact."""
    kind = _kind(v, centroids)
    a, b = _whole(v, kind), _whole(centroids, kind)
    d = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
    return d if kind is object else d.astype(np.int64)


def _whole(x: np.ndarray, kind: type) -> np.ndarray:
    if kind is not object:
        return x.astype(kind)
    return np.array([int(c) for c in x.ravel()], object).reshape(x.shape)


def own_squares(v: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """The squared distance of each row to its own centroid, exact."""
    out = np.zeros(len(v), object if _kind(v, centroids) is object else np.int64)
    for c in np.unique(cluster):
        rows = cluster == c
        out[rows] = squares(v[rows], centroids[c : c + 1])[:, 0]
    return out


def roots(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(float))


def above(x: np.ndarray) -> np.ndarray:
    return x * (1 + SLACK) + LEAST_SLACK


def below(x: np.ndarray) -> np.ndarray:
    return x * (1 - SLACK) - LEAST_SLACK


def grouped(centroids: np.ndarray) -> np.ndarray:
    """Each centroid's group: the centroids clustered among themselves."""
    n = max(1, len(centroids) // PER_GROUP)
    points = centroids.astype(float)
    middle = points[np.linspace(0, len(points) - 1, n).astype(int)]
    for _ in range(GROUPING):
        near = ((points[:, None, :] - middle[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
        middle = np.array([points[near == g].mean(axis=0) if (near == g).any() else middle[g] for g in range(n)])
    return np.unique(near, return_inverse=True)[1]


@dataclass(frozen=True)
class Round:
    """Centroids of a round, their groups, and how far each went since the round before (None in the first)."""

    centroids: np.ndarray
    groups: np.ndarray
    moved: np.ndarray | None

    def assign(self, v: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """cluster, upper and lower bounds after this round, and how many distances were computed."""
        n_groups = int(self.groups.max()) + 1
        if self.moved is None:
            return self._scan(v, np.full(len(v), -1), np.zeros(len(v)), np.zeros((len(v), n_groups)), np.ones((len(v), n_groups), bool))
        most = np.array([self.moved[self.groups == g].max() for g in range(n_groups)])
        cluster, upper, lower = cluster.copy(), above(upper + self.moved[cluster]), below(lower - most[None, :])
        look = np.flatnonzero(upper >= lower.min(axis=1))
        done = len(look)
        upper[look] = above(roots(own_squares(v[look], self.centroids, cluster[look])))
        look = look[upper[look] >= lower[look].min(axis=1)]
        if len(look):
            cluster[look], upper[look], lower[look], more = self._scan(v[look], cluster[look], upper[look], lower[look], lower[look] <= upper[look][:, None])
            done += more
        return cluster, upper, lower, done

    def _scan(self, v: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """All centroids of each row's wanted groups, and its own one; ties go to the smaller number."""
        n, far = len(v), LONG
        known = np.zeros((n, len(self.centroids)), bool)
        parts, done = [], 0
        for g in range(wanted.shape[1]):
            rows, members = np.flatnonzero(wanted[:, g]), np.flatnonzero(self.groups == g)
            parts.append((rows, members, squares(v[rows], self.centroids[members])))
            done += parts[-1][2].size
        own = np.flatnonzero(cluster >= 0)
        at_own = own_squares(v[own], self.centroids, cluster[own])
        kind = object if any(p[2].dtype == object for p in parts) or at_own.dtype == object else np.int64
        d = np.full((n, len(self.centroids)), far, kind)
        for rows, members, found in parts:
            d[np.ix_(rows, members)] = found
            known[np.ix_(rows, members)] = True
        d[own, cluster[own]], known[own, cluster[own]] = at_own, True
        new = _least(d, known)
        root = np.where(known, roots(d), np.inf)
        upper, lower = above(root[np.arange(n), new]), lower.copy()
        root[np.arange(n), new] = np.inf
        for g in range(wanted.shape[1]):
            nearest = below(root[:, self.groups == g].min(axis=1))
            # A group that was not scanned keeps its bound, but for a centroid of it that was just left.
            lower[:, g] = np.where(wanted[:, g], nearest, np.minimum(lower[:, g], nearest))
        return new, upper, lower, done


def _least(d: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The first known column with the least value, in every row."""
    if d.dtype != object:
        return np.where(known, d, LONG).argmin(axis=1)
    return np.array([min(np.flatnonzero(k), key=lambda j: (row[j], j)) for row, k in zip(d, known)], np.int64).reshape(len(d))


def _sums(v: np.ndarray, cluster: np.ndarray, n: int) -> dict[int, tuple[int, list[int]]]:
    out = {}
    for c in range(n):
        rows = v[cluster == c]
        if len(rows):
            small = np.abs(rows).max() * len(rows) < 2**53
            out[c] = len(rows), [int(x) for x in (rows if small else _whole(rows, object)).sum(axis=0)]
    return out


def pass_over(table: DataFrame, now: Round, size: int, last: bool) -> DataFrame:
    """The table's vectors with this round's clusters and bounds, and from each task a row for each
    cluster (of, n, sums): the sums of its vectors, or in the last round of their distances."""
    k, n_groups = len(now.centroids), int(now.groups.max()) + 1
    first = now.moved is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[int, list[int]]] = {}

        def row(ids: pa.Array, v: pa.Array, cluster: pa.Array, upper: pa.Array, lower: pa.Array, distance: pa.Array, of: pa.Array, n: pa.Array, sums: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([ids, v, cluster, upper, lower, distance, of, n, sums], ["id", "v", "cluster", "upper", "lower", "distance", "of", "n", "sums"])

        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(m, size)
            if first:
                cluster, upper, lower = np.zeros(m, np.int64), np.zeros(m), np.zeros((m, n_groups))
            else:
                cluster, upper = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
                cluster, lower = cluster.astype(np.int64), batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(m, n_groups)
            cluster, upper, lower, _ = now.assign(v, cluster, upper, lower)
            if last:
                exact = [min(LONG, int(x)) for x in own_squares(v, now.centroids, cluster)]
                distance = np.array(exact, np.int64)
                found = {c: (int((cluster == c).sum()), [sum(int(x) for x in distance[cluster == c])]) for c in np.unique(cluster).tolist()}
            else:
                distance, found = np.zeros(m, np.int64), _sums(v, cluster, k)
            for c, (n, sums) in found.items():
                old = total.get(c, (0, [0] * len(sums)))
                total[c] = old[0] + n, [a + b for a, b in zip(old[1], sums)]
            bounds = pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * n_groups), pa.array(lower.ravel()))
            none = lambda t: pa.nulls(m, t)
            yield row(batch.column(0), batch.column(1), pa.array(cluster.astype(np.int32)), pa.array(upper), bounds, pa.array(distance), none(pa.int32()), none(pa.int64()), none(pa.list_(pa.decimal128(38, 0))))
        if total:
            none, of = (lambda t: pa.nulls(len(total), t)), sorted(total)
            yield row(none(pa.int64()), none(pa.list_(pa.float64())), none(pa.int32()), none(pa.float64()), none(pa.list_(pa.float64())), none(pa.int64()), pa.array(of, pa.int32()), pa.array([total[c][0] for c in of]), pa.array([total[c][1] for c in of], pa.list_(pa.decimal128(38, 0))))

    return table.mapInArrow(run, STATE.format(more=SUMS))


def gathered(table: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Each cluster's count and sums over all tasks: one number for each cluster and component."""
    parts = table.where(F.col("of").isNotNull()).select("of", "n", F.posexplode("sums").alias("at", "x"))
    out: dict[int, tuple[int, dict[int, int]]] = {}
    for r in parts.groupBy("of", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect():
        out.setdefault(r["of"], (r["n"], {}))[1][r["at"]] = int(r["x"])
    return {c: (n, [sums[i] for i in range(len(sums))]) for c, (n, sums) in out.items()}


def starts(table: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of "seed:id", the first centroids; null ids last, ties by the vector."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = table.select(order.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).select("v").collect()
    return np.array([[int(x) for x in r["v"]] for r in rows], object)


def clustered(vectors: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: int = 2, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors of `size` components, none null, NaN or infinite, are kept, each component x as
    floor(scale * x). `rounds` times each vector goes to the nearest centroid (squared distance, ties to
    the smaller number) and each centroid that has vectors becomes the floor of their mean, component by
    component; an empty one stays. Then vectors are assigned once more. With fewer vectors than k there
    are as many centroids; no vectors give no rows. Equal vectors, rows and ids each count for
    themselves; a row with a null id takes part and is no first centroid while there are others.
    Components beyond 2^62 count as that, sums and distances beyond the largest long as that. Other
    columns are not read. centroid_sha256: of the final centroid's components, joined by commas.
    """
    spark = vectors.sparkSession
    kept = vectors.where(usable(F.col(vector_col), size)).select(F.col(id_col).cast("long").alias("id"), integers(F.col(vector_col), scale).alias("v"))
    first = starts(kept, k, seed)
    if not len(first):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    now = Round(first.astype(np.int64), grouped(first), None)
    table = kept
    for _ in range(rounds):
        table = written(pass_over(table, now, size, last=False), "clusters")
        new = now.centroids.copy()
        for c, (n, sums) in gathered(table).items():
            new[c] = [s // n for s in sums]
        moved = above(roots(np.array([squares(a[None, :], b[None, :])[0, 0] for a, b in zip(new, now.centroids)], object)))
        table = table.where(F.col("of").isNull()).drop("of", "n", "sums")
        now = Round(new, now.groups, moved)
    table = written(pass_over(table, now, size, last=True), "clusters")
    inertia = {c: sums[0] for c, (_, sums) in gathered(table).items()}
    long = lambda x: min(LONG, x)
    rows = [(c, long(x), long(sum(inertia.values())), hashlib.sha256(",".join(str(int(y)) for y in now.centroids[c]).encode()).hexdigest()) for c, x in sorted(inertia.items())]
    few = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    found = table.where(F.col("of").isNull()).select(F.col("id").alias("vec_id"), "cluster", "distance")
    return found.join(F.broadcast(few), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: int = 2) -> str:
    """Full scans in SQL, one after the other: c0 are the first centroids, a1 the first assignment."""
    parts = [f"""v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""", f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) AS INTEGER) - 1 AS c, e FROM v ORDER BY sha256('{seed}:' || vec_id) LIMIT {k})"]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, v.e, c, CAST(list_dot_product(v.e, v.e) - 2 * list_dot_product(v.e, k.e) + list_dot_product(k.e, k.e) AS BIGINT) AS d
  FROM v CROSS JOIN c{i} k QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1
)""")
        if i < rounds:
            parts.append(f"""s{i} AS (SELECT c, i, floor(sum(e[i]) / count(*)) AS x FROM a{i}, range(1, {size + 1}) r(i) GROUP BY c, i),
c{i + 1} AS MATERIALIZED (SELECT c0.c, coalesce(n.e, p.e) AS e FROM c0 JOIN c{i} p USING (c) LEFT JOIN (SELECT c, list(x ORDER BY i) AS e FROM s{i} GROUP BY c) n USING (c))""")
    joined = "array_to_string(list_transform(k.e, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')"
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256({joined}) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} k ON k.c = a.c
"""


ORACLE = _oracle()
