"""Exact top-k search over vectors, block at a time.

A vector's components are its terms. Vectors are dealt to shards; a shard orders its vectors by
similarity and cuts that order into blocks. A block keeps the largest and the smallest value of each
term, and its vectors as a dense forward index. For a query, a block's bound is the sum over terms of
the query's weight times the maximum (or, for a negative weight, the minimum). Blocks are visited
from the highest bound on and scored through their forward index, until the bound falls below the
k-th score so far. That score starts, in every shard, from the query's k-th score over a bounded
sample of all vectors. Bounds only exclude blocks whose vectors are alike: of independent random
directions in many dimensions nearly all blocks are scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a block; vectors of a shard, about; queries handled at once.
BLOCK, SHARD, QUERIES = 64, 8192, 512
#: Queries of a group, about; each group meets each shard in a task of its own.
GROUP = 8192
#: Vectors that give the first k-th score of every query, and rounds of ordering by similarity.
SAMPLE, ROUNDS = 1024, 3
#: Largest component, and largest score either way.
HUGE, LONG = 1e300, 2**63 - 1


def usable(vector: Column) -> Column:
    """Not null, and without null, NaN or infinite components."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, odd)


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, as double: from 2^53 on a double is whole as it is."""

    def whole(x: Column) -> Column:
        y = F.greatest(F.least(scale * x.cast("double"), F.lit(HUGE)), F.lit(-HUGE))
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)

    return F.transform(vector, whole)


def padded(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers: in doubles while every sum is exact in them, then in 64-bit integers,
    then in Python's, whose results are cut to LONG."""
    largest = a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0)
    if largest < 2**53:
        return (a @ b.T).astype(np.int64)
    if largest < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = lambda x: np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
    return np.clip(exact(a) @ exact(b).T, -LONG, LONG).astype(np.int64)


def alike(vectors: np.ndarray) -> np.ndarray:
    """For each vector its group: the nearest of some centres, after a few rounds of moving them."""
    groups = max(1, len(vectors) // BLOCK)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors / np.where(norm > 0, norm, 1)
    centres = unit[np.linspace(0, len(unit) - 1, groups).astype(int)]
    for _ in range(ROUNDS):
        near = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return (unit @ centres.T).argmax(axis=1)


def best(ids: np.ndarray, scores: np.ndarray, real: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each row: real ones first, then by score, then by smaller id."""
    top = np.lexsort((ids, -scores, ~real), axis=1)[:, :k]
    return tuple(np.take_along_axis(x, top, 1) for x in (ids, scores, real))


class Shard:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        group = alike(vectors)
        order = np.lexsort((ids, group))
        self.ids, self.vectors, group = ids[order], vectors[order], group[order]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        ends = np.concatenate([starts[1:], [len(ids)]])
        self.blocks = [slice(at, min(at + BLOCK, e)) for s, e in zip(starts, ends) for at in range(s, e, BLOCK)]
        self.most = np.array([self.vectors[b].max(axis=0) for b in self.blocks])
        self.least = np.array([self.vectors[b].min(axis=0) for b in self.blocks])
        self.scored = 0

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, scores, real) of the k best candidates of each query, best first; real is false where there
        are fewer. floors: scores below which no candidate is asked for."""
        most, least = product(np.maximum(queries, 0), self.most), product(np.minimum(queries, 0), self.least)
        bound = most.astype(float) + least.astype(float)
        bound += np.abs(bound) * 1e-12  # sums of large products are rounded
        order = np.argsort(-bound, axis=1, kind="stable")
        n = len(queries)
        ids, scores, real = np.zeros((n, k), np.int64), np.full((n, k), -LONG), np.zeros((n, k), bool)
        kth, active = floors.copy(), np.arange(n)
        for step in range(len(self.blocks)):
            at = order[active, step]
            stay = bound[active, at] >= kth[active]  # an equal score may have a smaller id
            active, at = active[stay], at[stay]
            if not len(active):
                break
            for b in np.unique(at):
                q, own = active[at == b], self.ids[self.blocks[b]]
                found = product(queries[q], self.vectors[self.blocks[b]])
                self.scored += found.size
                other = own[None, :] != query_ids[q][:, None]
                every = np.concatenate([ids[q], np.broadcast_to(own, found.shape)], axis=1)
                ids[q], scores[q], real[q] = best(every, np.concatenate([scores[q], found], axis=1), np.concatenate([real[q], other], axis=1), k)
                kth[q] = np.maximum(floors[q], np.where(real[q, -1], scores[q, -1], -LONG))
        return ids, scores, real & (scores >= floors[:, None])


def with_floors(asked: DataFrame, sample: pd.DataFrame, k: int) -> DataFrame:
    """asked (id, v) and floor: the k-th score of each query over the sample (id, v), -LONG where that has fewer."""
    own, vectors = sample["id"].to_numpy(np.int64), list(sample["v"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), QUERIES):
                part = batch.iloc[at : at + QUERIES]
                floor = np.full(len(part), -LONG)
                if len(own):
                    width = max(part["v"].map(len).max(), max(map(len, vectors)))
                    found = product(padded(list(part["v"]), width), padded(vectors, width))
                    other = own[None, :] != part["id"].to_numpy(np.int64)[:, None]
                    _, scores, real = best(np.broadcast_to(own, found.shape), found, other, k)
                    if scores.shape[1] == k:
                        floor = np.where(real[:, -1], scores[:, -1], -LONG)
                yield part.assign(floor=floor)

    return asked.mapInPandas(run, "id long, v array<double>, floor long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", shards: int | None = None) -> DataFrame:
    """One row per query and rank: query_id, rank (from 1), vec_id, score.

    Components x count as floor(scale * x); the score is the inner product in whole numbers, ties go
    to the smaller vec_id. Candidates of a query are all rows with another id. Vectors that are null
    or hold a null or non-finite component take no part, nor rows with a null id; shorter vectors
    count as padded with zeros. Of repeated ids each row is a candidate, and a query asked once, with
    the least of its vectors in order. Components beyond 1e300 count as that, scores that pass 64 bits
    as the largest or smallest long. A query with fewer candidates gets them all. Other columns are
    not read; no rows give no rows. Each shard meets the queries in groups, so that no task holds all
    queries or all vectors; so every vector is sent to each group of GROUP queries. SAMPLE vectors,
    the first by a hash, pass through the driver.
    """
    table = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    table = table.select(F.col(id_col).cast("long").alias("id"), integers(F.col(vector_col), scale).alias("v"), is_query.alias("asked"))
    n, n_asked = table.agg(F.count("*"), F.count_if("asked")).head()
    shards, groups = shards or max(1, -(-n // SHARD)), max(1, -(-n_asked // GROUP))
    sample = table.select("id", "v", F.xxhash64("id", "v").alias("h")).orderBy("h", "id").limit(SAMPLE).toPandas()
    all_of = lambda m, name: F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(name)
    of = lambda key, m, name: F.pmod(key, F.lit(m)).cast("int").alias(name)
    # By id and vector: a row goes to the same shard however often its task runs. Of equal rows no more than k
    # can be among the k best, so no shard gets more of them.
    equal = table.groupBy("id", "v").agg(F.count("*").alias("times")).select("id", "v", F.explode(F.sequence(F.lit(1), F.least(F.col("times"), F.lit(k)).cast("int"))).alias("copy"))
    rows = equal.select("id", "v", of(F.xxhash64("id", "v"), shards, "shard"), all_of(groups, "part"))
    asked = with_floors(table.where("asked").groupBy("id").agg(F.min("v").alias("v")), sample, k)
    asked = asked.select("id", "v", "floor", of(F.xxhash64("id"), groups, "part"), all_of(shards, "shard"))

    def search(key: tuple, data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")]
        if len(data) and len(queries):
            width = max(data["v"].map(len).max(), queries["v"].map(len).max())
            shard = Shard(data["id"].to_numpy(np.int64), padded(list(data["v"]), width))
            for at in range(0, len(queries), QUERIES):
                part = queries.iloc[at : at + QUERIES]
                own = part["id"].to_numpy(np.int64)
                ids, scores, real = shard.search(own, padded(list(part["v"]), width), part["floor"].to_numpy(np.int64), k)
                out.append(pd.DataFrame({"query_id": np.repeat(own, k)[real.ravel()], "vec_id": ids[real], "score": scores[real]}))
        return pd.concat(out)

    found = rows.groupBy("shard", "part").cogroup(asked.groupBy("shard", "part")).applyInPandas(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(d.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
