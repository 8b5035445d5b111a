"""Exact top-k search by a Voronoi join.

Data go to their nearest pivot; the number of pivots grows with the root of the table. Each pivot's cell is summarised: its rows, its radius
around the pivot, its greatest norm, and its least and greatest value in each dimension. A query is solved in its best cell first (that of the
pivot with the greatest inner product), which gives a lower bound for its k-th best score. From the summaries every other cell has an upper
bound, the least of three: <q,p> + |q| radius, |q| times the greatest norm, and the sum of each dimension's better end; a query is replicated
only to the cells whose upper bound reaches its lower bound. Cells are cut into blocks of rows by a hash, so a crowded cell is many tasks; each
block is solved by one matrix product and keeps k rows a query; the blocks' results are ranked last.

How many cells remain depends on the data: of clustered vectors few, of vectors without structure in many dimensions all (see replication()).

Scores are integer inner products of floor(scale * x), computed in float64 while every partial sum is exact there, for rows with larger numbers in Python
integers; scores beyond a long count as the greatest (least) one, and such scores rank among each other by id. Every finite vector takes part, whatever
its size. Vectors that are null or hold null or non-finite components take no part, nor do vectors of another length than the most common one (the shorter
on ties), nor rows without an id. Ties go to the smaller id. Repeated rows (same id, same vector) count once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

OUT = "query_id long, rank int, vec_id long, score long"
#: The greatest double.
MOST = 1.7976931348623157e308
#: Bytes of an array of rows by pivots that a task holds.
ARRAY_BYTES = 32 << 20
#: Up to so many dimensions the summaries hold each dimension's ends, an aggregate each.
MOST_BOXED = 256


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id long, v array<double> of the vectors that take part."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
    common = kept.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return kept.where(F.size("v") == (common.n if common else 0))


def matrix(v: pd.Series) -> np.ndarray:
    return np.array(v.tolist(), dtype=np.float64).reshape(len(v), -1) if len(v) else np.zeros((0, 0))


def whole(x: np.ndarray) -> np.ndarray:
    """The same numbers as Python integers."""
    return np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, held within the range of a long; rows with large numbers are worked out in Python integers."""
    most, safe = 2**63 - 1, 2.0**26 / math.sqrt(max(1, q.shape[1]))
    large_q, large_x = np.abs(q).max(axis=1, initial=0) >= safe, np.abs(x).max(axis=1, initial=0) >= safe
    out = (np.where(large_q[:, None], 0, q) @ np.where(large_x[:, None], 0, x).T).astype(np.int64)
    held = lambda exact: np.clip(exact, -most, most).astype(np.int64)
    if large_q.any():
        out[large_q] = held(whole(q[large_q]) @ whole(x).T)
    if large_x.any():
        out[:, large_x] = held(whole(q) @ whole(x[large_x]).T)
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


class Cells:
    """Pivots and the summaries of their cells. What is broadcast is this: it grows with the number of pivots."""

    def __init__(self, centres: np.ndarray, rows: list, block: int):
        self.cell, n = np.array([r.cell for r in rows], dtype=np.int32), np.array([r.n for r in rows])
        self.centres, self.blocks = centres[self.cell], -(-n // block)
        self.radius, self.norm = (np.array([r[c] for r in rows]) for c in ("radius", "norm"))
        self.low, self.high = (np.array([r[c] for r in rows]) for c in ("low", "high"))
        self.boxed = self.low.shape[1] > 0

    def best(self, q: np.ndarray) -> np.ndarray:
        """The place of each query's best cell."""
        return (q @ self.centres.T).argmax(axis=1)

    def upper(self, q: np.ndarray) -> np.ndarray:
        """The most that a row of a cell (columns) can score with a query (rows), with room for rounding."""
        length = np.sqrt((q**2).sum(axis=1))[:, None]
        least = np.minimum(q @ self.centres.T + length * self.radius[None, :], length * self.norm[None, :])
        if self.boxed:
            least = np.minimum(least, np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T)
        bound = least + 1e-9 * (1 + np.abs(least)) + 1e-9 * length * (self.norm + self.radius)[None, :]
        return np.where(np.isnan(bound), np.inf, bound)  # beyond the range of doubles nothing bounds a cell

    def copies(self, part: pd.DataFrame, row: np.ndarray, place: np.ndarray) -> pd.DataFrame:
        """A row for each block of the cells that a query goes to."""
        times = self.blocks[place]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        at = np.repeat(row, times)
        return pd.DataFrame({"id": part.id.to_numpy()[at], "v": part.v.to_numpy()[at], "cell": np.repeat(self.cell[place], times), "block": nth.astype("i4")})


COPIES = "id long, v array<double>, cell int, block int"


class VoronoiJoin:
    """The rows in their cells, the cells' summaries, and the copies of queries that go to them."""

    def __init__(self, vectors: DataFrame, is_query: Column, k: int, scale: float, pivots: int | None, block: int, id_col: str, vector_col: str):
        # From 2**52 on doubles are whole numbers; floor() would hold them within a long. What passes the greatest double counts as that.
        scaled = lambda x: F.greatest(F.least(x * F.lit(float(scale)), F.lit(MOST)), F.lit(-MOST))
        v = F.transform("v", lambda x: F.when(F.abs(scaled(x)) < 2.0**52, F.floor(scaled(x)).cast("double")).otherwise(scaled(x)))
        self.k, self.spark = k, vectors.sparkSession
        data = staged(usable(vectors, id_col, vector_col).select("id", v.alias("v"), is_query.alias("is_query")).dropDuplicates(["id", "v"]), "topk-data")
        many = pivots or max(64, math.isqrt(data.count()))
        chosen = data.select("id", "v").orderBy(F.xxhash64("id", F.lit("pivot")), "id").limit(many).collect()
        self.empty = not chosen
        if self.empty:
            return
        centres = np.unique(np.array([r.v for r in chosen]), axis=0)
        norms = (centres**2).sum(axis=1)

        def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """Batches so small that an array of their rows by the pivots stays within ARRAY_BYTES."""
            rows = max(1, ARRAY_BYTES // (8 * len(centres)))
            for part in parts:
                for at in range(0, len(part), rows):
                    yield part.iloc[at : at + rows]

        def assign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in cut(parts):
                x = matrix(part.v)
                cell = (norms[None, :] - 2 * (x @ centres.T)).argmin(axis=1) if len(x) else np.zeros(0, dtype=int)
                yield part.assign(cell=cell.astype("i4"), far=np.sqrt(((x - centres[cell]) ** 2).sum(axis=1)) if len(x) else np.zeros(0), norm=np.sqrt((x**2).sum(axis=1)))

        self.placed = staged(data.mapInPandas(assign, "id long, v array<double>, is_query boolean, cell int, far double, norm double"), "topk-cells")
        boxed = range(centres.shape[1] if centres.shape[1] <= MOST_BOXED else 0)
        ends = [F.array(*[f(F.col("v")[i]) for i in boxed]).cast("array<double>").alias(name) for name, f in (("low", F.min), ("high", F.max))]
        summary = self.placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius"), F.max("norm").alias("norm"), *ends)
        self.cells = Cells(centres, summary.orderBy("cell").collect(), block)
        counts = self.spark.createDataFrame(pd.DataFrame({"cell": self.cells.cell, "blocks": self.cells.blocks.astype("i4")}), "cell int, blocks int")
        self.rows = self.placed.select("id", "v", "cell").join(F.broadcast(counts), "cell").select("id", "v", "cell", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
        self.queries = self.placed.where("is_query").select("id", "v")
        cells = self.cells

        def first(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in cut(parts):
                if len(part):
                    yield cells.copies(part, np.arange(len(part)), cells.best(matrix(part.v)))

        def others(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in cut(parts):
                if len(part):
                    q = matrix(part.v)
                    reach = cells.upper(q) >= part.bound.to_numpy()[:, None]
                    reach[np.arange(len(part)), cells.best(q)] = False
                    yield cells.copies(part, *np.nonzero(reach))

        self.found_first = staged(self.solved(self.queries.mapInPandas(first, COPIES)), "topk-first")
        # The k-th best so far; a query with fewer results has no bound. Repeated ids of different vectors are one query each.
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        bounds = self.found_first.withColumn("place", place).where(F.col("place") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("bound"))
        several = self.queries.groupBy("id").count().where("count > 1").select("id")
        bounds = bounds.join(several, "id", "left_anti")
        asked = self.queries.join(bounds, "id", "left").na.fill({"bound": float("-inf")})
        self.replicas = asked.select("id", "v", "bound").mapInPandas(others, COPIES)

    def solved(self, queries: DataFrame) -> DataFrame:
        k = self.k

        def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
            query, vec, score = [], [], []
            if len(q) and len(x):
                ids, data_matrix = x.id.to_numpy(), matrix(x.v)
                for start in range(0, len(q), 256):
                    part = q.iloc[start : start + 256]
                    for own, scores in zip(part.id.to_numpy(), products(matrix(part.v), data_matrix), strict=True):
                        others = np.flatnonzero(ids != own)
                        at = others[best(scores[others], ids[others], k)]
                        query.append(np.full(len(at), own))
                        vec.append(ids[at])
                        score.append(scores[at])
            joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
            return pd.DataFrame({"query_id": joined(query), "vec_id": joined(vec), "score": joined(score)})

        return queries.groupBy("cell", "block").cogroup(self.rows.groupBy("cell", "block")).applyInPandas(solve, "query_id long, vec_id long, score long")


def search(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, pivots: int | None = None, block: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows of highest inner product of every query (all, if fewer), never the query's own row.

    is_query: a condition on the column `id`. pivots: how many rows, chosen by a hash, become pivots (the root of the number of rows, 64 at
    least, if not given). block: rows of a cell in one task, about. Out: query_id, rank from 1, vec_id, score. An empty table gives no rows.
    """
    join = VoronoiJoin(vectors, is_query, k, scale, pivots, block, id_col, vector_col)
    if join.empty:
        return vectors.sparkSession.createDataFrame([], OUT)
    found = join.found_first.unionByName(join.solved(join.replicas))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def replication(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, pivots: int | None = None, block: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """The share of all (query, cell) pairs that search() solves."""
    join = VoronoiJoin(vectors, is_query, k, scale, pivots, block, id_col, vector_col)
    if join.empty:
        return 0.0
    queries = join.queries.count()
    pairs = join.replicas.where("block = 0").count() + queries
    return pairs / max(1, queries * len(join.cells.cell))


#: DuckDB SQL for search() with the defaults and queries divisible by 50.
SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.e, d.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
