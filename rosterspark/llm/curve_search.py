"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected onto `dims` random orthogonal directions, shifted and cut into a grid; a Hilbert curve orders the grid's
cells. Several such orderings are made. Spark cuts each into ranges of keys that hold about `block` rows (quantiles of all rows' keys); a
query looks through the ranges beside its own key, a window of `window` of the curve's rows, all of them are reranked by
their distance in the original space, and the curves' results are merged.

Directions and the grid are fitted on a bounded sample (`sample` rows); every row is indexed. A window is a share of the rows, alike at every
size: of data without structure (nearest neighbours hardly nearer than others) the defaults look through two thirds of the rows for
a recall above 0.9; fewer curves or narrower windows do for clustered data.

Equal vectors are one entry, named by its smallest id, so a vector that fills a third of the table is one row of each curve. Distances are
sums of exactly rounded squares, so equal ones compare as equal and go by the smaller id, in every cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged
from .exact_topk import matrix, usable

OUT = "query_id long, rank int, vec_id long, score double"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of grid cells (rows of whole numbers below 2**bits); bits times columns stay below 63."""
    axes = list(cells.T.astype(np.int64))
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(len(axes)):
            turned = (axes[i] & bit) != 0
            swap = np.where(turned, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(turned, axes[0] ^ low, axes[0] ^ swap)
            axes[i] = axes[i] if i == 0 else axes[i] ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] >> level) & 1, (1 << level) - 1, 0)
    key = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for a in axes:
            key = key << 1 | ((a ^ flip) >> level & 1)
    return key


class Curves:
    """Directions, shifts and grid of every curve."""

    def __init__(self, sample: np.ndarray, curves: int, dims: int, bits: int, seed: int):
        random, width = np.random.default_rng(seed), sample.shape[1]
        self.bits, dims = bits, min(dims, width)
        self.parts = []
        for c in range(curves):
            if c % max(1, width // dims) == 0:
                turn = np.linalg.qr(random.normal(size=(width, width)))[0]
            at = c % max(1, width // dims) * dims
            axes = turn[:, at : at + dims]
            low, high = np.quantile(sample @ axes, [0.005, 0.995], axis=0)
            self.parts.append((axes, low, np.maximum(high - low, 1e-12), random.random(dims)))

    def keys(self, x: np.ndarray) -> np.ndarray:
        """A row of keys for each vector. The grid is half as wide again as the sample, so that the shift has room."""
        top = (1 << self.bits) - 1
        found = []
        for axes, low, span, shift in self.parts:
            grid = ((x @ axes - low) / span + shift / 2) / 1.5 * (top + 1)
            found.append(hilbert_keys(np.clip(grid, 0, top).astype(np.int64), self.bits))
        return np.stack(found, axis=1)


def smallest(df: DataFrame, by: str, k: int) -> DataFrame:
    """The k smallest ids of each value of `by`, found in 64 parts of each first."""
    first = F.row_number().over(Window.partitionBy(by, "part").orderBy("id"))
    second = F.row_number().over(Window.partitionBy(by).orderBy("id"))
    few = df.select(by, "id").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(64))).withColumn("r", first).where(F.col("r") <= k)
    return few.select(by, "id").withColumn("r", second).where(F.col("r") <= k).drop("r")


def nearest(points: np.ndarray, data: np.ndarray, names: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each point the k rows of smallest (distance, name): their places and distances."""
    far = (data**2).sum(axis=1)[None, :] - 2 * (points @ data.T)
    out = []
    for row, point in zip(far, points, strict=True):
        at = np.arange(len(row))
        if len(row) > k:
            # These distances are rounded: whatever may belong to the first k is measured again.
            edge = np.partition(row, k - 1)[k - 1]
            at = np.flatnonzero(row <= edge + 1e-11 * (1 + abs(edge) + (point**2).sum()))
        exact = np.sqrt([math.fsum(gaps) for gaps in ((data[at] - point) ** 2).tolist()])
        order = np.lexsort((names[at], exact))[:k]
        out.append((at[order], exact[order]))
    return out


def search(vectors: DataFrame, is_query: Column, k: int = 10, curves: int = 16, dims: int = 8, bits: int = 4, window: float = 0.075, sample: int = 8192, block: int = 2048, most_ranges: int = 4096, seed: int = 7, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest rows found for every query (all candidates, if fewer), never the query's own row.

    is_query: a condition on the column `id`. window: share of a curve's rows that a query looks through, about. block: rows of a range of
    keys, about, while a curve has at most most_ranges ranges. Out: query_id, rank from 1, vec_id, score (Euclidean distance in double
    precision on the original vectors), ties to the smaller id. Vectors that are null, zero, or hold null or non-finite components take no part, nor
    rows without an id or with another length than the most common. Repeated rows (same id, same vector) count once. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    single = isinstance(getattr(vectors.schema[vector_col].dataType, "elementType", None), T.FloatType)
    kind = "array<float>" if single else "array<double>"
    v = F.transform("v", lambda x: x + F.lit(0.0)).cast(kind)  # -0.0 reads as 0.0; floats stay floats
    rows = usable(vectors, id_col, vector_col).select("id", v.alias("v")).where(F.exists("v", lambda x: x != 0))
    entry = F.concat_ws("-", F.xxhash64("v"), F.xxhash64(F.lit("b"), "v"))
    data = staged(rows.withColumn("entry", entry).withColumn("is_query", is_query), "curve-rows")
    members = staged(smallest(data.select("entry", "id").distinct(), "entry", k + 1), "curve-members")
    # One entry for each vector, with its smallest id; queried tells whether a query has it.
    entries = staged(data.groupBy("entry").agg(F.min("id").alias("least"), F.max("is_query").alias("queried"), F.first("v").alias("v")), "curve-entries")
    chosen = entries.orderBy(F.xxhash64("entry"), "entry").limit(sample).select("v").toPandas()
    if not len(chosen):
        return spark.createDataFrame([], OUT)
    fitted = Curves(matrix(chosen.v), curves, dims, bits, seed)
    n = entries.count()
    # A range holds several times the rows that are asked for, so that small tables are searched whole.
    ranges = max(1, min(most_ranges, max(math.ceil(3 / window), math.ceil(n / block)), n // (4 * (k + 1))))
    reach = max(1, round((window * ranges - 1) / 2))

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                yield part.drop(columns="v").assign(entry=part.entry.astype(object), keys=list(fitted.keys(matrix(part.v))), v=part.v)

    placed = staged(entries.mapInPandas(place, f"entry string, least long, queried boolean, keys array<bigint>, v {kind}"), "curve-keys")
    cuts = F.percentile_approx("key", [i / ranges for i in range(1, ranges)] or [1.0], 10 * ranges)
    ends = placed.select(F.posexplode("keys").alias("curve", "key")).groupBy("curve").agg(cuts.alias("ends"))
    starts = {r.curve: np.array(r.ends)[: ranges - 1] for r in ends.collect()}  # `ranges` numbers a curve

    @F.pandas_udf("array<int>")
    def range_of(keys: pd.Series) -> pd.Series:
        rows = np.array(keys.tolist(), dtype=np.int64).reshape(len(keys), -1)
        return pd.Series(list(np.stack([np.searchsorted(starts[c], rows[:, c], side="left") for c in range(rows.shape[1])], axis=1).astype("i4")))

    on_curve = placed.select("entry", "least", "queried", "v", F.posexplode(range_of("keys")).alias("curve", "at"))
    # Ranges are crowded where very many vectors share a key; those are cut into blocks by a hash.
    sizes = staged(on_curve.groupBy("curve", "at").agg(F.ceil(F.count("*") / (2 * block)).cast("int").alias("blocks")), "curve-sizes")
    cut = F.broadcast(sizes)  # a row for each range
    held = on_curve.join(cut, ["curve", "at"]).select("entry", "least", "v", "curve", "at", F.pmod(F.xxhash64("entry"), F.col("blocks")).cast("int").alias("block"))
    window_of = F.explode(F.sequence(F.greatest(F.col("at") - reach, F.lit(0)), F.least(F.col("at") + reach, F.lit(ranges - 1))))
    looked = on_curve.where("queried").select("entry", "v", "curve", window_of.alias("at")).join(cut, ["curve", "at"])
    queries = looked.select(*[F.col(c).alias(c) for c in ("entry", "v", "curve", "at")], F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def rerank(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(q) and len(x):
            points, data_matrix, least, names = matrix(q.v), matrix(x.v), x.least.to_numpy(), x.entry.to_numpy(dtype=object)
            for start in range(0, len(q), 256):
                for own, (at, score) in zip(q.entry.to_numpy(dtype=object)[start : start + 256], nearest(points[start : start + 256], data_matrix, least, k + 1), strict=True):
                    found.append((np.full(len(at), own, dtype=object), names[at], least[at], score))
        query, entry, least, score = (np.concatenate(c) for c in zip(*found, strict=True)) if found else ([], [], [], [])
        return pd.DataFrame({"query": pd.Series(query, dtype=object), "entry": pd.Series(entry, dtype=object), "least": pd.Series(least, dtype="int64"), "score": pd.Series(score, dtype=float)})

    keys = ["curve", "at", "block"]
    found = queries.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(rerank, "query string, entry string, least long, score double")
    best = F.row_number().over(Window.partitionBy("query").orderBy("score", "least", "entry"))
    merged = found.groupBy("query", "entry").agg(F.min("score").alias("score"), F.first("least").alias("least")).withColumn("r", best).where(F.col("r") <= k + 1).drop("r", "least")
    asked = data.where("is_query").select(F.col("id").alias("query_id"), F.col("entry").alias("query")).distinct()
    # A vector that many queries share has at most k + 1 results, each with at most k + 1 ids.
    results = merged.join(members, "entry").join(asked, "query").where(F.col("query_id") != F.col("id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return results.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
