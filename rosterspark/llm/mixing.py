"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Each source gets a share of the mix by its weight, but at most `max_epochs` times its own size; what a capped source leaves is
shared again by weight among the others until none exceeds its cap. In order of cap over weight, a source is capped while its
cap doesn't exceed its share of what the sources before it leave, so one running sum over the sources (a row each) finds
the level that all others reach.

Within a source every document is taken whole as often as the target holds the source whole; for the rest, documents are
taken once more in the order of a seeded hash up to the missing size (the document that straddles it goes in if more than
half of it fits). The hash is cut into bins, bins are summed first, and only the bin at the edge is put in order, so
no task ever orders a source.

Weights go to the sources by code point (null last), repeating. A null text has size 0. A source without words has target 0.
Repeated rows are rows of their own; null ids hash alike and are ordered by size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, staged

#: Hash digits (base 16) of a bin: 4,096 bins a source.
BIN_DIGITS = 3


def sizes(docs: DataFrame, seed: str, keep: bool = False) -> DataFrame:
    """doc_id, source (keep: all columns), size in words and place (the hash that orders a source)."""
    place = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return docs.select("*" if keep else "doc_id", *([] if keep else ["source"]), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), place.alias("place"))


def targets(sized: DataFrame, weights: Sequence[float], total_share: float, max_epochs: float) -> DataFrame:
    """Of each source its source_size, target, whole repetitions and the words missing to the target."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row a source: these windows order the sources, never the documents.
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    level = (
        sources.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("mix", F.sum("source_size").over(everything) * F.lit(float(total_share)))
        .withColumn("before", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("capped", F.col("cap") * F.col("rest") <= F.col("weight") * (F.col("mix") - F.col("before")))
        .withColumn("filled", F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0.0)))
        .withColumn("open", F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything))
    )
    target = F.when(F.col("capped"), F.col("cap")).otherwise((F.col("mix") - F.col("filled")) / F.col("open") * F.col("weight"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    return level.withColumn("target", target).withColumn("whole", whole).withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size")).select("source", "source_size", "target", "whole", "missing")


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), total_share: float = 1.5, max_epochs: float = 2, seed: str = "mix", keep: bool = False) -> DataFrame:
    """How often the mix takes each document.

    total_share: size of the mix over the size of all documents. Out: doc_id, source, size long, source_size long, target
    double (of the source), copies long (repetitions of the document), taken long (copies times size). One row out for each
    row in; an empty table gives none. keep: all columns of docs come along; those that clash with the others give way.
    """
    own = ("size", "place", "source_size", "target", "whole", "missing", "edge", "of", "bin", "more", "copies", "taken")
    docs = docs.drop(*own)
    sized = staged(sizes(docs, seed), "mix-sizes")
    wanted = staged(targets(sized, weights, total_share, max_epochs), "mix-targets")
    digits = F.substring("place", 1, BIN_DIGITS)
    bins = sized.groupBy("source", digits.alias("bin")).agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("bin"))
    reached = bins.withColumn("upto", upto).alias("b").join(wanted.alias("w"), F.col("b.source").eqNullSafe(F.col("w.source")))
    # The edge is the last bin that begins below what is missing.
    edge = reached.where(F.col("upto") - F.col("n") < F.col("missing")).groupBy(F.col("b.source").alias("edge_source")).agg(F.max(F.struct("bin", (F.col("upto") - F.col("n")).alias("before"))).alias("edge"))
    plan = staged(wanted.join(edge, F.col("source").eqNullSafe(F.col("edge_source")), "left").drop("edge_source"), "mix-plan").withColumnRenamed("source", "of")
    rows = sizes(docs, seed, keep=True) if keep else sized
    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("of")), "left").withColumn("bin", digits)
    at_edge = placed.where(F.col("bin") == F.col("edge.bin"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ordered = at_edge.withColumn("more", (F.col("edge.before") + before + F.col("size") / 2 <= F.col("missing")).cast("long"))
    others = placed.where(~F.coalesce(F.col("bin") == F.col("edge.bin"), F.lit(False))).withColumn("more", F.coalesce(F.col("bin") < F.col("edge.bin"), F.lit(False)).cast("long"))
    taken = ordered.unionByName(others).withColumn("copies", F.col("whole") + F.col("more"))
    return taken.select(*(docs.columns if keep else ["doc_id", "source"]), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


#: DuckDB SQL for mix() with the defaults: the iteration is unrolled by the same running sums over the sources.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS place FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         source_size * 2.0::DOUBLE AS cap, (sum(source_size) OVER ()) * 1.5::DOUBLE AS mix FROM sources),
levels AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS before,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM weighed),
marked AS (SELECT *, cap * rest <= weight * (mix - before) AS capped FROM levels),
filled AS (
  SELECT *, coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0.0::DOUBLE) AS filled, sum(CASE WHEN NOT capped THEN weight END) OVER () AS open FROM marked),
goal AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE (mix - filled) / open * weight END AS target FROM filled),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM goal),
placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS missing,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id NULLS FIRST, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN before + size / 2 <= missing AND missing > 0 THEN 1 ELSE 0 END))::BIGINT AS taken FROM placed
"""
