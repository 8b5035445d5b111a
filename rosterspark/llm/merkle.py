"""A Merkle manifest of a dataset by nested-interval labels.

Leaves are ranked inside their group; a node of a group's tree is known by its level and by the interval [lo, hi) of leaf ranks that it
covers. The levels are built bottom up, FAN nodes to a parent. Going down again, children meet their ancestors by joins on
(group, level, bucket of the interval's start) with containment of the intervals; what a parent's children cover outside a node's own interval
are its siblings, those before it and those after it. A node's path lists them level by level up to the root of all groups, so every leaf
gets its proof, and a leaf folded with it must give the root.

Ranks come from range partitions and the counts of those before, so no group of leaves passes through one task, whatever its
share of the rows; a level has an eighth of the rows of the one below it. Defined results: null fields are hashed as `-`; null groups are one
group, before all others; leaves with null ids come first in their group and are never tampered with; rows with equal ids stand in
the order of their leaves, so repeated rows are leaves of their own; columns other than the five hashed ones play no part; a table without
rows has no nodes and gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import released, staged

#: Children of a node.
FAN = 8
#: What a leaf hashes, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _field(c: Column) -> Column:
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(text: Column) -> Column:
    """The leaf of a row with this text."""
    return digest(*[_field(F.col(f)) for f in FIELDS[:-1]], _field(text))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, grp (the language), leaf, and tampered: the leaf of a row whose text was lower-cased, null where it wasn't tampered with."""
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return docs.select("doc_id", F.col("lang").alias("grp"), leaf_of(F.col("text")).alias("leaf"), F.when(touched, leaf_of(lower)).alias("tampered"))


def ranked(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """df (grp and others) with lo, each row's place in its group (from 0) by `order`, and size, the group's rows.

    Rows are dealt out by ranges of (grp, order) and numbered where they lie; the counts of (partition, group), of which there are as many as
    partitions and groups together, give the offsets. The numbers are written down once, so they hold whatever executors are lost later.
    """
    by = ["grp", *order]
    placed = staged(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()), label)
    runs = placed.groupBy(F.shiftright("at", 33).alias("part"), "grp").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    mine = Window.partitionBy("grp")
    runs = runs.select(
        F.col("part").alias("r_part"), F.col("grp").alias("r_grp"), "first", F.sum("n").over(mine).alias("size"),
        F.coalesce(F.sum("n").over(mine.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )
    same = (F.shiftright("at", 33) == F.col("r_part")) & F.col("grp").eqNullSafe(F.col("r_grp"))
    return placed.join(staged(runs, f"{label}-runs"), same).withColumn("lo", F.col("at") - F.col("first") + F.col("before")).drop("at", "r_part", "r_grp", "first", "before")


def _bucket(lo: Column, level: int) -> Column:
    """Which interval of a level the rank lo falls in: the key of the containment joins."""
    return F.shiftright(lo, 3 * level) if FAN == 8 else F.floor(lo / FAN**level)


def build(ranks: DataFrame, hash_column: str, label: str) -> list[DataFrame]:
    """The levels of the groups' trees above their leaves, lowest first: grp, size, lo, hi, hash, children array<struct<lo,hi,hash>>.

    A group has levels until one node covers it; a group of one leaf has none.
    """
    largest = ranks.agg(F.max("size")).first()[0] or 0
    below, levels = ranks.select("grp", "size", "lo", (F.col("lo") + 1).alias("hi"), F.col(hash_column).alias("hash")), []
    while FAN ** len(levels) < largest:
        level = len(levels) + 1
        more = below.where(F.col("size") > FAN ** (level - 1))
        runs = more.groupBy("grp", "size", _bucket(F.col("lo"), level).alias("bucket")).agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "hash"))).alias("children"))
        hashes = F.array_join(F.transform("children", lambda c: c["hash"]), "")
        nodes = runs.select("grp", "size", F.array_min("children")["lo"].alias("lo"), F.array_max("children")["hi"].alias("hi"), digest(hashes).alias("hash"), "children")
        levels.append(staged(nodes, f"{label}-{level}"))
        below = levels[-1].drop("children")
    return levels


def tops(ranks: DataFrame, hash_column: str, levels: Sequence[DataFrame]) -> DataFrame:
    """The root of each group's tree: grp, hash."""
    alone = ranks.where("size = 1").select("grp", F.col(hash_column).alias("hash"))
    return reduce(DataFrame.unionByName, [level.where("hi - lo = size").select("grp", "hash") for level in levels], alone)


def _attached(children: DataFrame, parents: DataFrame, level: int, carried: Sequence[str]) -> DataFrame:
    """Children (grp, lo, hi and others) with the parent of the given level that contains them: its children as `kin`, its path as `above`, and what it carries."""
    p = parents.select(F.col("grp").alias("p_grp"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), F.col("children").alias("kin"), F.col("path").alias("above"), *carried)
    contained = F.col("grp").eqNullSafe(F.col("p_grp")) & (_bucket(F.col("lo"), level) == _bucket(F.col("p_lo"), level)) & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
    return children.join(p, contained).drop("p_grp", "p_lo", "p_hi")


def _step(lo: Column, hi: Column, kin: Column) -> Column:
    """The siblings of [lo, hi): what is left of the parent's interval before it and after it, as joined hashes."""
    joined = lambda keep: F.array_join(F.transform(F.filter(kin, keep), lambda c: c["hash"]), "")
    return F.array(F.struct(joined(lambda c: c["hi"] <= lo).alias("before"), joined(lambda c: c["lo"] >= hi).alias("after")))


def paths(ranks: DataFrame, levels: Sequence[DataFrame], upper: DataFrame | None = None) -> DataFrame:
    """ranks with path: array<struct<before,after>> of siblings' hashes, from each leaf's level up to its group's root.

    If `upper` (grp, path, others) is given, paths go on along its own, and its other columns come down with them: only a group's root is joined by the group alone.
    """
    start = F.array().cast("array<struct<before:string,after:string>>")
    carried = [c for c in upper.columns if c not in ("grp", "path")] if upper is not None else []
    above = None
    for level in range(len(levels), -1, -1):
        nodes = levels[level - 1] if level else ranks.withColumn("hi", F.col("lo") + 1)
        is_top = F.col("hi") - F.col("lo") == F.col("size")
        if upper is None:
            found = nodes.where(is_top).withColumn("path", start)
        else:
            found = nodes.where(is_top).join(upper.withColumnRenamed("grp", "u_grp"), F.col("grp").eqNullSafe(F.col("u_grp"))).drop("u_grp")
        if above is not None:
            inner = _attached(nodes.where(~is_top), above, level + 1, carried)
            found = found.unionByName(inner.withColumn("path", F.concat(_step(F.col("lo"), F.col("hi"), F.col("kin")), F.col("above"))).drop("kin", "above"))
        above = found
    return above.drop("hi")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings along its path."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["before"], h, s["after"]))


def manifest(docs: DataFrame) -> DataFrame:
    """Each row's leaf with the tree around it: doc_id, grp, leaf, tampered, path, subroot, root."""
    cut = staged(leaves(docs), "merkle-leaves")
    ranks = ranked(cut, ["doc_id", "leaf"], "merkle-ranks")
    levels = build(ranks, "leaf", "merkle-level")
    released(cut)
    # The groups' roots are the leaves of one more tree.
    subroots = ranked(tops(ranks, "leaf", levels).select(F.lit(True).alias("grp"), F.col("grp").alias("name"), F.col("hash").alias("subroot")), ["name"], "merkle-groups")
    high = build(subroots, "subroot", "merkle-upper")
    root = tops(subroots, "subroot", high).select("hash").scalar()
    # One row for each group, read once for each level below.
    upper = staged(paths(subroots, high).select(F.col("name").alias("grp"), "path", "subroot", root.alias("root")), "merkle-roots")
    return paths(ranks, levels, upper).select("doc_id", "grp", "leaf", "tampered", "path", "subroot", "root")


def verified(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 (over all siblings of the path), folded_root (from the tampered leaf, else the own one) and verified."""
    proof = digest(F.array_join(F.flatten(F.transform("path", lambda s: F.array(s["before"], s["after"]))), ""))
    out = manifest(docs).select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_OTHERS = " || ".join(_FIELD.format(f) for f in FIELDS[:-1])
SQL = f"""
WITH RECURSIVE
crc_table AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(0, 256)) AS i))),
ids AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0 AS touched
        FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc_table),
cut AS (SELECT doc_id, lang, sha256({_OTHERS} || {_FIELD.format("text")}) AS leaf, CASE WHEN touched THEN sha256({_OTHERS} || {_FIELD.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) ELSE sha256({_OTHERS} || {_FIELD.format("text")}) END AS given
        FROM documents LEFT JOIN ids USING (doc_id)),
ranks AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM cut),
nodes AS (SELECT lang, 0 AS level, i, n, leaf AS h FROM ranks
  UNION ALL SELECT lang, any_value(level) + 1, i // {FAN}, any_value((n + {FAN - 1}) // {FAN}), sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY lang, i // {FAN}),
subroots AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper AS (SELECT 0 AS level, g AS i, n, subroot AS h FROM subroots
  UNION ALL SELECT any_value(level) + 1, i // {FAN}, any_value((n + {FAN - 1}) // {FAN}), sha256(string_agg(h, '' ORDER BY i)) FROM upper WHERE n > 1 GROUP BY i // {FAN}),
root AS (SELECT h AS root FROM upper WHERE n = 1),
kin AS (SELECT lang, level, i // {FAN} AS p, list(h ORDER BY i) AS hs, any_value(n) AS n FROM nodes GROUP BY lang, level, i // {FAN}),
upper_kin AS (SELECT level, i // {FAN} AS p, list(h ORDER BY i) AS hs, any_value(n) AS n FROM upper GROUP BY level, i // {FAN}),
low AS (SELECT row_number() OVER () AS rid, doc_id, lang, leaf, i, 0 AS level, given AS acc, '' AS proof FROM ranks
  UNION ALL SELECT rid, doc_id, w.lang, leaf, w.i // {FAN}, w.level + 1, sha256(array_to_string(hs[:w.i % {FAN}], '') || acc || array_to_string(hs[w.i % {FAN} + 2:], '')), proof || array_to_string(hs[:w.i % {FAN}], '') || array_to_string(hs[w.i % {FAN} + 2:], '')
  FROM low w JOIN kin ON kin.lang IS NOT DISTINCT FROM w.lang AND kin.level = w.level AND kin.p = w.i // {FAN} WHERE kin.n > 1),
ends AS (SELECT * FROM low QUALIFY level = max(level) OVER (PARTITION BY rid)),
high AS (SELECT rid, doc_id, leaf, subroot, g AS i, 0 AS level, acc, proof FROM ends JOIN subroots s ON s.lang IS NOT DISTINCT FROM ends.lang
  UNION ALL SELECT rid, doc_id, leaf, subroot, w.i // {FAN}, w.level + 1, sha256(array_to_string(hs[:w.i % {FAN}], '') || acc || array_to_string(hs[w.i % {FAN} + 2:], '')), proof || array_to_string(hs[:w.i % {FAN}], '') || array_to_string(hs[w.i % {FAN} + 2:], '')
  FROM high w JOIN upper_kin k ON k.level = w.level AND k.p = w.i // {FAN} WHERE k.n > 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root AS verified
FROM (SELECT * FROM high QUALIFY level = max(level) OVER (PARTITION BY rid)), root
"""
