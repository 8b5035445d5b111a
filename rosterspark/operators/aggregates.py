"""Grouping, deduplication with survivorship, roll-ups and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K


def dedup_best(df: DataFrame, key: Column, order: Sequence[Column], merge: str | None = None, count: str | None = None) -> DataFrame:
    """One row for each key, the first by `order`; `merge`: an array column whose items are united over the group, sorted; `count`: how many rows the key has."""
    more = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(merge)))).alias("merged__")] if merge else []
    best = df.withColumn("key__", key).groupBy("key__").agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("row"), *more, *([F.count("*").alias(count)] if count else []))
    kept = [F.col("merged__").alias(c) if c == merge else F.col(f"row.{c}").alias(c) for c in df.columns]
    return best.select(*kept, *([count] if count else []))


def dominant(df: DataFrame, key: str, value: str, position: str) -> DataFrame:
    """The most frequent value of each key, the first seen on ties, with its count."""
    counted = df.groupBy(key, value).agg(F.count("*").alias("n"), F.min(position).alias("first"))
    return counted.groupBy(key).agg(F.max_by(F.struct(value, "n"), F.struct("n", -F.col("first"))).alias("best")).select(key, f"best.{value}", "best.n")


def latest(df: DataFrame, key: str, value: str, order: Sequence[Column], position: str, where: Column | None = None) -> DataFrame:
    """The value of the greatest order among rows that meet the condition, the first on ties."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(key).agg(F.max_by(value, F.struct(*order, -F.col(position))).alias(value))


def totals(df: DataFrame, key: str, trusted: Column, amount: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("members"), F.count_if(trusted).alias("trusted"), F.sum(amount).alias("total"))


def facet_counts(df: DataFrame, tags: str, group: str) -> DataFrame:
    """Of each tag the rows and the groups that have it."""
    return df.select(group, F.explode(tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("members"), F.count_distinct(group).alias("groups"))


def frequent_lines(lines: DataFrame, group: str, page: str, line: str, share: float = 0.4, least_pages: int = 5, least_length: int = 3) -> DataFrame:
    """Lines that stand on many of a group's pages: at least max(2, floor(share * pages)), in groups of least_pages or more."""
    sizes = lines.groupBy(group).agg(F.count_distinct(page).alias("pages")).where(F.col("pages") >= least_pages)
    counts = lines.select(group, page, F.trim(line).alias(line)).where(F.length(line) >= least_length).distinct().groupBy(group, line).agg(F.count("*").alias("df"))
    return counts.join(sizes, group).where(F.col("df") >= F.greatest(F.lit(2), F.floor(F.col("pages") * F.lit(share))))


def drop_frequent_lines(lines: DataFrame, group: str, page: str, line: str, **options: float) -> DataFrame:
    found = frequent_lines(lines, group, page, line, **options).select(group, F.col(line).alias("frequent__"))
    return lines.join(found.withColumnRenamed(group, "group__"), (F.col(group) == F.col("group__")) & (F.trim(line) == F.col("frequent__")), "left_anti")


def largest_groups(df: DataFrame, parent: str, group: str, least: int = 2) -> DataFrame:
    """The largest group or groups of each parent, all of equal size."""
    sizes = df.groupBy(parent, group).agg(F.count("*").alias("n"))
    return sizes.withColumn("r", F.rank().over(Window.partitionBy(parent).orderBy(F.desc("n")))).where((F.col("r") == 1) & (F.col("n") >= least)).drop("r")


def best_entry_keys(df: DataFrame, acronym: str, title: str, order: Sequence[Column]) -> DataFrame:
    """The best entry of an acronym keeps it as its key; the others get "ACRONYM (Title)"."""
    n = F.row_number().over(Window.partitionBy(acronym).orderBy(*order))
    return df.withColumn("key", F.when(n == 1, F.col(acronym)).otherwise(F.concat(F.col(acronym), F.lit(" ("), F.col(title), F.lit(")"))))


def with_fillers(main: DataFrame, fillers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Curated rows only for keys that the main table lacks."""
    return main.unionByName(fillers.join(main.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def collapse_rows(df: DataFrame, key: Sequence[str], position: str, first: Sequence[str], united: Sequence[str], longest: Sequence[str]) -> DataFrame:
    """One row for each key: the first scalar by position, the distinct values in order, the longest text."""
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct(position, c))), lambda s: s[c])
    return df.groupBy(*key).agg(
        *[F.min_by(c, position).alias(c) for c in first],
        *[F.array_distinct(F.filter(ordered(c), lambda x: F.coalesce(x, F.lit("")) != "")).alias(c) for c in united],
        *[F.max_by(c, F.struct(F.length(c), -F.col(position))).alias(c) for c in longest],
    )


def merge_meetings(slots: DataFrame, key: Sequence[str], position: str, days: str = "days", time: str = "time", location: str = "location", week: str = "MTWRFSU") -> DataFrame:
    """Slots of one time and place become one with the union of days in the order of the week; slots are joined by "; " as first seen."""
    letters = F.array_distinct(F.flatten(F.collect_list(F.split(days, ""))))
    one = slots.groupBy(*key, time, location).agg(F.min(position).alias("p"), F.array_join(F.filter(F.array(*[F.lit(d) for d in week]), lambda d: F.array_contains(letters, d)), "").alias(days))
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    text = F.concat_ws(" ", filled(days), filled(time), F.concat(F.lit("("), filled(location), F.lit(")")))
    return one.withColumn("text", text).groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "text"))), lambda s: s["text"]), "; ").alias("meetings"))


def distinct_keys(df: DataFrame, key: Column) -> DataFrame:
    """Number of distinct keys; each blank key counts on its own."""
    return df.agg((F.count_distinct(F.nullif(key, F.lit(""))) + F.count_if(F.coalesce(key, F.lit("")) == "")).alias("n"))


def prune_singletons(df: DataFrame, group: str, code: str, year: str, cutoff: Column, term: str | None = None) -> DataFrame:
    """Codes offered in a single period (year and term) before the cutoff go, as do codes that are another's with one more L (labs)."""
    period = F.struct(*[c for c in (year, term) if c])
    stats = df.groupBy(group, code).agg(F.count_distinct(period).alias("periods"), F.max(year).alias("last"))
    kept = stats.where(~((F.col("periods") == 1) & (F.col("last") < cutoff))).select(group, code)
    bases = df.select(F.col(group).alias("base_group"), F.concat(F.col(code), F.lit("L")).alias("base")).distinct()
    return df.join(kept, [group, code], "left_semi").join(bases, (F.col(group) == F.col("base_group")) & (F.col(code) == F.col("base")), "left_anti")


def best_by_key(df: DataFrame, keys: Sequence[str], value: str, position: str, order: Sequence[str] = K.QUARTILE_ORDER) -> DataFrame:
    """The row of each key whose value comes first in `order` (a journal's best quartile), the first by position on ties; values that aren't listed come last."""
    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.coalesce(F.col(value), F.lit("")))
    return df.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct(F.when(place > 0, place).otherwise(len(order) + 1), position)).alias("row")).select(*keys, "row.*")


def url_mode(df: DataFrame, group: str, code: str, url: str) -> DataFrame:
    """per term if some code of the group has two links, none if the whole group has at most one, else per code."""
    per_code = df.groupBy(group, code).agg(F.count_distinct(F.nullif(url, F.lit(""))).alias("n"))
    whole = df.groupBy(group).agg(F.count_distinct(F.nullif(url, F.lit(""))).alias("all"))
    return per_code.groupBy(group).agg(F.max("n").alias("most")).join(whole, group).select(group, F.when(F.col("most") >= 2, "per term").when(F.col("all") <= 1, "none").otherwise("per code").alias("mode"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return df.withColumn("n__", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("n__ = 1").drop("n__")


def mark_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return df.withColumn("repeated", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) > 1)


def candidate_scores(items: DataFrame, page: str, candidate: str, place: str) -> DataFrame:
    """How well each candidate of a page finds people, from what it finds: items of page, candidate, place (which candidate comes first), name, titled, link.

    An item is valid with a name and a title. The score, compared from left to right: different names, the share of valid items with a link in tenths (to the nearest, half to
    even), minus repeated names, minus items that aren't valid, minus all items.
    """
    good = F.col("name").isNotNull() & F.coalesce("titled", F.lit(False))
    seen = items.groupBy(page, candidate).agg(
        F.min(place).alias(place), F.count("*").alias("size"), F.count_if(good).alias("valid"), F.count_distinct(F.when(good, F.col("name"))).alias("unique"), F.count_if(good & F.col("link").isNotNull()).alias("linked"),
    )
    tenths = F.when(F.col("valid") > 0, F.bround(F.col("linked") / F.col("valid") * 10).cast("int")).otherwise(0)
    score = F.struct(F.col("unique"), tenths.alias("tenths"), (F.col("unique") - F.col("valid")).alias("repeats"), (F.col("valid") - F.col("size")).alias("wasted"), (-F.col("size")).alias("small"))
    return seen.select(page, candidate, place, score.alias("score"))


def best_scored(items: DataFrame, page: str, candidate: str, place: str) -> DataFrame:
    """The candidate of greatest score of each page, the first of equal ones; pages whose best finds less than two people, or one without a link, have none."""
    scored = candidate_scores(items, page, candidate, place)
    enough = (F.col("score.unique") > 1) | ((F.col("score.unique") == 1) & (F.col("score.tenths") > 0))
    return scored.where(enough).groupBy(page).agg(F.max_by(F.struct(candidate, "score"), F.struct("score", -F.col(place))).alias("best")).select(page, f"best.{candidate}", "best.score")


def best_candidate(df: DataFrame, page: str, candidate: str, score: Sequence[Column]) -> DataFrame:
    """Of each page the candidate of greatest score, the first by name on ties."""
    return keep_first(df, [page], [*[s.desc() for s in score], candidate])


def citation_metrics(works: DataFrame, person: str, cites: str, year: str, recent_from: int) -> DataFrame:
    """Total citations, h-index and i10-index of each person, also over the years from recent_from on."""
    rank = F.row_number().over(Window.partitionBy(person).orderBy(F.desc(cites)))
    metrics = lambda df, end: df.withColumn("r", rank).groupBy(person).agg(F.sum(cites).alias(f"cited{end}"), F.count_if(F.col(cites) >= F.col("r")).alias(f"h{end}"), F.count_if(F.col(cites) >= 10).alias(f"i10{end}"))
    return metrics(works, "").join(metrics(works.where(F.col(year) >= recent_from), "_recent"), person, "left").na.fill(0)


def by_year(df: DataFrame, key: str, year: str, amount: str) -> DataFrame:
    """A map from year to sum for each key."""
    return df.groupBy(key, year).agg(F.sum(amount).alias("n")).groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(year, "n")))).alias("by_year"))


def coverage(df: DataFrame, *by: str, **counts: Column) -> DataFrame:
    """The number of rows and of those that meet each condition, for all rows or for each value of the columns `by`."""
    return df.groupBy(*by).agg(F.count("*").alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()])
