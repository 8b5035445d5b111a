"""Operators on rows in order. What a row needs to know of those before it comes in two steps: within blocks of a document's rows, and from block to block."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import staged


#: Rows of a document that are one group of a window.
BLOCK = 100_000


def last_seen(df: DataFrame, doc: str, pos: str, block: int = BLOCK, **values: Column) -> DataFrame:
    """df with, for each name, the last value that isn't null up to each row of its document.

    Rows are windowed by (document, block of positions), so a document of any length is many tasks; the last values of blocks, one row for each, are handed on
    from block to block by a window of their own. Positions are whole numbers, each once in a document.
    """
    inside = Window.partitionBy(doc, "block__").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("block__", F.floor(F.col(pos) / block)).withColumns({f"{n}__own": F.last(v, ignorenulls=True).over(inside) for n, v in values.items()})
    ends = rows.groupBy(doc, "block__").agg(*[F.max_by(f"{n}__own", pos).alias(f"{n}__end") for n in values])
    before = Window.partitionBy(doc).orderBy("block__").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(F.col(doc).alias("doc__"), F.col("block__").alias("of__"), *[F.last(f"{n}__end", ignorenulls=True).over(before).alias(f"{n}__in") for n in values])
    joined = rows.join(handed, F.col(doc).eqNullSafe(F.col("doc__")) & (F.col("block__") == F.col("of__")), "left")
    return joined.select(*df.columns, *[F.coalesce(f"{n}__own", f"{n}__in").alias(n) for n in values])


def carry_forward(df: DataFrame, doc: str, pos: str, is_heading: Column, block: int = BLOCK, **values: Column) -> DataFrame:
    """Each row gets the values of the last heading up to it; a heading whose value is null blanks the context."""
    held = last_seen(df, doc, pos, block, held__=F.when(is_heading, F.struct(*[v.alias(n) for n, v in values.items()])))
    return held.select("*", *[F.col(f"held__.{n}").alias(n) for n in values]).drop("held__")


def section(df: DataFrame, doc: str, pos: str, starts: Column, stops: Column, block: int = BLOCK) -> DataFrame:
    """Rows after a start up to the next stop; marker rows are left out."""
    seen = last_seen(df, doc, pos, block, start__=F.when(starts, F.col(pos)), stop__=F.when(stops, F.col(pos)))
    inside = F.col("start__").isNotNull() & (F.col("stop__").isNull() | (F.col("start__") > F.col("stop__")))
    return seen.where(inside & ~starts & ~stops).drop("start__", "stop__")


def fold_continuations(df: DataFrame, doc: str, pos: str, is_head: Column, text: str, joiner: str = "; ", block: int = BLOCK) -> DataFrame:
    """Follow-on rows join the head row before them, repeats left out; rows before any head go. A head's text, with all that follows it, is one row of the result."""
    seen = last_seen(df, doc, pos, block, head=F.when(is_head, F.col(pos))).where(F.col("head").isNotNull())
    # A repeat counts once, at its first place, before the parts meet.
    once = seen.groupBy(doc, "head", text).agg(F.min(pos).alias("at__"), F.count("*").alias("n__"))
    parts = F.transform(F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct("at__", text)))), lambda s: s[text])
    return once.groupBy(doc, "head").agg(F.array_join(parts, joiner).alias(text), F.sum("n__").alias("rows"))


def numbered(df: DataFrame, order: Sequence[str], within: str | None = None, place: str = "place") -> DataFrame:
    """df with each row's place (from 0) in the order of some columns, over all rows or within groups, without a window over them.

    Rows are dealt out by ranges and numbered where they lie, and that is written down; the counts of the partitions (and groups) before give what is
    added, as many rows as there are partitions and groups. Rows that are equal in all those columns have places next to each other, in any order.
    """
    by, groups = [*([within] if within else []), *order], [within] if within else []
    placed = staged(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at__", F.monotonically_increasing_id()), "places")
    runs = placed.groupBy(F.shiftright("at__", 33).alias("part__"), *groups).agg(F.min("at__").alias("first__"), F.count("*").alias("n__"))
    before = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)
    runs = staged(runs.select("part__", *[F.col(g).alias("within__") for g in groups], "first__", F.coalesce(F.sum("n__").over(before), F.lit(0)).alias("before__")), "places-before")
    same = F.shiftright("at__", 33) == F.col("part__")
    joined = placed.join(runs, same & F.col(within).eqNullSafe(F.col("within__")) if within else same)
    return joined.select(*df.columns, (F.col("at__") - F.col("first__") + F.col("before__")).alias(place))


def page(df: DataFrame, order: Sequence[str], number: int, size: int = 20) -> DataFrame:
    """One page (from 0) of a table in an order, wherever it lies, with the rows' places."""
    return numbered(df, order).where(F.col("place").between(number * size, number * size + size - 1))


def near_hits(df: DataFrame, doc: str, pos: str, hit: Column, reach: int = 30) -> DataFrame:
    """Rows within `reach` rows from (and with) a hit on; whole documents without any hit stay."""
    w = Window.partitionBy(doc).orderBy(pos).rowsBetween(-(reach - 1), 0)
    near = F.max(F.when(hit, 1)).over(w).isNotNull()
    none = F.max(F.when(hit, 1)).over(Window.partitionBy(doc)).isNull()
    return df.withColumn("keep__", near | none).where("keep__").drop("keep__")


def first_per_key(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    return df.withColumn("n__", F.row_number().over(Window.partitionBy(*keys).orderBy(pos))).where("n__ = 1").drop("n__")


def latest_periods(df: DataFrame, group: str, period: str, n: int = 4, offset: int = 0) -> DataFrame:
    """Rows of n periods of each group, counted back from its latest; the offset is clamped so that n remain if there are n."""
    periods = df.select(group, period).distinct()
    total = F.count("*").over(Window.partitionBy(group))
    r = F.dense_rank().over(Window.partitionBy(group).orderBy(F.desc(period)))
    start = F.least(F.lit(offset), F.greatest(F.col("total") - n, F.lit(0)))
    page = periods.withColumn("r", r).withColumn("total", total).where((F.col("r") > start) & (F.col("r") <= start + n))
    return df.join(page.select(group, period), [group, period], "left_semi")


def default_range(df: DataFrame, year: str, least: int = 1990, span: int = 10) -> DataFrame:
    """Rows of the last `span` years before the latest, of the years from `least` on."""
    top = df.where(F.col(year) >= least).agg(F.max(year).alias("top__"))
    return df.join(F.broadcast(top), F.col(year).between(F.col("top__") - span, F.col("top__"))).drop("top__")


def active_in_latest(df: DataFrame, group: str, year: str, item: str) -> DataFrame:
    top = F.max(year).over(Window.partitionBy(group))
    return df.withColumn("top__", top).where(F.col(year) == F.col("top__")).groupBy(group).agg(F.count_distinct(item).alias("n"))


def stable_sort(df: DataFrame, *keys: Column) -> DataFrame:
    return df.orderBy(*keys)


def sort_table(df: DataFrame, column: str, descending: bool = True, tie: str | None = None) -> DataFrame:
    """Rows by a column: numbers with missing ones as -1, texts without regard to case; ties by another column."""
    numeric = dict(df.dtypes)[column] not in ("string", "boolean")
    key = F.coalesce(F.col(column), F.lit(-1)) if numeric else F.lower(F.coalesce(F.col(column), F.lit("")))
    return df.orderBy(key.desc() if descending else key.asc(), *([tie] if tie else []))
