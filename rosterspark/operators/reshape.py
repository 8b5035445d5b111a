"""Matrices on a group's own axis, grids, cells and nested documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from .ordered import numbered


def axis(df: DataFrame, group: str, period: Column) -> DataFrame:
    """The sorted periods of each group."""
    return df.groupBy(group).agg(F.array_sort(F.collect_set(period)).alias("axis"))


def offering_matrix(df: DataFrame, group: str, item: str, period: Column, value: Column | None = None, position: str | None = None) -> DataFrame:
    """For each item a cell for every period of its group: struct(on, value), aligned with the group's axis.

    Of several values in one cell the first filled one by position counts (the least value without a position).
    """
    given = value if value is not None else F.lit(None).cast("string")
    filled = F.when(F.coalesce(given.cast("string"), F.lit("")) != "", given)
    order = F.col(position) if position else filled
    cells = df.groupBy(group, item, period.alias("period")).agg(F.min_by(filled, F.when(filled.isNotNull(), order)).alias("value"))
    items = cells.groupBy(group, item).agg(F.map_from_entries(F.collect_list(F.struct("period", "value"))).alias("cells"))
    out = items.join(axis(df, group, period), group)
    return out.select(group, item, "axis", F.transform("axis", lambda p: F.struct(F.map_contains_key("cells", p).alias("on"), F.element_at("cells", p).alias("value"))).alias("cells"))


def people_cells(df: DataFrame, group: str, item: str, period: Column, person: str) -> DataFrame:
    """For each item the sorted people of every period of its group, null where it isn't offered."""
    cells = df.groupBy(group, item, period.alias("period")).agg(F.array_sort(F.collect_set(person)).alias("people"))
    items = cells.groupBy(group, item).agg(F.map_from_entries(F.collect_list(F.struct("period", "people"))).alias("cells"))
    return items.join(axis(df, group, period), group).select(group, item, F.transform("axis", lambda p: F.element_at("cells", p)).alias("people"))


def unpivot_grid(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "day", value: str = "cell") -> DataFrame:
    """A row for each filled cell of a grid."""
    return df.unpivot(list(keys), list(columns), name, value).where(F.coalesce(F.col(value), F.lit("")) != "")


def transposed(df: DataFrame, table: str, row: str, cells: str, names: Sequence[str], times: str = "time") -> DataFrame:
    """A grid whose rows are days and whose columns are times as (table, name, label, cell) rows.

    The day stands in the first column; labels come from the table's row whose first cell says `times`. Columns without a label go, as do
    rows that are no day, and blank cells.
    """
    first = F.trim(F.get(F.col(cells), F.lit(0)))
    labels = df.where(F.lower(first) == times).groupBy(table).agg(F.min_by(F.col(cells), row).alias("labels__"))
    spread = df.where(first.isin(list(names))).join(labels, table).select(table, first.alias("name"), "labels__", F.posexplode(cells).alias("at__", "cell"))
    label = F.trim(F.coalesce(F.get("labels__", F.col("at__")), F.lit("")))
    return spread.where("at__ > 0").select(table, "name", label.alias("label"), F.trim("cell").alias("cell")).where((F.col("label") != "") & (F.col("cell") != ""))


def split_cell(df: DataFrame, cell: str, code: str = r"[A-Z]{2,4}\d{3}") -> DataFrame:
    """A cell that holds several items becomes a row for each, cut before every code."""
    return df.withColumn(cell, F.explode(F.filter(F.split(cell, rf"(?={code})"), lambda s: F.trim(s) != "")))


def columns_of(df: DataFrame, key: str, name: str, value: str, wanted: Sequence[str], position: str) -> DataFrame:
    """A table of names and values as columns; the first value of a name that isn't null counts, by position."""
    return df.groupBy(key).pivot(name, list(wanted)).agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.col(position))))


def legend(df: DataFrame, cell: str, position: str, code: str = K.LEGEND_CODE, ends: Sequence[str] = K.LEGEND_ENDS, entry: str = r"\(") -> DataFrame:
    """(code, title) pairs found in cells; the first title of a code wins.

    A title stands between its code and whatever begins first after it: one of `ends`, such as the next code, a time or a place. Cells that look like entries of the
    schedule itself (`entry`) are none of the key; nor is a code without a title, or one with a section in its place.
    """
    pair = rf"\b({code})\b:?\s*(.*?)\s*(?=(?:{'|'.join(ends)})|$)"
    text = F.regexp_replace(cell, r"\s+", " ")
    codes, titles = (F.regexp_extract_all(text, F.lit(pair), k) for k in (1, 2))
    found = df.where(~F.col(cell).rlike(entry)).select(position, F.posexplode(F.arrays_zip(codes.alias("code"), titles.alias("title"))).alias("nth", "pair__")).select(position, "nth", "pair__.code", F.trim("pair__.title").alias("title"))
    kept = found.where((F.col("title") != "") & ~F.substring_index("title", " ", 1).rlike(K.SECTION_CODE))
    return kept.groupBy("code").agg(F.min_by("title", F.struct(position, "nth")).alias("title"))


def nest(df: DataFrame, group: str, position: str, columns: Sequence[str], name: str) -> DataFrame:
    """The rows of each group as an array of structs, in order."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct(F.col(position).alias("at__"), *columns))), lambda s: F.struct(*[s[c].alias(c) for c in columns]))
    return df.groupBy(group).agg(rows.alias(name))


def nest_chunks(df: DataFrame, group: str, position: str, columns: Sequence[str], name: str, most: int = 10_000) -> DataFrame:
    """The rows of each group as arrays of at most so many structs, in order: group, chunk (from 0), first (the place of its first row), and the array.

    No row of the result, and no task, holds more of a group than a chunk, whatever its size.
    """
    rows = numbered(df.select(group, position, *[c for c in columns if c not in (group, position)]), [position, *[c for c in columns if c != position]], group, "place__")
    chunked = rows.withColumn("chunk", F.floor(F.col("place__") / most))
    items = F.transform(F.array_sort(F.collect_list(F.struct("place__", *columns))), lambda s: F.struct(*[s[c].alias(c) for c in columns]))
    return chunked.groupBy(group, "chunk").agg(F.min("place__").alias("first"), items.alias(name))


def chunk_manifest(chunks: DataFrame, group: str, name: str) -> DataFrame:
    """What puts chunks together: each group with its number of chunks and of rows."""
    return chunks.groupBy(group).agg(F.count("*").alias("chunks"), F.sum(F.size(name)).alias("rows"))


def unchunked(chunks: DataFrame, group: str, name: str) -> DataFrame:
    """The rows again, with their places in the group."""
    return chunks.select(group, "first", F.posexplode(name).alias("at__", "item__")).select(group, (F.col("first") + F.col("at__")).alias("place"), "item__.*")
