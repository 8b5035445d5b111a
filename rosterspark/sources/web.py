"""Text, cells, fixed-width lines and word boxes of pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse, first_of_each, plain_text
from .markup import row_lists, visible_text  # noqa: F401  what a page shows belongs to this module's readers too



def cells(df: DataFrame, page: str, html: str, pattern: str = r"(?is)<t[dh][^>]*>(.*?)</t[dh]>") -> DataFrame:
    """page, pos, cell: the pieces that the pattern's group finds, as text."""
    return df.select(page, F.posexplode(F.regexp_extract_all(html, F.lit(pattern), 1)).alias("pos", "cell")).withColumn("cell", plain_text(F.col("cell")))


def table_rows(df: DataFrame, page: str, html: str, least: int = 1) -> DataFrame:
    """page, pos, cells: rows of tables, nested ones too, with at least so many cells of their own."""
    return df.select(page, F.posexplode(row_lists(F.col(html))).alias("pos", "cells")).where(F.size("cells") >= least)


def metrics(df: DataFrame, page: str, html: str) -> DataFrame:
    """Labelled metrics (label, all, recent) of a profile page as one map for each page; of repeated labels the first counts."""
    rows = table_rows(df, page, html, 3)
    entry = F.struct("pos", F.lower(F.col("cells")[0]).alias("key"), F.struct(F.col("cells")[1].try_cast("int").alias("all"), F.col("cells")[2].try_cast("int").alias("recent")).alias("value"))
    return rows.groupBy(page).agg(first_of_each(F.array_sort(F.collect_list(entry))).alias("metrics"))


def fixed_width(lines: DataFrame, doc: str, pos: str, line: str, names: Sequence[str]) -> DataFrame:
    """Columns cut where the runs of the document's ruler line (----) begin; rows up to the ruler go."""
    ruler = lines.where(F.col(line).rlike(r"^\s*-{2,}(\s+-{2,})+\s*$")).groupBy(doc).agg(F.min_by(line, pos).alias("ruler"), F.min(pos).alias("ruler_pos"))
    at = F.filter(F.sequence(F.lit(1), F.length("ruler")), lambda i: (F.substring("ruler", i, F.lit(1)) == "-") & ((i == 1) | (F.substring("ruler", i - 1, F.lit(1)) != "-")))
    rows = lines.join(ruler, doc).where((F.col(pos) > F.col("ruler_pos")) & (F.trim(line) != "")).withColumn("at", at)
    cut = lambda k: F.trim(F.when(F.size("at") > k + 1, F.substring(line, F.col("at")[k], F.col("at")[k + 1] - F.col("at")[k])).otherwise(F.substring(line, F.col("at")[k], F.length(line))))
    return rows.select(doc, pos, *[F.coalesce(F.when(F.size("at") > k, cut(k)), F.lit("")).alias(n) for k, n in enumerate(names)])


def repeated_headers(lines: DataFrame, doc: str, pos: str, cells: str, is_header: Column) -> DataFrame:
    """Delimited rows under headers that repeat: each row as a map from the last header's names (the first cell of a repeated name counts); blank rows end a header."""
    w = Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    blank = F.forall(cells, lambda c: F.trim(c) == "")
    head = F.last(F.when(is_header, F.struct(F.col(cells).alias("names"))).when(blank, F.struct(F.array().cast("array<string>").alias("names"))), ignorenulls=True).over(w)
    out = lines.withColumn("head__", head).where(~is_header & ~blank & (F.size("head__.names") > 0))
    n = F.least(F.size("head__.names"), F.size(cells))
    entries = F.arrays_zip(F.slice("head__.names", F.lit(1), n).alias("key"), F.slice(cells, F.lit(1), n).alias("value"))
    return out.withColumn("row", first_of_each(entries)).drop("head__")


def rename_by_alias(df: DataFrame, aliases: dict[str, Sequence[str]]) -> DataFrame:
    """Canonical columns from whatever spelling of their header is there; the first filled one counts."""
    norm = {"".join(ch for ch in c.lower() if ch.isalnum()): c for c in df.columns}
    pick = lambda names: [F.nullif(F.trim(F.col(f"`{norm[k]}`").cast("string")), F.lit("")) for k in ("".join(ch for ch in n.lower() if ch.isalnum()) for n in names) if k in norm]
    return df.select(*[F.coalesce(*pick([name, *others]), F.lit("")).alias(name) for name, others in aliases.items()])


def with_layout(rows: DataFrame, doc: str, pos: str, cells: str, layouts: dict[str, str]) -> DataFrame:
    """The layout of each row and its header: those of the last header row up to it, known by its first cell (layouts: first cell to name).

    Tables that go on without a header keep the layout before them; header rows and rows before any header go.
    """
    first = F.trim(F.get(F.col(cells), F.lit(0)))
    known = F.create_map(*[F.lit(x) for pair in layouts.items() for x in pair])
    w = Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    name = F.element_at(known, first)
    held = F.last(F.when(name.isNotNull(), F.struct(name.alias("layout"), F.col(cells).alias("header"))), ignorenulls=True).over(w)
    return rows.withColumn("held__", held).where(name.isNull() & F.col("held__").isNotNull()).select("*", "held__.layout", "held__.header").drop("held__")


def word_table(words: DataFrame, bounds: DataFrame, line_height: float = 3.0) -> DataFrame:
    """Rows of a page from its words: words of like height are a line, a word belongs to the column that its middle lies in.

    words: page, text, x0, x1, top. bounds: col, lo, hi. Out: page, line, col, text.
    """
    from ..operators.joins import in_range

    placed = in_range(words.withColumn("mid", (F.col("x0") + F.col("x1")) / 2), bounds, "mid", "lo", "hi")
    line = F.round(F.col("top") / line_height).cast("int")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda s: s["text"]), " ")
    return placed.groupBy("page", line.alias("line"), "col").agg(collapse(text).alias("text"))


def profile(df: DataFrame, page: str, html: str) -> DataFrame:
    """name, metrics, cites by year and tags of a profile page; pages without a name give nulls."""
    name = F.nullif(plain_text(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)), F.lit(""))
    listed = lambda cls: F.transform(F.regexp_extract_all(html, F.lit(rf'(?is)<(?:span|a|div)[^>]*class="{cls}"[^>]*>(.*?)</'), 1), plain_text)
    pairs = F.filter(F.arrays_zip(listed("year").alias("y"), listed("count").alias("n")), lambda p: p["y"].rlike(r"^\d+$") & p["n"].rlike(r"^\d+$"))
    by_year = first_of_each(F.transform(pairs, lambda p: F.struct(p["y"].cast("int").alias("key"), p["n"].cast("int").alias("value"))))
    # Metrics as `metrics` gives them, without a second reading of the pages.
    rows = df.select(page, html, F.filter(row_lists(F.col(html)), lambda cells: F.size(cells) >= 3).alias("rows__"))
    entry = lambda cells: F.struct(F.lower(F.get(cells, F.lit(0))).alias("key"), F.struct(F.get(cells, F.lit(1)).try_cast("int").alias("all"), F.get(cells, F.lit(2)).try_cast("int").alias("recent")).alias("value"))
    labelled = F.when(F.size("rows__") > 0, first_of_each(F.transform("rows__", entry)))
    base = rows.select(page, name.alias("name"), by_year.alias("by_year"), listed("tag").alias("tags"), labelled.alias("metrics"))
    kept = [F.when(F.col("name").isNotNull(), F.col(c)).alias(c) for c in ("by_year", "tags", "metrics")]
    return base.select(page, "name", *kept)
