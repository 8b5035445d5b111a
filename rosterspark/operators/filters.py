"""Predicates and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.fields import host
from ..functions.text import any_of


def in_years(year: Column, term: Column, least: str = K.MIN_YEAR, terms: Sequence[str] = K.ALLOWED_TERMS) -> Column:
    return (year >= least) & term.isin(list(terms))


def has_prefix(code: Column, letter: str = "C") -> Column:
    return F.coalesce(F.upper(F.substring(F.ltrim(code), 1, 1)) == letter, F.lit(False))


def is_excluded(name: Column, patterns: Sequence[str] = K.EXCLUDED_COURSES) -> Column:
    return name.rlike(any_of(patterns))


def is_lab_only(name: Column) -> Column:
    return name.rlike(K.LAB) & ~name.rlike(K.LAB_COMBINED)


def is_noise_line(line: Column, patterns: Sequence[str] = K.NOISE_LINES) -> Column:
    s = F.regexp_replace(F.lower(F.trim(line)), "[:.]+$", "")
    return (s == "") | s.rlike("|".join(f"(?:{p})" for p in patterns))


def has_multiple_fields(line: Column, names: str = K.FIELD_NAMES) -> Column:
    return (F.size(F.split(line, " ")) < 8) & (F.regexp_count(line, F.lit(names)) > 1)


def needs_processing(status: Column, statuses: Sequence[str] = K.PROCESSABLE_STATUSES) -> Column:
    return F.coalesce(F.trim(status), F.lit("")).isin(list(statuses))


def is_publication(venue_type: Column, title: Column, venue: Column, college: Column, year: Column) -> Column:
    """What stays in a list of publications: no book series, session notes or columns; college and year are known."""
    t = F.lower(F.trim(title))
    noise = t.startswith("session details") | t.startswith("math counts") | t.startswith("conversations:")
    return ~F.coalesce(venue_type, F.lit("")).isin("book series", "ebook platform") & ~F.coalesce(noise, F.lit(False)) & (F.lower(F.coalesce(venue, F.lit(""))) != "acm inroads") & (F.coalesce(F.trim(college), F.lit("")) != "") & year.isNotNull()


def tagged(tags: Column, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> Column:
    """Any of the included tags (rows without tags go as soon as one is asked for) and none of the excluded."""
    has = lambda some: F.arrays_overlap(F.coalesce(tags, F.array().cast("array<string>")), F.array(*[F.lit(x) for x in some]))
    keep = F.lit(True)
    if include:
        keep = keep & has(include)
    return keep & ~has(exclude) if exclude else keep


def groups_with(df: DataFrame, key: str, include: Column, exclude: Column) -> DataFrame:
    """Rows of the groups in which some row meets include and none meets exclude."""
    kept = df.groupBy(key).agg(F.bool_or(include).alias("hit"), F.bool_or(exclude).alias("bad")).where("hit and not coalesce(bad, false)").select(key)
    return df.join(kept, key, "left_semi")


def contains_all(text: Column, words: Sequence[str]) -> Column:
    keep = F.lit(True)
    for w in words:
        keep = keep & F.contains(text, F.lit(w))
    return keep


def gate_by_heading(cards: DataFrame, page: str, heading: str, bad: str = r"(?i)emerit|affiliat|retired|former") -> DataFrame:
    """Cards under bad headings go, on pages with two headings or more of which one is bad."""
    stats = cards.groupBy(page).agg(F.count_distinct(heading).alias("headings"), F.bool_or(F.col(heading).rlike(bad)).alias("any_bad"))
    return cards.join(stats, page, "left").where(~(F.coalesce(F.col("headings") >= 2, F.lit(False)) & F.coalesce(F.col("any_bad"), F.lit(False)) & F.coalesce(F.col(heading).rlike(bad), F.lit(False)))).drop("headings", "any_bad")


def strict_or_all(df: DataFrame, page: str, strict: Column, least: int = 2, loose: int = 10, times: int = 5) -> DataFrame:
    """A page's strict rows alone if they are enough and the page lists many more; else all its rows."""
    w = Window.partitionBy(page)
    n, all_ = F.count_if(strict).over(w), F.count(F.lit(1)).over(w)
    return df.withColumn("only", (n >= least) & (all_ >= loose) & (all_ > times * n)).where(~F.col("only") | strict).drop("only")


SOCIAL_HOSTS = ("facebook.com", "instagram.com", "twitter.com", "x.com", "linkedin.com", "youtube.com", "scholar.google.com", "github.com")


def eligible(major: Column, least: float = 1, state: Column | None = None, states: Sequence[str] = ()) -> Column:
    """Institutions with the major (a number as text) and, if states are named, in one of them."""
    keep = F.coalesce(major.try_cast("double") >= least, F.lit(False))
    return keep & F.coalesce(state.isin(list(states)), F.lit(False)) if states and state is not None else keep


def is_campus_page(url: Column, ending: str = ".edu", social: Sequence[str] = SOCIAL_HOSTS) -> Column:
    """Pages on hosts with the ending; pages of social and profile sites never count."""
    name = host(url)
    on_social = F.lit(False)
    for s in social:
        on_social = on_social | (name == s) | name.endswith(f".{s}")
    return F.coalesce(name.endswith(ending) & ~on_social, F.lit(False))


def is_trusted(status: Column, statuses: Sequence[str] = K.TRUSTED_STATUSES) -> Column:
    return F.coalesce(status.isin(list(statuses)), F.lit(False))


def in_directory(field: Column, fields: Sequence[str] = K.INCLUDED_FIELDS) -> Column:
    """People of the fields that a directory lists; a blank field counts as not looked at yet and stays out."""
    return F.coalesce(field.isin(list(fields)), F.lit(False))


def in_facets(group: Column, value: Column, year: Column, include: Sequence[tuple[str, str]] = (), exclude: Sequence[tuple[str, str]] = (), years: tuple[int | None, int | None] = (None, None)) -> Column:
    """Rows of a year range whose (group, value) facet isn't excluded and, once any is included, is among those; an open end of the range takes unknown years too."""
    has = lambda pairs: F.coalesce(F.struct(group.alias("g"), F.coalesce(value, F.lit("")).alias("v")).isin([F.struct(F.lit(g).alias("g"), F.lit(v).alias("v")) for g, v in pairs]), F.lit(False))
    keep = F.lit(True)
    if years[0] is not None:
        keep = keep & F.coalesce(year >= years[0], F.lit(False))
    if years[1] is not None:
        keep = keep & F.coalesce(year <= years[1], F.lit(False))
    if exclude:
        keep = keep & ~has(exclude)
    return keep & has(include) if include else keep


PAGE_REASONS = ("no html", "needs scripts", "empty app root", "many scripts, little text", "little text")


def page_gate(html: Column, text_length: Column) -> Column:
    """Why a page gives no text (one of PAGE_REASONS), or ok."""
    return (
        F.when(F.coalesce(html, F.lit("")) == "", PAGE_REASONS[0])
        .when(html.rlike(r"(?is)<noscript[^>]*>[^<]*(enable|requires?|turn on)[^<]*javascript"), PAGE_REASONS[1])
        .when(html.rlike(r'(?is)<div[^>]*id="(root|app|__next)"[^>]*>\s*</div>'), PAGE_REASONS[2])
        .when((F.regexp_count(html, F.lit("(?i)<script")) >= 5) & (text_length < 300), PAGE_REASONS[3])
        .when(text_length < 200, PAGE_REASONS[4])
        .otherwise("ok")
    )


def is_marker(row_type: Column, name: Column, types: Sequence[str] = ("DUAL", "GRAD", "EXPANSION"), patterns: Sequence[str] = (r"^final exam",)) -> Column:
    """Rows that carry no class: dual credit, graduate programs, expansion rows, final exams."""
    return F.coalesce(F.upper(row_type).isin(list(types)), F.lit(False)) | F.coalesce(name.rlike(any_of(patterns)), F.lit(False))


def in_partition(parsed_year: Column, parsed_term: Column, year: Column, term: Column) -> Column:
    """Whether a row's own term is the one that was asked for; rows that name none belong to it."""
    return (F.coalesce(parsed_year, year) == year) & (F.coalesce(parsed_term, term) == term)


def hide_sublisting(college: Column, code: Column, at: str, pattern: str, shown: bool = False) -> Column:
    """False for codes of a pattern at one institution, unless they are shown."""
    return F.lit(shown) | ~((college == at) & code.rlike(pattern))
