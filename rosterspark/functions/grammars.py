"""How sources write codes, terms and days: rows of (style, order, pattern, templates), compiled into one expression.

A row's pattern is tried in the order of its style; the first that fits fills its templates, in which {1} stands for the pattern's first group. Which
source writes in which style is a table too, so a new source is a row and no code; `by_style` picks the style by a column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fields import WEEK, academic_year, days_from_mask, days_from_text

# How course codes and sections are written, as (style, pattern, code, section). What fits none is the code as it stands.
CODES = [
    ("dashed", r"^([A-Z]+\d*[*-]\d+\w*)-(\w+)$", "{1}", "{2}"),  # CSC-201-01, CISC-118-1A, COMP*121-01, CSC54-144-01
    ("starred", r"^([A-Z]+)\*(\d+\w*)\*(\w+)$", "{1} {2}", "{3}"),  # CSI*201*10
    ("named", r"^([A-Z]+)-(\d+\w*)-(\w+)$", "{1} {2}", "{3}"),  # COSC-130-A
    ("spaced", r"^([A-Z]+)\s+(\d+)-(\w+)$", "{1} {2}", "{3}"),  # CSCI 1101-A
    ("spaced", r"^([A-Za-z]+\s*\d+[A-Za-z]?)\s+([A-Za-z0-9]+)$", "{1}", "{2}"),  # CSC 1235 K
    ("dotted", r"^(.*\S)\s*\.\s*([^.]*?)\s*$", "{1}", "{2}"),  # CSCI 201.001
    ("joined", r"^([A-Za-z]+)\s*(.*?)\s*$", "{1} {2}", ""),  # CSC141
    ("dated", r"^([A-Z]+)(\d+)([A-Z0-9]*)-[A-Z]+\d{2}$", "{1} {2}", "{3}"),  # CSCI0145A-F25
    ("lettered", r"^([A-Za-z]+)\s*(\d+)\s*[Ll]$", "{1} {2}", "Lab"),  # CPS121 L
    ("lettered", r"^([A-Za-z]+)\s*(\d+)\s*([A-Za-z]?)$", "{1} {2}", "{3}"),  # CPS121, CPS121 B
    ("registered", r"^(.+?)(\d{2}[0-9A-Z])$", "{1}", "{2}"),  # CMSCH105001
    ("any", r"^([A-Z]{2,5})[-*\s]?(\d{4})([A-Z])(?:-\w+)?$", "{1} {2}", "{3}"),
    ("any", r"^([A-Z]{2,5})[-*\s.]?(\d{2,4}[A-Z]?)[-*.\s]+[Ll]$", "{1} {2}", "Lab"),
    ("any", r"^([A-Z]{2,5})[-*\s]?(\d{2,4})L$", "{1} {2}", "Lab"),
    ("any", r"^([A-Z]{2,5})[-*\s.]?(\d{2,4}[A-Z]?)[-*.\s]+([A-Z]?\d{1,3}[A-Z]?|[A-Z])$", "{1} {2}", "{3}"),
    ("any", r"^([A-Z]{2,5})[-*\s]?(\d{2,4})$", "{1} {2}", ""),
]

# Words of terms, by style; those of "any" stand for terms everywhere.
TERM_WORDS = {
    "any": {"fall": "F", "autumn": "F", "winter": "W", "january": "W", "jan term": "W", "jterm": "W", "j term": "W", "j-term": "W", "interim": "W", "spring": "S", "maymester": "Su", "may term": "Su", "summer": "Su"},
    "two terms": {"fall": "F", "winter": "S", "spring": "S"},
    "church": {"advent": "F", "easter": "S"},
    "short": {"sum": "Su", "fa": "F", "sp": "S", "win": "W"},
}

# How terms are written, as (style, pattern, word, first year, last two digits of a range or blank); {words} stands for the style's words.
TERMS = [
    ("any", r"(?i)((?:19|20)\d{2})\s*[-/–]\s*(?:\d{2})?(\d{2})\b.*?\b({words})\b", "{3}", "{1}", "{2}"),  # 2025-26 Spring Semester
    ("any", r"(?i)\b({words})\b.*?((?:19|20)\d{2})\s*[-/–]\s*(?:\d{2})?(\d{2})\b", "{1}", "{2}", "{3}"),  # Spring 2026-27
    ("any", r"(?i)\b({words})\b.*?((?:19|20)\d{2})", "{1}", "{2}", ""),  # Fall 2026, Fall Term 2026
    ("any", r"(?i)((?:19|20)\d{2}).*?\b({words})\b", "{2}", "{1}", ""),  # 2026 Spring, 2026 - Fall
    ("any", r"(?i)(fall|spring|summer|winter)((?:19|20)\d{2})", "{1}", "{2}", ""),  # term-Fall2025
    ("filed", r"(?i)sched-(f|s)(\d{2})\b", "{1}", "20{2}", ""),  # sched-f25.pdf
    ("short", r"(?i)\b({words})\w*\W+((?:19|20)\d{2})", "{1}", "{2}", ""),  # SUM1 2026
]

# Codes that providers give to terms, as (style, term) -> template of {start}, {end}, {s}, {e} (two digits).
TERM_CODES = {
    "start": {"F": "{start}01", "S": "{start}02"},
    "end": {"F": "{end}01", "W": "{end}02", "S": "{end}03", "Su": "{end}04"},
    "tens": {"F": "{start}90", "W": "{end}10", "S": "{end}20", "Su": "{end}65"},
    "months": {"F": "{end}01", "S": "{end}05", "Su": "{end}09"},
    "letters": {"F": "{s}{e}F", "W": "{s}{e}W", "S": "{s}{e}S", "Su": "{s}{e}Su"},
}


def filled(template: str, c: Column, pattern: str) -> Column:
    """The template with the pattern's groups in place of {1}, {2} and so on, trimmed."""
    parts, rest = [], template
    while rest:
        before, brace, after = rest.partition("{")
        parts += [F.lit(before)] if before else []
        number, _, rest = after.partition("}") if brace else ("", "", "")
        parts += [F.regexp_extract(c, pattern, int(number))] if number else []
    return F.trim(F.concat(*parts)) if parts else F.lit("")


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c), where c is worked out once however often it is used."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def first_fit(c: Column, rows: Sequence[tuple[str, Callable[[str], Column]]], otherwise: Column) -> Column:
    """What the first pattern that fits makes of c."""
    return reduce(lambda out, row: F.when(c.rlike(row[0]), row[1](row[0])).otherwise(out), reversed(rows), otherwise)


def split_code(c: Column, style: str = "any", grammar: Sequence[tuple[str, str, str, str]] = CODES) -> Column:
    """struct(code, section) of a code in a style; the whole text is the code if no pattern of the style fits."""
    text = F.trim(c)
    made = lambda code, section: lambda pattern: F.struct(filled(code, text, pattern).alias("code"), filled(section, text, pattern).alias("section"))
    return first_fit(text, [(p, made(code, section)) for s, p, code, section in grammar if s == style], F.struct(text.alias("code"), F.lit("").alias("section")))


def parse_term(label: Column, style: str = "any", words: Mapping[str, Mapping[str, str]] = TERM_WORDS, grammar: Sequence[tuple[str, str, str, str, str]] = TERMS) -> Column:
    """struct(year, term) of a label: a range is the academic year as it stands; of a single year a fall begins the academic year and other terms end it. Null if it is no term."""
    known = words.get(style, words["any"])
    spelled = "|".join(w.replace(" ", r"\s+") for w in sorted(known, key=len, reverse=True))
    table = F.create_map(*[F.lit(x) for pair in [*known.items(), *({"f": "F", "s": "S"}.items() if style == "filed" else ())] for x in pair])
    rows = [r for r in grammar if r[0] == (style if any(g[0] == style for g in grammar) else "any")]

    def made(word: str, year: str, last: str) -> Callable[[str], Column]:
        def of(pattern: str) -> Column:
            term = F.element_at(table, F.regexp_replace(F.lower(filled(word, label, pattern)), r"\s+", " "))
            start = lambda v: v["first"] if last else F.when(v["term"] == "F", v["first"]).otherwise(v["first"] - 1)
            found = F.struct(term.alias("term"), filled(year, label, pattern).try_cast("int").alias("first"))
            return once(found, lambda v: F.when(v["term"].isNotNull(), F.struct(academic_year(start(v)).alias("year"), v["term"].alias("term"))))

        return of

    return first_fit(label, [(p.replace("{words}", spelled), made(word, year, last)) for _, p, word, year, last in rows], F.lit(None).cast("struct<year:string,term:string>"))


def term_code(year: Column, term: Column, style: str, codes: Mapping[str, Mapping[str, str]] = TERM_CODES) -> Column:
    """The provider's code of a term (academic year as 2025-26); null for terms that it has none for."""
    start = F.substring(year, 1, 4)
    values = {"{start}": start, "{end}": (start.try_cast("int") + 1).cast("string"), "{s}": F.substring(year, 3, 2), "{e}": F.substring(year, 6, 2)}
    out = F.element_at(F.create_map(*[F.lit(x) for pair in codes[style].items() for x in pair]), term)
    return reduce(lambda c, v: F.replace(c, F.lit(v[0]), v[1]), values.items(), out)


def parse_term_code(code: Column, style: str, codes: Mapping[str, Mapping[str, str]] = TERM_CODES) -> Column:
    """struct(year, term) of a provider's code; null if it is none of this style's."""
    out = F.lit(None).cast("struct<year:string,term:string>")
    for term, template in codes[style].items():
        places = {"{start}": r"(\d{4})", "{end}": r"(\d{4})", "{s}{e}": r"(\d{2})\d{2}"}
        pattern = "^" + reduce(lambda t, p: t.replace(*p), places.items(), template) + "$"
        found = F.regexp_extract(code, pattern, 1).try_cast("int")
        start = found - 1 if "{end}" in template else found + 2000 if "{s}" in template else found
        out = F.when(code.rlike(pattern), F.struct(academic_year(start).alias("year"), F.lit(term).alias("term"))).otherwise(out)
    return out


def days(c: Column, style: str = "any") -> Column:
    """Days as M T W R F S U letters. mask: a place for each day, dots where there is none; any: letters, pairs or names."""
    return {"mask": days_from_mask, "any": days_from_text}[style](c)


def by_style(style: Column, styles: Sequence[str], read: Callable[[str], Column], otherwise: str = "any") -> Column:
    """read(style) for the style that a column names; unknown and missing ones are read as `otherwise`."""
    return reduce(lambda out, s: F.when(style == s, read(s)).otherwise(out), [s for s in styles if s != otherwise], read(otherwise))


__all__ = ["CODES", "TERMS", "TERM_CODES", "TERM_WORDS", "WEEK", "by_style", "days", "first_fit", "once", "parse_term", "parse_term_code", "split_code", "term_code"]
