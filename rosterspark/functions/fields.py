"""URLs, ids, nested records, codes, terms and times as Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import fold, title_key, tokens


def scheme_and_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^(https?://[^/?#]+)", 1)


def host(url: Column) -> Column:
    """Lower-case host without www. and port."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#:]+)", 1)), r"^www\.", "")


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1)


def absolute_url(page: Column, link: Column) -> Column:
    """A link on a page as a whole URL: whole links stay, // takes the scheme, / the host, the rest the page's folder; a link that begins with the page's first path segment starts at the host."""
    first = F.regexp_extract(path(page), r"^/([^/]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(page, r"[?#].*$", ""), r"(?<=[^/:])/[^/]*$", "")
    return (
        F.when(link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(page, "^([a-zA-Z]+:)", 1), link))
        .when(link.startswith("/"), F.concat(scheme_and_host(page), link))
        .when((first != "") & link.startswith(F.concat(first, F.lit("/"))), F.concat(scheme_and_host(page), F.lit("/"), link))
        .otherwise(F.concat(folder, F.lit("/"), link))
    )


def page_link(link: Column) -> Column:
    """Null for links that lead to no page."""
    return F.when(~link.rlike(r"(?i)^(mailto:|tel:|javascript:|#)|\.(jpe?g|png|gif|svg|webp)$"), link)


def best_link(links: Column, name: Column) -> Column:
    """Of several links the shortest that holds a part of the name, else the shortest; the first of equals."""
    parts = F.filter(tokens(fold(name)), lambda t: F.length(t) >= 3)
    ranked = F.transform(links, lambda u, i: F.struct((~F.exists(parts, lambda p: F.contains(F.lower(u), p))).alias("other"), F.length(u).alias("n"), i.alias("i"), u.alias("u")))
    return F.array_min(ranked)["u"]


def shares_run(a: Column, b: Column, n: int = 4) -> Column:
    """Whether two strings have a common substring of n characters."""
    grams = lambda s: F.when(F.length(s) >= n, F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i: F.substring(s, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.arrays_overlap(grams(a), grams(b))


def plausible_link(url: Column, name: Column) -> Column:
    """A link that may belong to a person: it ends in digits, holds a part of the name, or shares four letters with it."""
    low, whole = F.lower(url), F.regexp_replace(fold(name), "[^a-z]", "")
    part = F.exists(F.filter(tokens(fold(name)), lambda t: F.length(t) >= 2), lambda t: F.contains(low, t))
    return url.rlike(r"\d+/?$") | part | shares_run(F.regexp_replace(F.substring_index(low, "/", -1), "[^a-z]", ""), whole)


def page_group(url: Column) -> Column:
    """Host and parent folder: pages of one group share a template."""
    p = F.regexp_replace(path(url), r"/index\.html?$", "")
    return F.concat(host(url), F.regexp_replace(F.regexp_replace(p, "/$", ""), "/[^/]*$", ""))


def last_segment(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def first_listed(c: Column) -> Column:
    """First element of a list written as text (['a', 'b']); anything else stays."""
    return F.when(c.rlike(r"^\s*\["), F.nullif(F.regexp_extract(c, r"['\"]([^'\"]*)['\"]", 1), F.lit(""))).otherwise(c)


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns])


def work_venue(location: Column) -> Column:
    """The source's name of a work's location, else the raw name as it stands there; blank without a location."""
    return F.coalesce(F.nullif(location["source"]["display_name"], F.lit("")), location["raw_source_name"], F.lit(""))


def work_venue_type(location: Column) -> Column:
    return F.coalesce(location["source"]["type"], F.lit(""))


def work_url(doi: Column, location: Column) -> Column:
    """The DOI, else the landing page, else blank."""
    return F.coalesce(F.nullif(doi, F.lit("")), location["landing_page_url"], F.lit(""))


def gap_fill(c: Column, other: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), other)


def pad_digits(c: Column, n: int) -> Column:
    """Leading zeros before a number (and its letter) up to n digits."""
    digits = F.regexp_extract(c, r"^(\d+)", 1)
    return F.when(digits != "", F.concat(F.lpad(digits, n, "0"), F.regexp_replace(c, r"^\d+", ""))).otherwise(c)


def academic_start(date: Column, first_month: int = 7) -> Column:
    """Starting year of the academic year that a date lies in."""
    return F.when(F.month(date) >= first_month, F.year(date)).otherwise(F.year(date) - 1)


def academic_year(start: Column) -> Column:
    """2025 as 2025-26."""
    return F.concat(start.cast("string"), F.lit("-"), F.lpad(((start + 1) % 100).cast("string"), 2, "0"))


def past_years(start: Column, n: int) -> Column:
    return F.transform(F.sequence(start, start - n + 1, F.lit(-1)), academic_year)


def term_of_month(date: Column) -> Column:
    m = F.month(date)
    return F.when(m.between(8, 12), "F").when(m == 1, "W").when(m.between(2, 5), "S").otherwise("Su")


def term_rank(term: Column, order: Mapping[str, int] = K.TERM_ORDER) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in order.items() for x in pair]), term)


def term_label(year: Column, term: Column) -> Column:
    """F21 for 2021-22 F, S22 for 2021-22 S, 21-22 without a term."""
    start, end = F.substring(year, 3, 2), F.substring(year, 6, 2)
    return F.when(term == "", F.concat(start, F.lit("-"), end)).otherwise(F.concat(term, F.when(term.isin("W", "S", "Su"), end).otherwise(start)))


def _clock(h: Column, m: Column) -> Column:
    return F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":"), F.lpad(m.cast("string"), 2, "0"))


def _parts(c: Column) -> tuple[Column, Column, Column]:
    pattern = r"(?i)^\s*(\d{1,2}):?(\d{2})?\s*([ap])?\.?m?\.?\s*$"
    return F.regexp_extract(c, pattern, 1).try_cast("int"), F.coalesce(F.regexp_extract(c, pattern, 2).try_cast("int"), F.lit(0)), F.lower(F.regexp_extract(c, pattern, 3))


def _once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c) with c computed once, however often f uses it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def _read_time(c: Column, f: Callable[[Column, Column, Column], Column]) -> Column:
    """f of the hour, minute and half (a, p or blank) of a time."""

    def parts(x: Column) -> Column:
        h, m, half = _parts(x)
        return F.struct(h.alias("h"), m.alias("m"), half.alias("half"))

    return _once(_once(c, parts), lambda t: f(t["h"], t["m"], t["half"]))


def to_24h(c: Column) -> Column:
    """12:40 PM as 12:40, 1 pm as 13:00; null if it is no time, as 25:00, 9:75 am or 13:00 pm aren't."""
    hour = lambda h, half: F.when((half == "p") & (h < 12), h + 12).when((half == "a") & (h == 12), 0).otherwise(h)
    return _read_time(c, lambda h, m, half: F.when((m < 60) & F.when(half == "", h < 24).otherwise(h.between(1, 12)), _clock(hour(h, half), m)))


def military_to_12h(c: Column) -> Column:
    """1400 as 2:00pm."""
    n = c.try_cast("int")
    h = F.floor(n / 100)
    return F.when(n.isNotNull(), F.concat(((h + 11) % 12 + 1).cast("string"), F.lit(":"), F.lpad((n % 100).cast("string"), 2, "0"), F.when(h >= 12, "pm").otherwise("am")))


def hhmm(c: Column) -> Column:
    """0900 as 09:00."""
    return F.when(c.rlike(r"^\d{4}$"), F.concat(F.substring(c, 1, 2), F.lit(":"), F.substring(c, 3, 2))).otherwise(c)


def time_of_day(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def seconds_clock(seconds: Column) -> Column:
    """Seconds since midnight as H:MM."""
    return F.concat(F.floor(seconds / 3600).cast("string"), F.lit(":"), F.lpad(F.floor(seconds % 3600 / 60).cast("string"), 2, "0"))


def time_range(c: Column) -> Column:
    """3:00-4:15pm as 15:00-16:15: the suffix counts for both ends, the start flips to morning if the range would run backwards."""
    pattern = r"(?i)^\s*(\d{1,2}(?::\d{2})?)\s*([ap]m)?\s*[-–]\s*(\d{1,2}(?::\d{2})?)\s*([ap]m)?\s*$"
    parts = lambda x: F.when(x.rlike(pattern), F.struct(*[F.regexp_extract(x, pattern, i).alias(n) for i, n in enumerate(("start", "half", "end", "last"), 1)]))

    def read(p: Column) -> Column:
        own = F.when(p["half"] != "", p["half"]).otherwise(p["last"])
        other = F.when(F.lower(own) == "pm", "am").otherwise("pm")
        end = to_24h(F.concat(p["end"], F.when(p["last"] != "", p["last"]).otherwise(p["half"])))
        both = F.struct(to_24h(F.concat(p["start"], own)).alias("start"), end.alias("end"))
        return _once(both, lambda t: F.concat(F.when((t["start"] > t["end"]) & (p["half"] == ""), to_24h(F.concat(p["start"], other))).otherwise(t["start"]), F.lit("-"), t["end"]))

    return _once(_once(c, parts), read)


def infer_half(c: Column) -> Column:
    """Times without am or pm: 1-7 and 12 are pm, 8-11 am, 0:00 is blank."""
    return _read_time(c, lambda h, m, _: F.when((h == 0) & (m == 0), "").when(h.between(1, 7), _clock(h + 12, m)).otherwise(_clock(h, m)))


WEEK = ("M", "T", "W", "R", "F", "S", "U")


def days_from_flags(flags: Sequence[Column], names: Sequence[str] = WEEK) -> Column:
    return F.concat_ws("", *[F.when(f, n) for f, n in zip(flags, names, strict=False)])


DAY_TOKEN = r"(?:mon|tues|wednes|thurs|fri|satur|sun)days?|tues|thurs?|mon|tue|wed|thu|fri|sat|sun|mo|tu|we|th|fr|sa|su|[mtwrfsu]"
_DAY_NAME = r"(?i)\b((?:mon|tues|wednes|thurs|fri|satur|sun)days?|mon|tues?|wed|thu(?:rs?)?|fri|sat|sun)\b"


def days_from_text(c: Column) -> Column:
    """Days as M T W R F S U letters in the order given: letters (MWF), pairs (MoWeFr, TTh), names, with or without separators; of other texts the names of days in them, else blank."""
    table = F.create_map(*[F.lit(x) for pair in [*zip(("mo", "tu", "we", "th", "fr", "sa", "su"), WEEK, strict=True), *((d.lower(), d) for d in WEEK)] for x in pair])
    letters = lambda found: F.array_join(F.transform(found, lambda d: F.element_at(table, F.substring(F.lower(d), 1, 2))), "")
    whole = c.rlike(rf"(?i)^[\s,;/&.\-]*(?:(?:{DAY_TOKEN})(?:and|[\s,;/&.\-])*)+$")
    return F.when(whole, letters(F.regexp_extract_all(F.regexp_replace(c, "(?i)\\band\\b", " "), F.lit(f"(?i)({DAY_TOKEN})"), 1))).otherwise(letters(F.regexp_extract_all(c, F.lit(_DAY_NAME), 1)))


def days_from_mask(c: Column) -> Column:
    """.M.W.F. (a place for each day from Sunday on) as the letters that are set."""
    return F.regexp_replace(c, r"[.\-_ ]", "")


def meeting(days: Column, time: Column, location: Column) -> Column:
    """days time (location), without blanks."""
    filled = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.concat_ws(" ", filled(days), filled(time), F.concat(F.lit("("), filled(location), F.lit(")")))


def publication_type(venue: Column, venue_type: Column, work_type: Column, core: Column, quartile: Column) -> Column:
    """workshop, conference, journal, preprint, book or other; the first rule that fits."""
    return (
        F.when(F.contains(F.lower(venue), F.lit("workshop")), "workshop")
        .when((venue_type == "conference") | (F.coalesce(core, F.lit("")) != ""), "conference")
        .when((venue_type == "journal") | ~F.coalesce(quartile, F.lit("")).isin("", "-"), "journal")
        .when(venue_type == "repository", "preprint")
        .when(venue_type.isin("book series", "ebook platform") | work_type.isin("book", "book-chapter"), "book")
        .when(work_type == "preprint", "preprint")
        .otherwise("other")
    )


def ranking(kind: Column, core: Column, quartile: Column) -> Column:
    """struct(value, source) for conferences and journals; the quartile - counts as none."""
    return F.struct(F.when(kind == "conference", F.nullif(core, F.lit(""))).when(kind == "journal", F.nullif(F.nullif(quartile, F.lit("-")), F.lit(""))).alias("value"), F.when(kind == "conference", "conference").when(kind == "journal", "journal").alias("source"))


def trusted_or(trusted: Column, own: Column, has_other: Column, other: Column) -> Column:
    return F.when(trusted, own).when(has_other, other)


def search_text(*columns: Column) -> Column:
    return F.lower(F.concat_ws(" ", *columns))


def anchored(line: Column, anchor: str = r"\d{1,2}:\d{2}\s*-\s*\d{1,2}:\d{2}(?:\s*[ap]m)?") -> Column:
    """struct(before, days, time, rest, person) around a time: day letters stand to its left; the rightmost Last,First is the person."""
    whole = rf"(?i)^(.*?)\s*\b([MTWRFSU]{{1,5}})?\s*({anchor})\s*(.*)$"
    part = lambda i: F.regexp_extract(line, whole, i)
    people = F.filter(F.split(part(4), r"\s+"), lambda t: t.rlike(r"^\p{L}[\p{L}'\-]*,\p{L}"))
    return F.when(line.rlike(whole), F.struct(F.trim(part(1)).alias("before"), part(2).alias("days"), part(3).alias("time"), part(4).alias("rest"), F.when(F.size(people) > 0, F.element_at(people, -1)).alias("person")))


def authors_of(authorships: Column) -> Column:
    """array<struct<name,id,affiliations>> of nested records, affiliations each once."""
    return F.transform(authorships, lambda a: F.struct(a["author"]["display_name"].alias("name"), last_segment(a["author"]["id"]).alias("id"), F.array_distinct(F.filter(F.transform(a["institutions"], lambda i: i["display_name"]), lambda n: F.coalesce(n, F.lit("")) != "")).alias("affiliations")))


def findings_parent(venue: Column) -> Column:
    """X of "Findings of ...: X" or "Findings of X"."""
    return F.nullif(F.regexp_extract(venue, r"(?i)^Findings of (?:.*:\s*)?(.+)$", 1), F.lit(""))


def natural_key(c: Column) -> Column:
    """Sort key in which runs of digits count as numbers."""
    return F.transform(F.regexp_extract_all(F.lower(c), F.lit(r"(\d+|\D+)"), 1), lambda p: F.struct(p.rlike(r"^\d").alias("digits"), F.coalesce(p.try_cast("bigint"), F.lit(-1)).alias("n"), p.alias("text")))


def match_level(name_a: Column, name_b: Column, college_a: Column, college_b: Column) -> Column:
    """matched, matched_name, matched_college or no_match: the letters of one side stand in order in the other."""
    name, college = is_subsequence(name_a, name_b) | is_subsequence(name_b, name_a), is_subsequence(college_a, college_b) | is_subsequence(college_b, college_a)
    return F.when(name & college, "matched").when(name, "matched_name").when(college, "matched_college").otherwise("no_match")


def is_subsequence(needle: Column, text: Column) -> Column:
    """Whether the needle's characters stand in the text in this order; an empty needle never counts."""
    at = F.aggregate(F.split(text, ""), F.lit(1), lambda p, ch: F.when(ch == F.substring(needle, p, F.lit(1)), p + 1).otherwise(p))
    return (needle != "") & (at > F.length(needle))


def paper_key(title: Column, work_id: Column) -> Column:
    """Title key; untitled works keep their own id, so they never fall together."""
    key = title_key(F.coalesce(title, F.lit("")))
    return F.when(key != "", key).otherwise(F.concat(F.lit("id:"), work_id.cast("string")))


def term_code(year: Column, term: Column, rule: Column) -> Column:
    """A provider's code of a term by its rule: "{start}", "{end}", "{s}", "{e}" (two digits), "{term}" and "{n}" (rank from 1) are filled in."""
    start, end = F.substring(year, 1, 4), (F.substring(year, 1, 4).cast("int") + 1).cast("string")
    filled = rule
    for name, value in {"{start}": start, "{end}": end, "{s}": F.substring(year, 3, 2), "{e}": F.substring(year, 6, 2), "{term}": term, "{n}": (term_rank(term) + 1).cast("string")}.items():
        filled = F.replace(filled, F.lit(name), value)
    return filled


def days_from_indexes(indexes: Column, names: Sequence[str] = WEEK) -> Column:
    """Numbers of days (0 for Monday) as letters in the order of the week."""
    return F.array_join(F.transform(F.array_sort(F.array_distinct(indexes)), lambda i: F.element_at(F.array(*[F.lit(n) for n in names]), i.cast("int") + 1)), "")
