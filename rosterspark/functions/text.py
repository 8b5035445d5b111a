"""Text, names and titles as Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

SPACES = r"(?U)\s+"


def any_of(patterns: Sequence[str], flags: str = "(?i)") -> str:
    return flags + "|".join(f"(?:{p})" for p in patterns)


def collapse(c: Column) -> Column:
    """White space (no-break spaces too) as single spaces, trimmed."""
    return F.trim(F.regexp_replace(c, SPACES, " "))


def title_key(c: Column) -> Column:
    """Key for equal titles: literal \\n and \\t and everything but a-z and 0-9 read as one space."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(c, r"\\[nt]", " ")), "[^a-z0-9]+", " "))


def _plain_letters() -> tuple[str, str]:
    """Every Latin letter that decomposes into a letter and marks, and that letter; then the marks themselves, which translate() drops."""
    decomposed = {chr(c): unicodedata.normalize("NFD", chr(c)) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))}
    folded = {c: d[0] for c, d in decomposed.items() if len(d) > 1 and all(unicodedata.combining(m) for m in d[1:])}
    return "".join(folded) + "".join(map(chr, range(0x300, 0x370))), "".join(folded.values())


ACCENTED, FOLDED = _plain_letters()


def fold(c: Column) -> Column:
    """Accents off (letters that no mark makes, such as ł and ø, stay), lower case, trimmed."""
    return F.trim(F.lower(F.translate(c, ACCENTED, FOLDED)))


def letters(c: Column) -> Column:
    """Accents off, lower case, letters alone."""
    return F.regexp_replace(fold(c), "[^a-z]", "")


def tokens(c: Column) -> Column:
    """Words between white space; an empty array for a blank string."""
    return F.filter(F.split(c, SPACES), lambda t: t != "")


SUFFIX = r"(?i),\s*(?:jr|sr|ii|iii|iv|ph\.?\s*d|m\.?\s*d|ed\.?\s*d|m\.?\s*s|m\.?\s*a|b\.?\s*s|b\.?\s*a|esq)\.?\s*$"


def clean_name(c: Column) -> Column:
    """A person's name: no parentheses, trailing digits, capital codes, degrees after a comma or honorifics; Last, First turned; null under three characters."""
    c = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\(.*\)", ""), r"\s+.?\d+", ""), "[A-Z]{3,}", "")
    c = F.regexp_replace(F.regexp_replace(c, SUFFIX, ""), SUFFIX, "")
    before, after = F.substring_index(c, ",", 1), F.regexp_replace(F.regexp_replace(c, "^[^,]*,", ""), ",", " ")
    one_word_first = F.size(tokens(before)) < 2
    c = F.when(F.contains(c, F.lit(",")), F.when(one_word_first, F.concat_ws(" ", after, before)).otherwise(before)).otherwise(c)
    c = F.regexp_replace(c, r"^\s*((Prof|Dr|Lt|Col|Maj|Mr|Mrs|Ms)\.\s*)+", "")
    c = F.regexp_replace(F.regexp_replace(collapse(c), "\u2019", "'"), "\u200b", "")
    return F.when(F.length(c) >= 3, c)


def looks_like_name(c: Column) -> Column:
    """Two to six capitalised words without digits, separators or words of offices and pages."""
    parts = F.transform(tokens(c), lambda t: F.regexp_replace(t, "^[.,]+|[.,]+$", ""))
    capital = lambda t: t.rlike(r"^\p{Lu}") | t.rlike(r"^(de|von|van)")
    plain = ~c.rlike(any_of([rf"\b{w}\b" for w in K.NOT_A_NAME])) & ~c.rlike(r"[:;@/|()\d]")
    long_word = F.exists(parts, lambda t: F.length(t) >= 3)
    short_word = F.exists(parts, lambda t: F.lower(t).isin(K.SHORT_WORDS))
    fits = F.size(parts).between(2, 6) & F.forall(parts, capital) & (F.length(F.try_element_at(parts, F.lit(-1))) >= 2) & (long_word | ~short_word)
    return F.coalesce(plain & F.when(F.size(parts) > 0, fits), F.lit(False))


def name_key(c: Column) -> Column:
    """struct(last, initial): last word and first letter, lower case; null for names of one word."""
    t = tokens(c)
    return F.when(F.size(t) >= 2, F.struct(F.lower(F.try_element_at(t, F.lit(-1))).alias("last"), F.lower(F.substring(F.get(t, F.lit(0)), 1, 1)).alias("initial")))


def is_generic(c: Column) -> Column:
    s = F.trim(F.regexp_replace(F.trim(c), r"[.,]+$", ""))
    return (s == "") | s.rlike(K.GENERIC_PEOPLE)


def parse_person(c: Column) -> Column:
    """struct(first, last) of F. Last, Last, First or First Last; null if generic or of one word."""
    s = F.trim(F.regexp_replace(F.trim(c), "^,+|,+$", ""))
    t = tokens(s)
    initials = r"^(?:[A-Z]\.\s*){1,3}([A-Z][a-z][A-Za-z'\-]+)$"
    rest = F.regexp_replace(F.try_element_at(tokens(F.regexp_replace(s, "^[^,]*,", "")), F.lit(1)), r"\.$", "")
    pair = lambda first, last: F.struct(first.alias("first"), last.alias("last"))
    by_comma = F.when((F.trim(F.substring_index(s, ",", 1)) != "") & rest.isNotNull(), pair(fold(rest), fold(F.substring_index(s, ",", 1))))
    by_space = F.when(F.size(t) >= 2, pair(fold(F.regexp_replace(F.get(t, F.lit(0)), r"\.$", "")), fold(F.try_element_at(t, F.lit(-1)))))
    return F.when(is_generic(s), F.lit(None)).when(s.rlike(initials), pair(F.lower(F.substring(s, 1, 1)), fold(F.regexp_extract(s, initials, 1)))).when(F.contains(s, F.lit(",")), by_comma).otherwise(by_space)


def split_people(c: Column) -> Column:
    """The people of one string: by ; else by commas (two parts with spaces are two people, else Last, First); generic words dropped."""

    def without_semicolon(s: Column) -> Column:
        kept = F.filter(F.transform(F.split(s, ","), lambda p: F.trim(p)), lambda p: (p != "") & ~is_generic(p))
        both_full = F.forall(kept, lambda p: F.contains(p, F.lit(" ")))
        return F.when((F.size(kept) == 2) & ~both_full, F.array(F.array_join(kept, ", "))).otherwise(kept)

    parts = F.split(F.trim(F.coalesce(c, F.lit(""))), ";")
    return F.flatten(F.transform(parts, without_semicolon))


def initials(c: Column) -> Column:
    """First letters of the first and last word, two letters of a lone word, ? for none."""
    t = tokens(c)
    return F.when(F.size(t) >= 2, F.upper(F.concat(F.substring(F.get(t, F.lit(0)), 1, 1), F.substring(F.try_element_at(t, F.lit(-1)), 1, 1)))).when(F.size(t) == 1, F.upper(F.substring(F.get(t, F.lit(0)), 1, 2))).otherwise("?")


def clean_title(c: Column, include_subject: bool = False) -> Column:
    """An academic title in rank words; null for what isn't a teaching post, for emeriti and for other subjects."""
    t = F.lower(collapse(c))
    has = t.rlike
    reject = ~has(r"(prof\.|professor|centennial|lecturer|instructor|chair)") | has(r"(emerit|program contact)") | (has(K.POSITION_OF) & ~has(K.POSITION_OF + K.SUBJECT)) | has("(lab|laboratory) lecturer")
    if include_subject:
        reject = reject | ~has(K.SUBJECT)
    words = lambda *parts: F.concat_ws(" ", *parts)
    senior = F.when(has("senior lecturer") | (has("instructor") & ~has("lecturer") & has("senior")), "Senior")
    lab = F.when(~has("lecturer") & has("instructor") & has("lab"), "Lab")
    rank = F.when(has("lecturer"), "Lecturer").when(has("instructor"), "Instructor").otherwise("Professor")
    professor = ~has("lecturer") & ~has("instructor")
    grade = F.when(professor & has("associate"), "Associate").when(professor & has("assistant"), "Assistant")
    teaching = F.when(professor & has("teaching (professor|assistant|associate)"), "Teaching")
    stay = F.when(has("visiting"), "Visiting").when(has("adjunct"), "Adjunct")
    practice = F.when(stay.isNull() & has("professor of practice"), "of Practice")
    return F.when(~reject, words(stay, senior, lab, grade, teaching, rank, practice))


def title_category(c: Column) -> Column:
    t = F.lower(F.coalesce(c, F.lit("")))
    return (
        F.when(t.startswith("visiting"), "visiting")
        .when(t.startswith("adjunct"), "adjunct")
        .when(t.rlike("lecturer|instructor|teaching|practice"), "teaching")
        .when(F.contains(t, F.lit("assistant professor")), "tenure_track")
        .when(F.contains(t, F.lit("professor")), "tenured")
        .otherwise("tenure_track")
    )


def list_items(c: Column, separator: str) -> Column:
    """Trimmed, non-empty items of a delimited list."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), separator), lambda p: F.trim(p)), lambda p: p != "")


def relist(c: Column, separator: str, joiner: str = ", ") -> Column:
    return F.nullif(F.array_join(list_items(c, separator), joiner), F.lit(""))


def to_int(c: Column) -> Column:
    """Whole part of a number written as text; null if it isn't one."""
    return c.try_cast("double").try_cast("bigint")


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-|-$", "")


def clean_venue(c: Column) -> Column:
    """arXiv for any arXiv name, null for links, Name for Name (repository)."""
    named = F.when(c.rlike(r"^\w+\s+\(.*\)$"), F.regexp_extract(c, r"^(\w+)", 1)).otherwise(c)
    return F.when(F.contains(F.lower(c), F.lit("arxiv")), "arXiv").when(~F.contains(c, F.lit("http")), F.nullif(F.replace(named, F.lit("&amp;"), F.lit("&")), F.lit("")))


def shorten_words(c: Column, short: Mapping[str, str] = K.VENUE_SHORT) -> Column:
    """Whole words with a short form give way to it, whatever stands beside them; the first letter keeps its case."""
    table = F.create_map(*[F.lit(x) for pair in short.items() for x in pair])

    def one(w: Column) -> Column:
        found, first = F.element_at(table, F.lower(w)), F.substring(w, 1, 1)
        lowered = F.concat(F.lower(F.substring(found, 1, 1)), F.substring(found, F.lit(2), F.length(found)))
        return F.when(found.isNull(), w).when(first == F.upper(first), found).otherwise(lowered)

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"(\w+|\W+)"), 1), one), "")


def journal_key(c: Column) -> Column:
    """Normal form of a journal's title."""
    c = F.lower(F.regexp_replace(F.trim(c), r",\s*[A-Z][A-Z0-9]{1,7}\s*$", ""))
    c = F.regexp_replace(F.replace(F.replace(c, F.lit("&amp;"), F.lit("and")), F.lit("&"), F.lit("and")), r"\bthe\b", "")
    return collapse(F.regexp_replace(F.regexp_replace(c, r"\(.*?\)", ""), "[^a-z0-9 ]", " "))


def stem(w: Column) -> Column:
    """English plurals to singulars."""
    n = F.length(w)
    return F.when(w.endswith("ies") & (n > 4), F.concat(F.substring(w, 1, n - 3), F.lit("y"))).when(w.endswith("ses") | w.endswith("zes"), F.substring(w, 1, n - 2)).when(w.endswith("s") & ~w.endswith("ss"), F.substring(w, 1, n - 1)).otherwise(w)


ANY_WORD, ORDINAL_ONLY = K.ANY_WORD, K.ORDINAL_ONLY


def title_tokens(c: Column, prefix: str = ANY_WORD, stop: Sequence[str] = K.TITLE_STOP) -> Column:
    """Set of a title's words: no catalogue notes, proceedings prefix, ordinals, years or stop words; plurals stemmed."""
    c = F.regexp_replace(F.replace(c, F.lit("&amp;"), F.lit("&")), r"(?i)\s*\((?:(?:IEEE\s*)?Cat\.?\s*No\.|IEEE\s*Cat\b)[^)]*\)", "")
    c = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, prefix, ""), r"(?i)\b\d+(?:st|nd|rd|th)\b", ""), r"\b(?:19|20)\d{2}\b", "")
    words = F.filter(F.split(F.lower(c), r"(?U)\W+"), lambda w: (F.length(w) > 1) & ~w.isin(list(stop)))
    return F.array_distinct(F.transform(words, stem))


def journal_tokens(key: Column) -> Column:
    """Words of a normal form in order, each once; stop words and single letters out."""
    return F.array_distinct(F.filter(F.split(key, " "), lambda w: (F.length(w) > 1) & ~w.isin(K.JOURNAL_STOP)))


def blank_if_placeholder(c: Column, placeholders: Sequence[str] = ("TBA", "Staff", "None listed.")) -> Column:
    return F.when(c.isin(list(placeholders)), "").otherwise(c)


def distinct_by(items: Column, key) -> Column:
    """Items of a list whose key hasn't come before, in order."""

    def first(its: Column) -> Column:
        return F.transform(F.array(F.transform(its, key)), lambda keys: F.filter(its, lambda x, i: F.array_position(keys, key(x)) == i + 1))

    # Items and keys are bound, each in a list of one: they are made once, not again for each item.
    return F.get(F.flatten(F.transform(F.array(items), first)), F.lit(0))


ROLE_MARKER = r"(?i)\s*\((?:primary|p|lead|responsible)\)\s*$"


def primary_first(people: Column) -> Column:
    """Names of structs (name, primary): primary ones first, each once, blanks left out. A role marker such as (Primary) behind a name goes."""
    named = lambda some: F.transform(some, lambda p: F.trim(F.regexp_replace(p["name"], ROLE_MARKER, "")))
    is_primary = lambda p: F.coalesce(p["primary"], F.lit(False))
    return F.array_distinct(F.filter(F.concat(named(F.filter(people, is_primary)), named(F.filter(people, lambda p: ~is_primary(p)))), lambda n: F.coalesce(n, F.lit("")) != ""))


def title_and_people(c: Column, note: str = r"(?i)lab|credit|lecture|section|hybrid|online|\d") -> Column:
    """struct(title, people) of "title (people) (note)"."""
    inside = F.regexp_extract_all(c, F.lit(r"\(([^()]*)\)"), 1)
    people = F.filter(inside, lambda p: ~p.rlike(note))
    return F.struct(collapse(F.regexp_replace(c, r"\([^()]*\)", "")).alias("title"), F.flatten(F.transform(people, lambda p: F.transform(F.split(p, r",|;|\band\b"), lambda x: F.trim(x)))).alias("people"))


def strip_flags(c: Column, flags: Sequence[str] = ("Pre", "FYF", "IP", "Y")) -> Column:
    return F.regexp_replace(c, f"^((?:{'|'.join(flags)}) )+", "")


def truncate_words(c: Column, n: int) -> Column:
    """At most n characters, cut at a word's end, with an ellipsis; a cut inside $...$ moves before it."""
    cut = F.regexp_replace(F.substring(c, 1, n), r"\s+\S*\z", "")
    cut = F.when(F.length(F.regexp_replace(cut, r"[^$]", "")) % 2 == 1, F.regexp_replace(cut, r"\s*\$[^$]*\z", "")).otherwise(cut)
    return F.when(F.length(c) > n, F.concat(cut, F.lit("…"))).otherwise(c)


def compact_number(c: Column) -> Column:
    """1640 as 1.6k; below 1000 as it is."""
    return F.when(c >= 1000, F.concat(F.regexp_replace(F.format_string("%.1f", c / 1000), r"\.0$", ""), F.lit("k"))).otherwise(c.cast("long").cast("string"))


def drop_math_fallback(c: Column) -> Column:
    """Plain text, of one word or several, that repeats a $$latex$$ span just before it goes, at every span."""
    squash = lambda x: F.regexp_replace(F.lower(x), r"[^a-z0-9]", "")
    pieces = F.split(c, r"\$\$")  # text, span, text, span, ...

    def follows(piece: Column, i: Column) -> Column:
        span = squash(F.get(pieces, i - 1))
        words = F.split(F.ltrim(piece), r"\s+")
        prefix = lambda n: squash(F.array_join(F.slice(words, F.lit(1), n), ""))
        n = F.array_position(F.transform(F.sequence(F.lit(1), F.size(words)), prefix), span)
        rest = F.array_join(F.slice(words, n.cast("int") + 1, F.size(words)), " ")
        return F.when((i % 2 == 0) & (i > 0) & (span != "") & (n > 0), F.when(rest == "", "").otherwise(F.concat(F.lit(" "), rest))).otherwise(piece)

    closed = F.size(pieces) % 2 == 1
    return F.when(closed & (F.size(pieces) > 1), F.array_join(F.transform(pieces, follows), "$$")).otherwise(c)


ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&copy;": "©", "&middot;": "·", "&amp;": "&"}


def unescape(c: Column, entities: Mapping[str, str] = ENTITIES) -> Column:
    """Common character references; &amp; comes last, so nothing is decoded twice."""
    for name, char in entities.items():
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def plain_text(c: Column) -> Column:
    return collapse(unescape(F.regexp_replace(c, "<[^>]+>", "")))


def first_of_each(entries: Column) -> Column:
    """A map from structs (key, value, ...); of entries with one key the first counts, those without a key go."""
    keyed = F.filter(entries, lambda e: e["key"].isNotNull())
    return F.map_from_entries(F.transform(distinct_by(keyed, lambda e: e["key"]), lambda e: F.struct(e["key"], e["value"])))
