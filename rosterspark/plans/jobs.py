"""What a user calls: page cleaning, publication linking, venue tagging, offerings, directories and search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import fields as X
from ..functions import text as T
from ..operators import aggregates as A
from ..operators import filters as P
from ..operators import joins as J
from ..operators import ordered as O
from ..operators import reshape as R
from ..operators import tables as S
from ..sources.web import visible_text
from . import search as Q


def clean_pages(pages: DataFrame, keywords: Sequence[str] = K.PAGE_KEYWORDS, ending: str = ".edu") -> DataFrame:
    """Text of people's pages (college, name, url, html) without what the pages of a site share and without noise lines.

    Headers and footers are cut on the college's own hosts (by their ending), among the pages of its largest folder, or folders of equal size, if that holds two pages or
    more; all other pages keep theirs. Then lines stay that follow a mention of the person's first or last name or of a key word; pages without any keep all.
    Lines that repeat on many pages of the college go last. Out: college, name, url, text (null where nothing is left). A url is one page.
    """
    text = pages.select("college", "name", "url", X.page_group(F.col("url")).alias("site"), visible_text(F.col("html")).alias("text")).where("text is not null").withColumn("lines", F.split("text", "\n")).drop("text")
    text = S.staged(text, "page-lines")
    own = text.where(P.is_campus_page(F.col("url"), ending) & (X.path(F.col("url")).rlike("[^/]")))
    largest = A.largest_groups(own, "college", "site").select("college", "site")
    inside = own.join(largest, ["college", "site"], "left_semi")
    trimmed = J.trim_shared_edges(inside.withColumn("folder", F.struct("college", "site")), "folder", "url", "lines").drop("folder").unionByName(text.join(inside.select("college", "url").distinct(), ["college", "url"], "left_anti"))
    lines = trimmed.select("college", "name", "url", F.posexplode("lines").alias("pos", "line")).where(F.length("line") > 0)
    words = T.tokens(F.lower("name"))
    parts = F.filter(F.array(F.try_element_at(words, F.lit(1)), F.try_element_at(words, F.lit(-1))), lambda t: F.length(t) >= 2)  # blank parts of a name match nothing
    hit = F.lower("line").rlike("|".join(keywords)) | F.coalesce(F.exists(parts, lambda p: F.contains(F.lower("line"), p)), F.lit(False))
    near = O.near_hits(lines, "url", "pos", hit).where(~P.is_noise_line(F.col("line")) & ~P.has_multiple_fields(F.col("line")))
    rare = A.drop_frequent_lines(near, "college", "url", "line")
    joined = rare.groupBy("url").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda s: s["line"]), "\n").alias("text"))
    return pages.select("college", "name", "url").join(joined, "url", "left").select("college", "name", "url", "text")


#: What works may lack, with their types.
WORK_FIELDS = {
    "doi": "string", "cited_by_count": "int", "primary_location": "struct<landing_page_url:string,raw_source_name:string,source:struct<id:string,display_name:string,type:string>>",
    "topics": "array<struct<display_name:string,subfield:struct<display_name:string>>>",
}


def link_publications(works: DataFrame, roster: DataFrame, peers: DataFrame) -> DataFrame:
    """Works (id, title, type, publication_year, authorships and WORK_FIELDS) with the people of a roster (name, college, inst, pos) who wrote them.

    A person matches an author of their institution by surname and initial. Of a college's works with one title the best stays, by type (K.WORK_RANK), then
    the earlier year, then id; the matched names of all of them are united. The best work's other authors are its co-authors, each in one class (see
    J.coauthor_classes; peers: name), in the order of the authors. An author who matches isn't a co-author; one without id is known by the place in the list.
    """
    works = works.withColumns({c: F.lit(None).cast(t) for c, t in WORK_FIELDS.items() if c not in works.columns})
    # Works may come from a long plan; they, their authors and the best works are read several times, but made once.
    works = S.staged(works.select("id", "title", "type", "publication_year", "authorships", *WORK_FIELDS), "works")
    named = F.col("a.author.display_name")
    institutions = F.coalesce("a.institutions", F.array().cast("array<struct<ror:string,display_name:string>>"))
    titled = works.select("id", "title", "type", F.col("publication_year").alias("year"), X.paper_key(F.col("title"), F.col("id")).alias("key"), "authorships")
    spread = titled.select("id", "title", "type", "year", "key", F.posexplode("authorships").alias("at", "a"))
    authors = spread.select(
        "id", "title", "type", "year", "key", "at", named.alias("name"), F.coalesce(F.nullif(F.col("a.author.id"), F.lit("")), F.concat(F.lit("at "), "at")).alias("author"),
        F.transform(institutions, lambda i: i["ror"]).alias("insts"), F.transform(institutions, lambda i: i["display_name"]).alias("names"), T.name_key(named).alias("k"),
        F.coalesce(F.lower(F.try_element_at(T.tokens(named), F.lit(-1))), F.lit("")).alias("last"),
    )
    authors = S.staged(authors, "work-authors")
    people = roster.withColumn("k", T.name_key(F.col("name"))).where("k is not null")
    keyed = people.groupBy("inst", "k").agg(F.max_by(F.struct("name", "college"), "pos").alias("p"))
    # A row for each match: what they have in common is united in one grouping, that of the titles.
    found = authors.where("k is not null").select("id", "title", "type", "year", "key", "k", F.explode(F.array_distinct("insts")).alias("inst")).join(keyed, ["inst", "k"])
    rows = found.select("id", "title", "type", "year", "key", "p.college", "inst", F.array("p.name").alias("matched"))
    order = F.element_at(F.create_map(*[F.lit(x) for pair in K.WORK_RANK.items() for x in pair]), F.col("type"))
    best = A.dedup_best(rows, F.struct("college", "key"), [F.coalesce(order, F.lit(1)), F.coalesce("year", F.lit(9999)), F.col("id"), F.col("inst")], merge="matched")
    best = S.staged(best.drop("key"), "linked-works")
    matches = F.array_contains("insts", F.col("home")) & (F.col("p.college") == F.col("college"))
    met = best.select("id", "college", F.col("inst").alias("home")).join(authors.select("id", "at", "name", "author", "insts", "names", "k", "last"), "id").join(keyed.withColumnRenamed("inst", "home"), ["home", "k"], "left")
    met = S.staged(met.withColumn("own", F.coalesce(matches, F.lit(False))).drop("k", "p"), "linked-authors")
    # An author who matches at one place of the list is none at others.
    co = met.where("not own").join(met.where("own").select("id", "college", "author").distinct(), ["id", "college", "author"], "left_anti")
    surnames = roster.select("inst", F.lower(F.try_element_at(T.tokens(F.col("name")), F.lit(-1))).alias("last"))
    classed = J.coauthor_classes(co.select("id", "college", "home", "at", "name", "insts", "names", "last"), "home", peers, surnames)
    kinds = ("student", "faculty", "other", "external")
    listed = lambda k: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("at", "name")))), lambda s: s["name"]).alias(f"{k}_coauthors")
    lists = classed.groupBy("id", "college").agg(*[listed(k) for k in kinds])
    filled = lambda c: F.array_distinct(F.filter(c, lambda x: F.coalesce(x, F.lit("")) != ""))
    place = F.col("primary_location")
    about = [
        "cited_by_count", X.work_url(F.col("doi"), place).alias("url"), X.work_venue(place).alias("venue"), F.coalesce(place["source"]["id"], F.lit("")).alias("venue_url"), X.work_venue_type(place).alias("venue_type"),
        filled(F.transform("topics", lambda t: t["display_name"])).alias("topics"), filled(F.transform("topics", lambda t: t["subfield"]["display_name"])).alias("subfields"), X.authors_of(F.col("authorships")).alias("authors"),
    ]
    none = F.array().cast("array<string>")
    out = best.drop("inst").join(lists, ["id", "college"], "left").withColumns({f"{k}_coauthors": F.coalesce(f"{k}_coauthors", none) for k in kinds})
    # Fields are derived for the works that are left.
    return out.join(works.select("id", "authorships", *WORK_FIELDS), "id").select(*out.columns, *about)


def tag_venues(
    publications: DataFrame, rules: Sequence[tuple[str, str, Sequence[str], Sequence[str]]], conferences: DataFrame, journals: DataFrame, ranked_as: dict[str, str] = K.RANKED_AS, curated: dict[str, str] = K.CURATED_QUARTILES
) -> DataFrame:
    """Publications (venue, venue_type) with acronym, area and listed (by rules), conference rank with its link, and journal quartile with ISSN and link.

    conferences: acronym, title, rank, pos and, if known, url. journals: title, quartile, pos and, if known, issn and url. Ranks come by the rule's acronym (as
    `ranked_as` calls it in the list), by one in parentheses, or by the title's tokens; each step sees only venues left by those before. Journals and book series
    whose name isn't that of a conference have no rank by title. A rank's acronym fills in where no rule gave one; after that, findings volumes take their parent's
    rank and name. Quartiles are for journals: by equal normal forms, or ordered subsets; of several entries of a journal the best counts, "-" is a value
    like others, and curated journals stand in for those that the list lacks. What isn't found is null.
    """
    publications = publications.withColumns({"venue_type": F.lit(None).cast("string")} if "venue_type" not in publications.columns else {})
    conferences = conferences.withColumns({"url": F.lit(None).cast("string")} if "url" not in conferences.columns else {})
    journals = journals.withColumns({c: F.lit(None).cast("string") for c in ("issn", "url") if c not in journals.columns})
    kind = F.col("venue_type")
    venues = publications.where("coalesce(venue, '') <> ''").groupBy("venue").agg(
        F.coalesce(F.bool_or(kind == "journal"), F.lit(False)).alias("journal"), F.coalesce(F.bool_or(kind.isin("journal", "book series")), F.lit(False)).alias("serial"),
    )
    # Different venues are far fewer than publications; they are tagged once and read by every step.
    venues = S.staged(venues.withColumn("tag", J.first_rule(F.col("venue"), rules)), "venues")
    link = F.col("venue").startswith("http")
    rank = F.element_at(F.create_map(*[F.lit(x) for p in K.RANK_ORDER.items() for x in p]), F.col("rank"))
    ranks = S.staged(A.best_entry_keys(conferences, "acronym", "title", [rank, F.col("pos")]).select("key", "title", "pos", F.struct(F.col("key").alias("acronym"), "rank", F.col("url").alias("rank_url")).alias("match")), "venue-ranks")
    by_key = lambda df, acronym: df.withColumn("key", acronym).join(ranks.select("key", "match"), "key")
    tagged = lambda df: df.join(venues, "venue")
    renamed = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in ranked_as.items() for x in p]), F.col("tag.label")), F.col("tag.label")) if ranked_as else F.col("tag.label")
    in_brackets = F.nullif(F.rtrim(F.regexp_extract("venue", r"\(([A-Z][A-Za-z&/+\-]{1,15})(?:[\s\-]*\d{0,4})?\)", 1)), F.lit(""))
    titles = ranks.select(F.col("pos").alias("tid"), T.title_tokens(F.col("title")).alias("tokens"))

    def by_title(df: DataFrame) -> DataFrame:
        fits = tagged(df).where(~link & ~(F.col("serial") & ~F.col("venue").rlike(K.CONFERENCE_WORDS)))
        spread = fits.select("venue", F.explode(F.array(*[F.struct(F.lit(n).alias("variant"), T.title_tokens(F.col("venue"), p).alias("tokens")) for n, p in enumerate((T.ANY_WORD, T.ORDINAL_ONLY))])).alias("v"))
        hits = J.token_similarity(spread.select(F.struct("venue", "v.variant").alias("qid"), "v.tokens"), titles)
        one = hits.groupBy("qid.venue").agg(F.max_by("tid", F.struct("recall", "jaccard", -F.col("qid.variant"), -F.col("tid"))).alias("tid"))
        return one.join(ranks.select(F.col("pos").alias("tid"), "match"), "tid")

    steps = [lambda df: by_key(tagged(df).where("tag is not null"), renamed), lambda df: by_key(df.where(~link), in_brackets), by_title]
    core = J.cascade(venues, "venue", steps).select("venue", F.col("match").alias("core"))
    parent = F.upper(X.findings_parent(F.col("venue")))
    own = F.coalesce("tag.label", "core.acronym")
    parents = ranks.select(F.col("key").alias("parent"), F.col("match").alias("above"))
    named = venues.join(core, "venue", "left").withColumn("parent", F.when(own.isNull(), parent)).join(parents, "parent", "left")
    volume = F.col("above").isNotNull() | F.coalesce(F.col("parent").isin(K.FINDINGS_PARENTS), F.lit(False))
    acronym = F.when(volume, F.concat("parent", F.lit(" (Findings)"))).otherwise(own)
    named = named.select("venue", acronym.alias("acronym"), F.col("tag.area").alias("area"), F.col("tag").isNotNull().alias("listed"), F.coalesce("core.rank", "above.rank").alias("rank"), F.coalesce("core.rank_url", "above.rank_url").alias("rank_url"))

    spark = publications.sparkSession
    fillers = spark.createDataFrame([(key, quartile, (1 << 40) + n) for n, (key, quartile) in enumerate(curated.items())], "key string, quartile string, pos long")
    keyed = journals.select(T.journal_key(F.col("title")).alias("key"), "quartile", F.col("pos").cast("long").alias("pos"), "issn", "url")
    best = S.staged(A.with_fillers(A.best_by_key(keyed, ["key"], "quartile", "pos"), fillers, ["key"]).select("key", F.col("pos").alias("tid"), F.struct("quartile", "issn", F.col("url").alias("journal_url")).alias("match")), "journal-ranks")
    exact = lambda df: df.withColumn("key", T.journal_key(F.col("venue"))).join(best.select("key", "match"), "key")

    def subset(df: DataFrame) -> DataFrame:
        hits = J.ordered_subset(df.select(F.col("venue").alias("qid"), T.journal_tokens(T.journal_key(F.col("venue"))).alias("tokens")), best.select("tid", T.journal_tokens(F.col("key")).alias("tokens")))
        return hits.join(best, "tid").select(F.col("qid").alias("venue"), "match")

    sjr = J.cascade(venues.where("journal"), "venue", [exact, subset]).select("venue", "match.quartile", "match.issn", "match.journal_url")
    return publications.join(named, "venue", "left").join(sjr, "venue", "left")


def resolve_ids(papers: DataFrame, roster: DataFrame) -> DataFrame:
    """The author id that most papers give each person of a roster (name, college).

    papers: paper, college, matched array<string>, authors array<struct<name,id,affiliations>>, pos. Names meet by surname and initial.
    """
    people = papers.select("paper", "college", "pos", F.explode("matched").alias("name")).withColumn("k", T.name_key(F.col("name")))
    authors = papers.select("paper", "college", F.explode("authors").alias("a")).where(F.array_contains("a.affiliations", F.col("college")) & (F.coalesce("a.id", F.lit("")) != ""))
    authors = authors.select("paper", "college", "a.id", T.name_key(F.col("a.name")).alias("k"))
    pairs = people.join(authors, ["paper", "college", "k"]).select(F.struct("college", "name").alias("person"), "id", "pos")
    ids = A.dominant(pairs, "person", "id", "pos").select("person.college", "person.name", "id", "n")
    return roster.join(ids, ["college", "name"], "left")


def verify_profiles(roster: DataFrame, profiles: DataFrame, done: DataFrame) -> DataFrame:
    """A status for each person of the roster (name, college, url, pos): how far the profile (url, profile_name, affiliation) agrees.

    done: name, college, status of earlier runs; statuses other than blank and rescrape are kept.
    """
    kept = S.roster_sync(roster, done, ["name", "college"], "status", "pos")
    level = X.match_level(T.letters(F.col("name")), T.letters(F.col("profile_name")), T.letters(F.col("college")), T.letters(F.col("affiliation")))
    found = kept.withColumn("url", X.first_listed(F.col("url"))).join(profiles, "url", "left")
    new = F.when(F.coalesce("url", F.lit("")) == "", "no_url").when(F.col("profile_name").isNull(), "fetch_error").otherwise(level)
    return found.withColumn("status", F.when(P.needs_processing(F.col("status")), new).otherwise(F.col("status")))


def build_offerings(rows: DataFrame, people: DataFrame) -> DataFrame:
    """Offering matrices of each college from its course rows, with the people who teach.

    rows: college, academic_year, term, course_code, course_name, instructor, url, pos (the row's place in its file, which decides what comes first).
    people: person, college, name. Out: college, code, name, url (one link for the code), axis, cells (on, value = link of that period),
    instructors aligned with the axis, in the colleges' natural order of codes. A college has links of periods if one of its codes has two, else
    links of codes, and none if all its codes share one.
    """
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    clean = rows.withColumns({"course_code": blank("course_code"), "course_name": F.regexp_replace(blank("course_name"), '^"+|"+$', ""), "url": F.nullif(blank("url"), F.lit("")), "instructor": blank("instructor")})
    # Read once; all steps below start from these rows.
    wanted = (P.has_prefix(F.col("course_code")) & ~P.is_excluded(F.col("course_name"))).alias("wanted")
    inside = S.staged(clean.where(P.in_years(F.col("academic_year"), F.col("term"))).select("college", "academic_year", "term", "course_code", "course_name", "instructor", "url", "pos", wanted), "course-rows")
    # The cutoff counts every row of an allowed year and term; the axis those of codes that are dropped later, but not of excluded names.
    cutoff = inside.agg(X.academic_year(F.max(F.substring("academic_year", 1, 4).try_cast("int")) - 3)).scalar()
    kept = inside.where("wanted")
    keys, period = ["college", "course_code"], F.struct("academic_year", X.term_rank(F.col("term")).alias("rank"), "term")
    # Names, axis and pruning need each name of a code and period once.
    called = S.staged(kept.groupBy(*keys, "academic_year", "term", "course_name").agg(F.min("pos").alias("pos")), "course-names")
    axis = R.axis(called.select("college", "academic_year", "term").distinct(), "college", period)
    lecture = (F.col("course_name") != "") & ~P.is_lab_only(F.col("course_name"))
    latest = F.max_by(F.when(lecture, F.col("course_name")), F.when(lecture, F.struct("academic_year", X.term_rank(F.col("term")), -F.col("pos"))))
    # Codes that have names, but only those of labs, go.
    names = called.groupBy(*keys).agg(latest.alias("name"), F.bool_or(F.col("course_name") != "").alias("named")).where("name is not null or not named").select(*keys, F.coalesce("name", F.lit("")).alias("name"))
    stay = A.prune_singletons(called, "college", "course_code", "academic_year", cutoff, "term").select(*keys).distinct()
    names = S.staged(names.join(stay, keys, "left_semi"), "course-codes")
    pruned = kept.join(names, keys, "left_semi")
    cells = S.staged(pruned.groupBy(*keys, period.alias("period")).agg(F.min_by("url", F.when(F.col("url").isNotNull(), F.col("pos"))).alias("url")), "course-cells")
    linked = cells.join(A.url_mode(cells, "college", "course_code", "url"), "college")
    value = F.when(F.col("mode") == "per term", F.col("url")).alias("value")
    maps = linked.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("period", value))).alias("m"), F.max(F.when(F.col("mode") == "per code", F.col("url"))).alias("url"))
    # Different lists of instructors are fewer than rows; only they are split, read and resolved.
    listed = S.staged(pruned.select(*keys, "academic_year", "term", "instructor").distinct(), "course-instructors")
    mentions = listed.select("college", "instructor").distinct().select("college", "instructor", F.explode(T.split_people(F.col("instructor"))).alias("who")).withColumn("p", T.parse_person(F.col("who"))).where("p is not null")
    mentions = S.staged(mentions.withColumn("id", F.struct("college", "who")), "course-people")
    known = people.select("person", "college", T.parse_person(F.col("name")).alias("p")).where("p is not null").select("person", "college", "p.first", "p.last")
    resolved = J.scored_match(mentions.select("id", "college", "p.first", "p.last").distinct(), known, "college")
    persons = mentions.join(resolved, "id").select("college", "instructor", "person").distinct()
    taught = listed.join(persons, ["college", "instructor"]).groupBy(*keys, period.alias("period")).agg(F.array_sort(F.collect_set("person")).alias("people"))
    teachers = taught.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("period", "people"))).alias("t"))
    out = names.join(maps, keys).join(axis, "college").join(teachers, keys, "left")
    on = F.transform("axis", lambda p: F.struct(F.map_contains_key("m", p).alias("on"), F.element_at("m", p).alias("value")))
    who = F.transform("axis", lambda p: F.element_at("t", p))
    return out.select("college", F.col("course_code").alias("code"), "name", "url", "axis", on.alias("cells"), who.alias("instructors")).orderBy("college", X.natural_key(F.col("code")))


def merge_offerings(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """New (college, year, term) partitions replace old ones; equal rows once; sorted by college, year, term and code."""
    merged = S.replace_partitions(S.canonical(old, columns), S.canonical(new, columns), ["college", "academic_year", "term"])
    return merged.orderBy("college", "academic_year", X.term_rank(F.col("term")).asc_nulls_last(), "course_code", "section")


def build_directory(colleges: DataFrame, faculty: DataFrame, publications: DataFrame, courses: DataFrame) -> DataFrame:
    """One nested document for each college that has people: totals, faculty, publications and courses, blanks as null."""
    filled = lambda df: df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" and c != "college" else F.col(c) for c, t in df.dtypes])
    people = filled(faculty).withColumn("category", T.title_category(F.col("title")))
    totals = A.totals(people, "college", P.is_trusted(F.col("status")), "citations")
    nest = lambda df, order, name: R.nest(df, "college", order, [c for c in df.columns if c not in ("college", order)], name)
    return J.star(totals, "college", filled(colleges), nest(people, "pos", "faculty"), nest(filled(publications), "pos", "publications"), nest(filled(courses), "pos", "courses"))


def search_directory(colleges: DataFrame, faculty: DataFrame, publications: DataFrame, courses: DataFrame, words: Sequence[str], **facets: object) -> DataFrame:
    """What all words find in the tables of a directory: kind, id, paths. Tables and rules: see `search`; facets: see `search.shown`.

    Looks through all texts of what the facets show; for many searches, give them together (`search.search_each`), or write the directory with its postings
    once (`search.write_directory`) and search what is read back.
    """
    return Q.search(Q.directory(colleges, faculty, Q.shown_publications(publications, **facets), courses), words)


def sectionise_lines(lines: DataFrame, start: str, stop: str, heading: str, record: str) -> DataFrame:
    """Records of line dumps (doc, pos, line): inside a section, under their heading, with continuation lines folded in and read around their time."""
    inside = O.section(lines, "doc", "pos", F.col("line").rlike(start), F.col("line").rlike(stop))
    titled = O.carry_forward(inside, "doc", "pos", F.col("line").rlike(heading), heading=F.trim("line")).where(~F.col("line").rlike(heading))
    folded = O.fold_continuations(titled, "doc", "pos", F.col("line").rlike(record), "line", " ")
    heads = titled.select("doc", F.col("pos").alias("head"), "heading")
    return folded.join(heads, ["doc", "head"]).select("doc", F.col("head").alias("pos"), "heading", "line", X.anchored(F.col("line")).alias("at"))
