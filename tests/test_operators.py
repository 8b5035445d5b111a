"""Operators against brute force, and properties of table maintenance."""

import random

from pyspark.sql import functions as F

from rosterspark.operators import aggregates as A
from rosterspark.operators import joins as J
from rosterspark.operators import ordered as O
from rosterspark.operators import reshape as R
from rosterspark.operators import tables as S


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_token_similarity_equals_brute_force(spark):
    rng = random.Random(1)
    word = lambda: rng.choice("abcdefghij")
    q = [(i, sorted({word() for _ in range(rng.randint(1, 7))})) for i in range(60)]
    t = [(i, sorted({word() for _ in range(rng.randint(1, 7))})) for i in range(50)]
    got = {r.qid: r.tid for r in J.token_similarity(spark.createDataFrame(q, "qid int, tokens array<string>"), spark.createDataFrame(t, "tid int, tokens array<string>")).collect()}
    want = {}
    for i, a in q:
        fits = []
        for j, b in t:
            inter, union = len(set(a) & set(b)), len(set(a) | set(b))
            if len(a) >= 2 and len(b) >= 2 and 5 * inter >= 4 * len(b) and 20 * inter >= 13 * union:
                fits.append((inter / len(b), inter / union, -j))
        if fits:
            want[i] = -max(fits)[2]
    assert got == want and want


def test_ordered_subset_equals_brute_force(spark):
    rng = random.Random(2)

    def words(n):
        return rng.sample("abcdefg", n)

    q = [(i, words(rng.randint(1, 6))) for i in range(80)]
    t = [(i, words(rng.randint(1, 6))) for i in range(80)]
    got = {r.qid: r.tid for r in J.ordered_subset(spark.createDataFrame(q, "qid int, tokens array<string>"), spark.createDataFrame(t, "tid int, tokens array<string>")).collect()}
    want = {}
    for i, a in q:
        fits = []
        for j, b in t:
            in_order = [w for w in a if w in b] == b
            if len(a) >= 3 and len(b) >= 3 and set(b) <= set(a) and len(a) - len(b) <= 1 and (in_order or (len(a) == len(b) and len(b) >= 5)):
                fits.append((len(b), -j))
        if fits:
            want[i] = -max(fits)[1]
    assert got == want and want


def test_ordered_subset_examples(spark):
    make = lambda name, *texts: spark.createDataFrame([(i, x.split()) for i, x in enumerate(texts)], f"{name} int, tokens array<string>")
    t = make("tid", "ieee transactions networking", "advances engineering software")
    q = make("qid", "ieee acm transactions networking", "advances software engineering")
    assert rows(J.ordered_subset(q, t).select("qid", "tid")) == [(0, 0)]


def test_scored_match_rules(spark):
    people = spark.createDataFrame([(1, "x", "ada", "berg"), (2, "x", "abe", "berg"), (3, "x", "eva", "haas"), (4, "y", "ada", "berg")], "person int, college string, first string, last string")
    m = spark.createDataFrame([(1, "x", "ada", "berg"), (2, "x", "a", "berg"), (3, "x", "zoe", "haas"), (4, "x", "zoe", "berg"), (5, "y", "a", "van berg"), (6, "x", "eva", "nobody")], "id int, college string, first string, last string")
    # 2: two people fit the initial; 3: the only Haas; 4: two Bergs, neither first name fits.
    assert rows(J.scored_match(m, people, "college"), "id") == [(1, 1), (3, 3), (5, 4)]
    assert rows(J.scored_match(m, people, "college", surname_only=False), "id") == [(1, 1), (5, 4)]


def test_trim_shared_edges(spark):
    head, foot = [f"h{i}" for i in range(6)], [f"f{i}" for i in range(5)]
    p = spark.createDataFrame([("g", 1, head + ["a"] + foot), ("g", 2, head + ["b", "c"] + foot), ("g", 3, ["x", "y"]), ("z", 4, head)], "grp string, page int, lines array<string>")
    # Page 3 is short and shares nothing: the first page is cut by the comparison with page 2.
    assert {r.page: r.lines for r in J.trim_shared_edges(p, "grp", "page", "lines").collect()} == {1: ["a"], 2: ["b", "c"], 3: ["x", "y"], 4: head}
    # Own titles before the header, which stands at another place in each page.
    offset = [["t1", *head, "a", "a2", *foot], ["t2", "more", *head, "b", *foot], ["t3", *head, "c", "c2", "c3", "c4", "c5"]]
    q = spark.createDataFrame([("g", i, x) for i, x in enumerate(offset)], "grp string, page int, lines array<string>")
    assert {r.page: r.lines for r in J.trim_shared_edges(q, "grp", "page", "lines").collect()} == {0: ["a", "a2"], 1: ["b"], 2: ["c", "c2", "c3", "c4", "c5"]}
    # Pages 1 and 2 share a header, 3 and 4 none with page 1, though 3 and 4 are long.
    other = lambda x: [f"{x}{i}" for i in range(14)]
    r = spark.createDataFrame([("g", 1, ["t", *head, *other("a")]), ("g", 3, other("c")), ("g", 4, other("d")), ("g", 2, ["u", *head, *other("b")]), (None, 1, ["t", *head, "x", "y", "z", "w"]), (None, 2, ["t", *head, "p", "q", "r"])], "grp string, page int, lines array<string>")
    got = {(x.grp, x.page): x.lines for x in J.trim_shared_edges(r, "grp", "page", "lines").collect()}
    assert got == {("g", 1): other("a"), ("g", 2): other("b"), ("g", 3): other("c"), ("g", 4): other("d"), (None, 1): ["x", "y", "z", "w"], (None, 2): ["p", "q", "r"]}


def test_partition_replace_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3)], "k string, v int")
    once = S.replace_partitions(old, new, ["k"])
    assert rows(once, "k", "v") == rows(S.replace_partitions(once, new, ["k"]), "k", "v") == [("a", 1), ("b", 3)]
    assert rows(S.replace_partitions(old, new.limit(0), ["k"]), "k", "v") == [("a", 1), ("b", 2)]


def test_write_partitions_keeps_others(spark, tmp_path):
    path = str(tmp_path / "t")
    S.write_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string"), path, ["k"])
    S.write_partitions(spark.createDataFrame([(3, "b")], "v int, k string"), path, ["k"])
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "a"), (3, "b")]


def test_meetings_merge_as_in_the_example(spark):
    s = spark.createDataFrame([(1, 1, "MWF", "11:00-11:50", "DANA 137"), (1, 2, "T", "13:00-15:50", ""), (2, 1, "R", "9:00", ""), (2, 2, "MT", "9:00", "")], "k int, p int, days string, time string, location string")
    assert rows(A.merge_meetings(s, ["k"], "p"), "k") == [(1, "MWF 11:00-11:50 (DANA 137); T 13:00-15:50"), (2, "MTR 9:00")]


def test_dedup_is_idempotent_and_unites(spark):
    d = spark.createDataFrame([(1, "x", ["b"], 2), (2, "x", ["a"], 1), (3, "y", ["c"], 1)], "id int, k string, names array<string>, r int")
    once = A.dedup_best(d, F.col("k"), [F.col("r"), F.col("id")], merge="names")
    assert rows(once.select("id", "names"), "id") == [(2, ["a", "b"]), (3, ["c"])]
    assert rows(A.dedup_best(once, F.col("k"), [F.col("r"), F.col("id")], merge="names").select("id", "names"), "id") == [(2, ["a", "b"]), (3, ["c"])]


def test_dominant_first_seen_on_tie(spark):
    d = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (2, "c", 3), (2, "d", 4), (2, "d", 5)], "k int, v string, p int")
    assert rows(A.dominant(d, "k", "v", "p"), "k") == [(1, "b", 1), (2, "d", 2)]


def test_h_index(spark):
    w = spark.createDataFrame([(1, c, 2020) for c in (10, 8, 5, 4, 3)] + [(2, 0, 2010)], "p int, c int, y int")
    got = {r.p: (r.cited, r.h, r.i10, r.h_recent) for r in A.citation_metrics(w, "p", "c", "y", 2015).collect()}
    assert got == {1: (30, 4, 1, 4), 2: (0, 0, 0, 0)}


def test_ordered_rows(spark):
    d = spark.createDataFrame([("d", i, x) for i, x in enumerate(["intro", "# A", "a1", "a2", "# B", "b1", "END", "tail"])], "doc string, pos int, line string")
    head = F.col("line").startswith("#")
    assert [r.h for r in O.carry_forward(d, "doc", "pos", head, h=F.col("line")).orderBy("pos").collect()] == [None, "# A", "# A", "# A", "# B", "# B", "# B", "# B"]
    assert [r.line for r in O.section(d, "doc", "pos", F.col("line") == "intro", F.col("line") == "END").orderBy("pos").collect()] == ["# A", "a1", "a2", "# B", "b1"]
    assert rows(O.fold_continuations(d, "doc", "pos", head, "line").select("line"), "head") == [("# A; a1; a2",), ("# B; b1; END; tail",)]
    assert [r.line for r in O.near_hits(d, "doc", "pos", F.col("line") == "# B", 2).orderBy("pos").collect()] == ["# B", "b1"]
    assert O.near_hits(d, "doc", "pos", F.col("line") == "none", 2).count() == 8


def test_latest_periods_clamps(spark):
    d = spark.createDataFrame([("g", y) for y in (2018, 2019, 2020, 2021, 2022)], "g string, y int")
    years = lambda **k: [r.y for r in O.latest_periods(d, "g", "y", 2, **k).orderBy("y").collect()]
    assert years() == [2021, 2022] and years(offset=2) == [2019, 2020] and years(offset=99) == [2018, 2019]


def test_matrix_and_grid(spark):
    d = spark.createDataFrame([("g", "x", 1, "u1"), ("g", "y", 2, None)], "g string, i string, t int, u string")
    got = {r.i: [(c.on, c.value) for c in r.cells] for r in R.offering_matrix(d, "g", "i", F.col("t"), F.col("u")).collect()}
    assert got == {"x": [(True, "u1"), (False, None)], "y": [(False, None), (True, None)]}
    several = spark.createDataFrame([("g", "x", 1, "v", 2), ("g", "x", 1, "u", 3), ("g", "x", 1, "", 1)], "g string, i string, t int, u string, n int")
    assert R.offering_matrix(several, "g", "i", F.col("t"), F.col("u"), "n").collect()[0].cells[0].value == "v"
    days = spark.createDataFrame([(1, 0, ["x", "", ""]), (1, 1, ["Time", "9:00", ""]), (1, 2, ["Mon", "CS1", "stray"]), (1, 3, ["Tue", "", ""])], "t int, r int, cells array<string>")
    assert rows(R.transposed(days, "t", "r", "cells", ["Mon", "Tue"])) == [(1, "Mon", "9:00", "CS1")]
    grid = spark.createDataFrame([("9:00", "CS101 A CS102 B", "")], "time string, Mon string, Tue string")
    cells = R.split_cell(R.unpivot_grid(grid, ["time"], ["Mon", "Tue"]), "cell")
    assert [r.cell.strip() for r in cells.orderBy("cell").collect()] == ["CS101 A", "CS102 B"]
    kv = spark.createDataFrame([(1, "a", "w", 3), (1, "a", "x", 2), (1, "a", None, 1), (1, "b", "y", 4), (2, "a", "z", 5)], "k int, n string, v string, p int").repartition(3)
    assert rows(R.columns_of(kv, "k", "n", "v", ["a", "b"], "p"), "k") == [(1, "x", "y"), (2, "z", None)]
    notes = spark.createDataFrame([(1, "CS101: Rings; CS102: Gears"), (2, "CS101: Other")], "p int, c string")
    assert rows(R.legend(notes, "c", "p"), "code") == [("CS101", "Rings"), ("CS102", "Gears")]
    grid = [
        "CS110 Rings and Gears CS111L Knots Time Monday", "CS112 L06 Someone CS113 9:00-9:50", "CS114 Loops (Hall 1)", "CS115 Data\nStructures 11:10 am", "CS115 Later", "CS116", "CS117 A Study of A", "xCS118 No CS119 Time", None,
    ]
    df = spark.createDataFrame(list(enumerate(grid)), "p int, c string")
    assert rows(R.legend(df, "c", "p"), "code") == [("CS110", "Rings and Gears"), ("CS111L", "Knots"), ("CS115", "Data Structures")]


def test_pruning_and_url_mode(spark):
    d = spark.createDataFrame([("g", "C1", 2015, ""), ("g", "C2", 2022, "u"), ("g", "C2", 2021, "v"), ("g", "C2L", 2022, "")], "g string, c string, y int, u string")
    assert sorted({r.c for r in A.prune_singletons(d, "g", "c", "y", F.lit(2019)).collect()}) == ["C2"]
    terms = spark.createDataFrame([("g", "C1", 2015, "F"), ("g", "C1", 2015, "S"), ("g", "C2", 2015, "F"), ("g", "C3", 2022, "F")], "g string, c string, y int, t string")
    assert sorted({r.c for r in A.prune_singletons(terms, "g", "c", "y", F.lit(2019), "t").collect()}) == ["C1", "C3"]  # periods count, not years
    assert rows(A.url_mode(d, "g", "c", "u")) == [("g", "per term")]
    ranks = spark.createDataFrame([("j", "Q2", 1), ("j", "Q1", 3), ("j", "Q1", 2), ("j", "-", 0), ("k", "", 1)], "k string, q string, n int")
    assert rows(A.best_by_key(ranks, ["k"], "q", "n")) == [("j", "Q1", 2), ("k", "", 1)]
    dashes = spark.createDataFrame([("j", "", 1), ("j", "-", 2), ("j", "odd", 0)], "k string, q string, n int")
    assert rows(A.best_by_key(dashes, ["k"], "q", "n")) == [("j", "-", 2)]  # a dash is a value, better than none


def test_alignment(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "k string, p int")
    b = spark.createDataFrame([("x", 1, "p"), ("x", 5, "q"), ("z", 1, "r")], "k string, p int, v string")
    assert rows(J.aligned(a, b, ["k"], "p").select("k", "p", "v"), "p") == [("x", 1, "p"), ("x", 2, "q")]
    assert sorted(r.k for r in J.misaligned(a, b, ["k"]).collect()) == ["y", "z"]


def test_uncovered_blank_term_covers_year(spark):
    done = spark.createDataFrame([("g", "2020-21", ""), ("g", "2021-22", "F")], "g string, y string, t string")
    new = spark.createDataFrame([("g", "2020-21", "S"), ("g", "2021-22", "F"), ("g", "2021-22", "S")], "g string, y string, t string")
    assert rows(J.uncovered(new, done, "y", "t", "g").select("y", "t")) == [("2021-22", "S")]


def test_blocks_hand_on_what_they_have_seen(spark):
    rng = random.Random(5)
    data = [(d, p, rng.choice(["# h", "x", "y", "start", "stop"])) for d in ("a", "b", None) for p in range(60)]
    df = spark.createDataFrame(data, "doc string, pos int, line string").repartition(5)
    head, start, stop = F.col("line") == "# h", F.col("line") == "start", F.col("line") == "stop"
    for block in (1, 7, 1000):
        carried = {(r.doc, r.pos): r.at for r in O.carry_forward(df, "doc", "pos", head, block, at=F.when(F.col("pos") % 3 > 0, F.col("pos"))).collect()}
        inside = {(r.doc, r.pos) for r in O.section(df, "doc", "pos", start, stop, block).collect()}
        folded = {(r.doc, r.head): (r.line, r.rows) for r in O.fold_continuations(df, "doc", "pos", head, "line", block=block).collect()}
        want_carried, want_inside, want_folded = {}, set(), {}
        for doc in ("a", "b", None):
            at, is_in, now = None, False, None
            for d, p, line in data:
                if d != doc:
                    continue
                at = (p if p % 3 else None) if line == "# h" else at
                want_carried[d, p] = at
                is_in = True if line == "start" else False if line == "stop" else is_in
                if is_in and line != "start":
                    want_inside.add((d, p))
                now = p if line == "# h" else now
                if now is not None:
                    want_folded.setdefault((d, now), []).append(line)
        assert carried == want_carried and inside == want_inside
        assert folded == {k: ("; ".join(dict.fromkeys(v)), len(v)) for k, v in want_folded.items()}


def test_places_and_pages(spark):
    rng = random.Random(6)
    data = [(rng.choice(["g", "h", None]), rng.randint(0, 50), i) for i in range(300)]
    df = spark.createDataFrame(data, "grp string, k int, i int").repartition(7)
    got = sorted((r.place, r.k, r.i) for r in O.numbered(df, ["k", "i"]).collect())
    assert got == [(n, k, i) for n, (k, i) in enumerate(sorted((k, i) for _, k, i in data))]
    inner = {(r.grp, r.i): r.place for r in O.numbered(df, ["k", "i"], "grp").collect()}
    for g in ("g", "h", None):
        assert [inner[g, i] for _, i in sorted((k, i) for x, k, i in data if x == g)] == list(range(sum(x == g for x, _, _ in data)))
    assert [r.i for r in O.page(df, ["i"], 2, 20).orderBy("place").collect()] == list(range(40, 60))
    assert O.numbered(df.limit(0), ["k"]).collect() == [] and O.page(df, ["i"], 99).collect() == []


def test_chunks_are_bounded_and_come_together(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise("rare").alias("g"), F.col("id").alias("pos"), F.concat(F.lit("n"), "id").alias("name"))
    chunks = R.nest_chunks(df, "g", "pos", ["name"], "people", 64)
    assert max(len(r.people) for r in chunks.collect()) == 64
    assert rows(R.chunk_manifest(chunks, "g", "people"), "g") == [("hot", 15, 900), ("rare", 2, 100)]
    assert [r.name for r in R.unchunked(chunks, "g", "people").where("g = 'hot'").orderBy("place").collect()] == [f"n{i}" for i in range(1000) if i % 10]


def test_candidates_from_their_items(spark):
    items = [("p", c, n, name, title, link) for n, (c, found) in enumerate({"row": [("Ada", True, None), ("Ada", True, "u")], "card": [("Ada", True, "u"), ("Bo", True, None), (None, True, "u")], "wide": [("Ada", True, "u"), ("Bo", True, None), ("Cy", False, "u"), (None, None, None)]}.items()) for name, title, link in found]
    items += [("q", "one", 0, "Ada", True, None), ("r", "one", 0, "Ada", True, "u"), ("s", "b", 1, "Ada", True, "u"), ("s", "b", 1, "Bo", True, "u"), ("s", "a", 2, "Eva", True, "u"), ("s", "a", 2, "Cy", True, "u")]
    df = spark.createDataFrame(items, "page string, cand string, n int, name string, titled boolean, link string")
    scores = {r.cand: tuple(r.score) for r in A.candidate_scores(df.where("page = 'p'"), "page", "cand", "n").collect()}
    assert scores == {"row": (1, 5, -1, 0, -2), "card": (2, 5, 0, -1, -3), "wide": (2, 5, 0, -2, -4)}
    # One person without a link is too little; of equal ones the first counts.
    assert {r.page: r.cand for r in A.best_scored(df, "page", "cand", "n").collect()} == {"p": "card", "r": "one", "s": "b"}
