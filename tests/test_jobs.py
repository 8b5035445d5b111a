"""Sources, jobs and streams on small invented tables."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterspark.plans import classify, jobs
from rosterspark.sources import records, tabular, web
from rosterspark.streaming import ingest


def test_csv_blanks_and_header_only(spark, tmp_path):
    (tmp_path / "A College.csv").write_text('a,b\n"x, ""y""",\n"two\nlines",z\n')
    (tmp_path / "B.csv").write_text("a,b\n")
    df = tabular.read_csv(spark, str(tmp_path), ["a", "b"])
    assert sorted(map(tuple, df.collect())) == [("two\nlines", "z"), ('x, "y"', "")]
    assert {r.origin for r in tabular.with_origin(df).collect()} == {"A College"}


def test_publish_versions(spark, tmp_path):
    root = str(tmp_path / "pub")
    tabular.publish(spark.range(1), root, "1")
    assert tabular.publish(spark.range(3), root, "2").count() == 3


def test_split_document(spark):
    schema = T._parse_datatype_string("struct<state:string,faculty:array<struct<name:string>>>")
    df = spark.createDataFrame([('{"X":{"state":"ME","faculty":[{"name":"Ada"},{"name":"Eva"}]}}',)], "doc string")
    parts = tabular.split_document(df, "doc", schema)
    assert parts["college"].collect()[0].state == "ME" and [r["name"] for r in parts["faculty"].orderBy("pos").collect()] == ["Ada", "Eva"]


def test_json_and_xml(spark, tmp_path):
    df = spark.createDataFrame([("s", '[{"code":"CS 1","n":{"x":"y"}},{"code":"CS 2"}]')], "source string, payload string")
    out = records.flatten_json(df, "payload", "array<struct<code:string,n:struct<x:string>>>", {"code": "code", "extra": "n.x"})
    assert sorted(map(tuple, out.collect())) == [("s", "CS 1", "y"), ("s", "CS 2", "")]
    (tmp_path / "c.xml").write_text("<all><course><title>A &lt;b&gt;Ring&lt;/b&gt;</title></course><course><title>B</title></course></all>")
    xml = records.read_xml(spark, str(tmp_path / "c.xml"), "course", {"name": "title"}, "title string")
    assert sorted(r.name for r in xml.collect()) == ["A Ring", "B"]


def test_parsers_by_source_isolate_failures(spark):
    df = spark.createDataFrame([("good", "a"), ("bad", "b")], "source string, payload string")

    def broken(pdf):
        raise ValueError("no table")

    def picky(pdf):
        if (pdf.payload == "x").any():
            raise KeyError("x")
        return pdf.assign(code=pdf.payload, name=str(len(pdf)))

    many = spark.createDataFrame([("p", x) for x in "axb"], "source string, payload string").coalesce(1)
    ok, failed = records.by_source(many, {"p": picky}, ["code", "name"])
    assert sorted(map(tuple, ok.collect())) == [("p", "a", "1"), ("p", "b", "1")] and [r.error for r in failed.collect()] == ["KeyError: 'x'"]
    good, bad = records.by_source(df, {"good": lambda pdf: pdf.rename(columns={"payload": "code"}), "bad": broken}, ["code", "name"])
    assert list(map(tuple, good.collect())) == [("good", "a", "")] and bad.collect()[0].error == "ValueError: no table"


def test_tables_of_pages(spark):
    html = "<body><script>x</script><table><tr><th>Metric</th><th>All</th><th>Recent</th></tr><tr><td>h-index</td><td>7</td><td> 3 </td></tr></table><p hidden>no</p><p>A &amp; B</p></body>"
    df = spark.createDataFrame([(1, html), (2, "no body")], "page int, html string")
    assert df.select(web.visible_text(F.col("html")).alias("t")).collect()[0].t.split("\n")[-1] == "A & B"
    assert df.select(web.visible_text(F.col("html")).alias("t")).collect()[1].t is None
    m = web.metrics(df, "page", "html").collect()[0].metrics
    assert (m["h-index"]["all"], m["h-index"]["recent"]) == (7, 3)
    twice = "<body><h1>Ada</h1><table><tr><td>h</td><td>7</td><td>3</td></tr><tr><td>H</td><td>8</td><td>4</td></tr></table>" + "".join(f'<span class="year">{y}</span><span class="count">{n}</span>' for y, n in ((2020, 1), (2020, 2), (2021, 3)))
    r = web.profile(spark.createDataFrame([(1, twice)], "page int, html string"), "page", "html").collect()[0]
    assert (r["name"], r.by_year, r.metrics["h"]["all"]) == ("Ada", {2020: 1, 2021: 3}, 7)


def test_lines_and_words(spark):
    dump = ["Code   Title", "-----  ------", "CS 1   Rings", "", "CS 2   Gears and more"]
    lines = spark.createDataFrame([("d", i, x) for i, x in enumerate(dump)], "doc string, pos int, line string")
    assert [(r.code, r.title) for r in web.fixed_width(lines, "doc", "pos", "line", ["code", "title"]).orderBy("pos").collect()] == [("CS 1", "Rings"), ("CS 2", "Gears and more")]
    cells = [["Code", "Name"], ["CS 1", "Rings"], ["", ""], ["CS 9", "lost"], ["Name", "Code"], ["Gears", "CS 2"]]
    df = spark.createDataFrame([("d", i, c) for i, c in enumerate(cells)], "doc string, pos int, cells array<string>")
    got = web.repeated_headers(df, "doc", "pos", "cells", F.array_contains("cells", "Code"))
    assert [(r.row["Code"], r.row["Name"]) for r in got.orderBy("pos").collect()] == [("CS 1", "Rings"), ("CS 2", "Gears")]
    same = spark.createDataFrame([("d", 0, ["Code", "Code", None]), ("d", 1, ["a", "b", "c"])], "doc string, pos int, cells array<string>")
    assert [r.row for r in web.repeated_headers(same, "doc", "pos", "cells", F.array_contains("cells", "Code")).collect()] == [{"Code": "a"}]
    old_new = spark.createDataFrame([("d", i, c) for i, c in enumerate([["x"], ["CRN", "A"], ["1", "2"], ["Course Section", "B"], ["3", "4"], ["5", "6"]])], "doc string, pos int, cells array<string>")
    got = web.with_layout(old_new, "doc", "pos", "cells", {"CRN": "old", "Course Section": "new"}).orderBy("pos").collect()
    assert [(r.cells[0], r.layout, r.header[1]) for r in got] == [("1", "old", "A"), ("3", "new", "B"), ("5", "new", "B")]
    words = spark.createDataFrame([(1, "Rings", 60.0, 90.0, 10.2), (1, "CS", 0.0, 10.0, 10.0), (1, "1", 12.0, 15.0, 10.1)], "page int, text string, x0 double, x1 double, top double")
    bounds = spark.createDataFrame([("code", 0.0, 50.0), ("name", 50.0, 200.0)], "col string, lo double, hi double")
    assert sorted((r.col, r.text) for r in web.word_table(words, bounds).collect()) == [("code", "CS 1"), ("name", "Rings")]
    odd = spark.createDataFrame([("", "Rings")], "`Course Code` string, `TITLE ` string")
    assert list(map(tuple, web.rename_by_alias(odd, {"code": ["course code"], "name": ["title"], "time": []}).collect())) == [("", "Rings", "")]


def test_clean_pages(spark):
    shell = lambda inner: f"<body><p>North College</p><p>Menu</p><p>About us all</p><p>Visit campus now</p><p>People here</p>{inner}<p>Copyright 2020 x</p></body>"
    pages = [("X", f"Ada Berg{i}", f"https://x.edu/p/{i}", shell(f"<p>Ada likes rings {i}</p><p>555 123 4567</p>")) for i in range(6)]
    out = jobs.clean_pages(spark.createDataFrame(pages, "college string, name string, url string, html string"))
    assert {r.text for r in out.collect()} == {f"Ada likes rings {i}" for i in range(6)}


def test_resolve_ids_and_verify(spark):
    papers = spark.createDataFrame(
        [("p1", "X", ["Ada Berg"], [("A. Berg", "a1", ["X"])], 1), ("p2", "X", ["Ada Berg"], [("Ada Berg", "a1", ["X"]), ("Al Berg", "zz", ["Y"])], 2), ("p3", "X", ["Ada Berg"], [("Ada Berg", "a2", ["X"])], 3)],
        "paper string, college string, matched array<string>, authors array<struct<name:string,id:string,affiliations:array<string>>>, pos int",
    )
    roster = spark.createDataFrame([("Ada Berg", "X"), ("Eva Haas", "X")], "name string, college string")
    assert {r["name"]: r.id for r in jobs.resolve_ids(papers, roster).collect()} == {"Ada Berg": "a1", "Eva Haas": None}
    people = spark.createDataFrame([("Ada Berg", "North College", "['u1']", 1), ("Eva Haas", "North College", "", 2), ("Bo Ivers", "North College", "u3", 3)], "name string, college string, url string, pos int")
    profiles = spark.createDataFrame([("u1", "Ada M. Berg", "North College, Town")], "url string, profile_name string, affiliation string")
    done = spark.createDataFrame([("Bo Ivers", "North College", "manual_approved"), ("Gone", "North College", "matched")], "name string, college string, status string")
    assert {r["name"]: r.status for r in jobs.verify_profiles(people, profiles, done).collect()} == {"Ada Berg": "matched", "Eva Haas": "no_url", "Bo Ivers": "manual_approved"}


def test_build_offerings_and_directory(spark):
    schema = "college string, academic_year string, term string, course_code string, section string, course_name string, instructor string, time string, url string"
    data = [
        ("X", "2023-24", "F", "CS 10", "", "Rings", "Berg, Ada", "", "u1"),
        ("X", "2024-25", "S", "CS 10", "", "Rings II", "A. Berg; Staff", "", "u2"),
        ("X", "2024-25", "S", "CS 9", "", "Gears", "Nobody Known", "", ""),
        ("X", "2024-25", "S", "CS 99", "", "Senior Thesis", "", "", ""),
        ("X", "2024-25", "S", "MA 1", "", "Sums", "", "", ""),
        ("X", "2024-25", "Su", "CS 8", "", "Summer", "", "", ""),
    ]
    rows = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], schema + ", pos int")
    people = spark.createDataFrame([("ada", "X", "Ada Berg")], "person string, college string, name string")
    out = jobs.build_offerings(rows, people).collect()
    assert [(r.code, r.name) for r in out] == [("CS 9", "Gears"), ("CS 10", "Rings II")]
    assert [(c.on, c.value) for c in out[1].cells] == [(True, "u1"), (True, "u2")] and out[1].instructors == [["ada"], ["ada"]] and out[0].cells[0].on is False
    assert {r.url for r in out} == {None}
    merged = jobs.merge_offerings(rows, rows.where("term = 'F'").withColumn("course_name", F.lit("New")), rows.columns)
    assert merged.count() == 6 and merged.where("course_name = 'New'").count() == 1
    faculty = spark.createDataFrame([("X", 1, "Ada Berg", "Visiting Professor", "matched", 5), ("X", 2, "Eva Haas", "", "no_match", None)], "college string, pos int, name string, title string, status string, citations int")
    pubs = spark.createDataFrame([("X", 1, "Rings", "")], "college string, pos int, title string, venue string")
    d = jobs.build_directory(spark.createDataFrame([("X", "ME")], "college string, state string"), faculty, pubs, spark.createDataFrame([("Y", 1, "n")], "college string, pos int, name string")).collect()
    assert len(d) == 1 and (d[0].members, d[0].trusted, d[0].total) == (2, 1, 5) and d[0].publications[0].venue is None and d[0].courses is None and d[0].faculty[0].category == "visiting"


def test_offerings_axis_links_and_pruning(spark):
    """Expected rows follow the rules: a period of an excluded name alone is no column; a code of two terms of one old year stays; labs go."""
    schema = "college string, academic_year string, term string, course_code string, course_name string, instructor string, url string, pos int"
    data = [
        ("X", "2022-23", "F", " CS 1 ", '"Rings"', "", "a"), ("X", "2022-23", "S", "CS 1", "Rings", "", "a"),  # two periods, long ago
        ("X", "2022-23", "F", "CS 2", "Gears", "", "b"),  # one period, long ago
        ("X", "2026-27", "F", "CS 3", "Wheels", "", "c"), ("X", "2026-27", "F", "CS 3", "Wheels, again", "", ""), ("X", "2026-27", "F", "CS 3L", "Wheels", "", ""),
        ("X", "2026-27", "S", "CS 4", "Senior Thesis", "", ""),  # an excluded name
        ("X", "2026-27", "F", "CS 5", "Gear Lab", "", ""), ("X", "2026-27", "F", "CS 6", "", "", ""),
        ("Y", "2026-27", "F", "CS 1", "Sums", "", "same"), ("Y", "2026-27", "F", "CS 2", "Cubes", "", "same"),
    ]
    rows = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], schema)
    people = spark.createDataFrame([], "person string, college string, name string")
    out = {(r.college, r.code): r for r in jobs.build_offerings(rows, people).collect()}
    assert sorted(out) == [("X", "CS 1"), ("X", "CS 3"), ("X", "CS 6"), ("Y", "CS 1"), ("Y", "CS 2")]
    assert [(p.academic_year, p.term) for p in out["X", "CS 1"].axis] == [("2022-23", "F"), ("2022-23", "S"), ("2026-27", "F")]
    assert [(r.name, r.url) for r in (out["X", "CS 1"], out["X", "CS 3"], out["X", "CS 6"], out["Y", "CS 1"])] == [("Rings", "a"), ("Wheels", "c"), ("", None), ("Sums", None)]
    assert all(c.value is None for r in out.values() for c in r.cells)


def test_sectionise(spark):
    dump = ["x", "COMPUTING", "CS 1 Rings", "Intro MWF 9:00-9:50 am Hall Berg,Ada", "continued", "MATH", "other"]
    lines = spark.createDataFrame([("d", i, x) for i, x in enumerate(dump)], "doc string, pos int, line string")
    out = jobs.sectionise_lines(lines, "^COMPUTING$", "^MATH$", r"^CS \d", r"\d:\d\d").collect()
    assert len(out) == 1 and out[0].heading == "CS 1 Rings" and out[0]["at"].days == "MWF" and out[0]["at"].person == "Berg,Ada" and out[0].line.endswith("continued")


def test_classification(spark):
    df = spark.createDataFrame([(1, '{"field":"computer science","subfields":["theory","Theory","x"]}'), (2, "broken"), (3, '{"field":"Other","subfields":["theory"]}')], "id int, raw string")
    assert [(r.field, r.subfields) for r in classify.parse(df, "raw", ["Theory"]).orderBy("id").collect()] == [("Computer Science", "Theory"), ("", None), ("Other", None)]
    text = spark.createDataFrame([("short",), ("long " * 30,)], "t string").select(classify.prompt(F.col("t"), "Which field?").alias("p")).collect()
    assert text[0].p is None and text[1].p.startswith("Which field?")


def test_ingest_resumes(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    os.makedirs(src)
    write = lambda n, rows: spark.createDataFrame(rows, "k string, v int").coalesce(1).write.mode("append").parquet(src)
    write(1, [("a", 1), ("a", 1), ("b", 2)])
    stream = lambda: spark.readStream.schema("k string, v int").parquet(src)
    for _ in range(2):
        ingest.ingest(stream(), out, cp, ["k"])
    write(2, [("b", 3)])
    ingest.ingest(stream(), out, cp, ["k"])
    # A later file of a key adds to what is there; only whole partitions replace.
    assert sorted((r.k, r.v) for r in spark.read.parquet(out).collect()) == [("a", 1), ("b", 2), ("b", 3)]
    whole, cp2 = str(tmp_path / "whole"), str(tmp_path / "cp2")
    ingest.ingest(stream().where("v < 3"), whole, cp2, ["k"], replace=True)
    write(3, [("b", 4)])
    ingest.ingest(stream().where("v < 3 or v = 4"), whole, cp2, ["k"], replace=True)
    assert sorted((r.k, r.v) for r in spark.read.parquet(whole).collect()) == [("a", 1), ("b", 4)]
    state = spark.createDataFrame([("a", "", 0), ("b", "rescrape", 1), ("c", "manual_approved", 2)], "k string, status string, v int")
    new = spark.createDataFrame([(k, "matched", 9) for k in "abc"], "k string, status string, v int")
    assert sorted(map(tuple, ingest.reprocess(state, new, ["k"], "status", ["v"]).collect())) == [("a", "matched", 9), ("b", "matched", 9), ("c", "manual_approved", 2)]


def test_first_wins(spark, tmp_path):
    src = str(tmp_path / "s")
    spark.createDataFrame([("a",), ("a",), ("b",)], "k string").write.parquet(src)
    seen = []
    ingest.run_available(ingest.first_wins(spark.readStream.schema("k string").parquet(src), ["k"]), lambda df, _: seen.extend(r.k for r in df.collect()), str(tmp_path / "c"))
    assert sorted(seen) == ["a", "b"]
