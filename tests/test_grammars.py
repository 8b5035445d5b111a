"""Codes, terms and days in the spellings of many sources, some dozens for each grammar."""

from pyspark.sql import functions as F

from rosterspark.functions import fields as X
from rosterspark.functions import grammars as G

CODES = [
    ("dashed", "CSC-201-01", "CSC-201", "01"), ("dashed", "CISC-118-1A", "CISC-118", "1A"), ("dashed", "COMP*121-01", "COMP*121", "01"), ("dashed", "CSC54-144-01", "CSC54-144", "01"), ("dashed", "CSC 201", "CSC 201", ""),
    ("starred", "CSI*201*10", "CSI 201", "10"), ("starred", "CSI*201A*W1", "CSI 201A", "W1"), ("named", "COSC-130-A", "COSC 130", "A"), ("named", "COSC-130L-02", "COSC 130L", "02"), ("spaced", "CSCI 1101-A", "CSCI 1101", "A"),
    ("spaced", "CSC 1235 K", "CSC 1235", "K"), ("spaced", "CSC1235L K2", "CSC1235L", "K2"), ("spaced", "CSC 1235", "CSC 1235", ""), ("dotted", "CSCI 201.001", "CSCI 201", "001"), ("dotted", "CSCI 2.01. 3", "CSCI 2.01", "3"),
    ("dotted", "CSCI 201", "CSCI 201", ""), ("joined", "CSC141", "CSC 141", ""), ("joined", "CSC 141 ", "CSC 141", ""), ("joined", "141", "141", ""), ("dated", "CSCI0145A-F25", "CSCI 0145", "A"), ("dated", "CSCI0145-S26", "CSCI 0145", ""),
    ("dated", "CSCI 0145", "CSCI 0145", ""), ("lettered", "CPS121", "CPS 121", ""), ("lettered", "CPS121 L", "CPS 121", "Lab"), ("lettered", "Cps 121l", "Cps 121", "Lab"), ("lettered", "CPS 121B", "CPS 121", "B"), ("registered", "CMSCH105001", "CMSCH105", "001"),
    ("registered", "CMSCB11000A", "CMSCB110", "00A"), ("registered", "CMSC", "CMSC", ""), ("any", "CSC-201-01", "CSC 201", "01"), ("any", "CSC-201-L", "CSC 201", "Lab"), ("any", "COSC120", "COSC 120", ""), ("any", "MATH", "MATH", ""), ("nobody", "CPS121 L", "CPS 121", "Lab"), (None, "", "", ""),
]
TERMS = [
    ("any", "2025-26 Spring Semester", "2025-26", "S"), ("any", "Spring 2026", "2025-26", "S"), ("any", "Fall 2026", "2026-27", "F"), ("any", "Autumn Quarter 2026", "2026-27", "F"), ("any", "Winter 1999-00", "1999-00", "W"), ("any", "1999-2000 Fall", "1999-00", "F"),
    ("any", "January 2026", "2025-26", "W"), ("any", "J-Term 2026", "2025-26", "W"), ("any", "J  Term 2026", "2025-26", "W"), ("any", "2026 Interim", "2025-26", "W"), ("any", "Maymester 2026", "2025-26", "Su"), ("any", "Summer I 2026", "2025-26", "Su"),
    ("any", "Fall Term 2026", "2026-27", "F"), ("any", "2026 - Fall", "2026-27", "F"), ("any", "2027 Winter Term", "2026-27", "W"), ("any", "Spring 2026: COMS BC1016", "2025-26", "S"), ("any", "term term-Fall2025", "2025-26", "F"), ("any", "Fall", None, None),
    ("any", "2026", None, None), ("any", "", None, None), ("any", "Springfield 2026", None, None), ("two terms", "Winter Term 2027", "2026-27", "S"), ("two terms", "Summer 2027", None, None), ("two terms", "Fall 2025-2026", "2025-26", "F"),
    ("church", "Advent 2025", "2025-26", "F"), ("church", "Easter 2026", "2025-26", "S"), ("church", "Fall 2026", None, None), ("short", "SUM2 2026", "2025-26", "Su"), ("short", "FA1 2026", "2026-27", "F"), ("short", "WIN 2026", "2025-26", "W"),
    ("filed", "pdf/sched-f25.pdf", "2025-26", "F"), ("filed", "sched-s26.pdf", "2025-26", "S"), ("filed", "sched-x26.pdf", None, None),
]
DAYS = [
    ("any", "MWF", "MWF"), ("any", "T, Th", "TR"), ("any", "TTh", "TR"), ("any", "MoWeFr", "MWF"), ("any", "TuTh", "TR"), ("any", "Mo", "M"), ("any", "Sa", "S"), ("any", "SaSu", "SU"), ("any", "Tuesday/Thursday", "TR"), ("any", "Monday, Wednesday", "MW"),
    ("any", "M W F", "MWF"), ("any", "m/w/f", "MWF"), ("any", "TR", "TR"), ("any", "MTWRF", "MTWRF"), ("any", "MTWThF", "MTWRF"), ("any", "Mon and Wed", "MW"), ("any", "Thurs.", "R"), ("any", "Tues & Thur", "TR"), ("any", "Fridays", "F"), ("any", "R", "R"), ("any", "U", "U"),
    ("any", "Meets Mondays at noon", "M"), ("any", "TBA", ""), ("any", "arranged", ""), ("any", "", ""), ("any", " - ", ""), ("any", None, None), ("any", "Sunday-Saturday", "US"), ("mask", ".M.W.F.", "MWF"), ("mask", "..T.R..", "TR"), ("mask", ".......", ""),
]
CLOCKS = [
    ("12:40 PM", "12:40"), ("11:00 AM", "11:00"), ("12:05 am", "00:05"), ("1 pm", "13:00"), ("1:30p.m.", "13:30"), ("9", "09:00"), ("23:59", "23:59"), ("0:00", "00:00"), ("1300", "13:00"), ("25:00", None), ("24:00", None), ("9:75 am", None), ("13:00 pm", None), ("0:30 am", None), ("noon", None), ("", None), (None, None),
]


def test_codes(spark):
    df = spark.createDataFrame([(n, s, c) for n, (s, c, _, _) in enumerate(CODES)], "n int, style string, c string")
    split = G.by_style(F.col("style"), sorted({s for s, *_ in G.CODES}), lambda s: G.split_code(F.col("c"), s))
    got = [(r.s.code, r.s.section) for r in df.select("n", split.alias("s")).orderBy("n").collect()]
    assert got == [(code, section) for _, _, code, section in CODES]


def test_terms(spark):
    df = spark.createDataFrame([(n, s, c) for n, (s, c, _, _) in enumerate(TERMS)], "n int, style string, c string")
    read = G.by_style(F.col("style"), ["any", "two terms", "church", "short", "filed"], lambda s: G.parse_term(F.col("c"), s))
    got = [(r.t.year, r.t.term) if r.t else (None, None) for r in df.select("n", read.alias("t")).orderBy("n").collect()]
    assert got == [(year, term) for _, _, year, term in TERMS]


def test_days_and_clocks(spark):
    df = spark.createDataFrame([(n, s, c) for n, (s, c, _) in enumerate(DAYS)], "n int, style string, c string")
    got = [r.d for r in df.select("n", G.by_style(F.col("style"), ["mask"], lambda s: G.days(F.col("c"), s)).alias("d")).orderBy("n").collect()]
    assert got == [want for *_, want in DAYS]
    clocks = spark.createDataFrame([(n, c) for n, (c, _) in enumerate(CLOCKS)], "n int, c string")
    assert [r.t for r in clocks.select("n", X.to_24h(F.col("c")).alias("t")).orderBy("n").collect()] == [want for _, want in CLOCKS]


def test_term_codes_and_back(spark):
    df = spark.createDataFrame([(y, t) for y in ("2025-26", "1999-00") for t in ("F", "W", "S", "Su")], "y string, t string")
    want = {"start": ("202501", None, "202502", None), "end": ("202601", "202602", "202603", "202604"), "tens": ("202590", "202610", "202620", "202665"), "months": ("202601", None, "202605", "202609"), "letters": ("2526F", "2526W", "2526S", "2526Su")}
    for style, codes in want.items():
        code = G.term_code(F.col("y"), F.col("t"), style)
        rows = df.select("y", "t", code.alias("c"), G.parse_term_code(code, style).alias("back")).collect()
        assert tuple(r.c for r in rows[:4]) == codes
        assert all(r.back == (None if r.c is None else (r.y, r.t)) for r in rows if style != "letters" or r.y == "2025-26")
    assert spark.range(1).select(G.parse_term_code(F.lit("2026x1"), "end").alias("t")).first().t is None
