"""Quality rules: measures against plain counts, features against their definition, and the model's verdicts on held-out rows."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rosterspark.llm import quality as Q

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"
SF = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab #|\n\t\x0b\x1c  é<", max_size=80))
def test_measures(text):
    assert Q.measures(text) == plain(text)


def test_measures_of_many_words():
    words = [str(i) for i in range(1_100_000)] + ["0", "1", "2"] + ["x", "y", "z"] * 2
    assert Q.repeated_words(words) == 12
    assert Q.measures(None) == Q.measures("") == (0, 0, 0, 0, 0)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abcé日", min_size=1, max_size=6), max_size=12))
def test_equal_words_have_equal_places_wherever_they_stand(words):
    _, places = Q.Hasher()._piece(np.frombuffer("  ".join(words).encode("utf-32-le"), np.uint32))
    alone = [int(Q.Hasher()._piece(np.frombuffer(w.encode("utf-32-le"), np.uint32))[1][0]) for w in words]
    assert places[: len(words)].tolist() == alone
    assert len(places) == max(0, 2 * len(words) - 1)


def test_long_texts_are_read_whole(monkeypatch):
    text = " ".join(f"word{i % 700}" for i in range(3000))
    monkeypatch.setattr(Q, "PIECE", 1000)
    pieces = list(Q.Hasher().features(text))
    assert len(pieces) > 10 and sum(len(words) for _, words in pieces) == 2 * 3000 - len(pieces)
    weights = np.random.default_rng(1).normal(size=Q.DIMENSIONS)
    places, vals = Q.vector(Q.Hasher(), text)
    assert Q.margin(Q.Hasher(), weights, text) == pytest.approx(float((weights[places] * vals).sum()), rel=1e-4)


def test_calibration_gives_probabilities():
    rng = np.random.default_rng(5)
    x = rng.normal(size=4000)
    good = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(float)
    a, b = Q.calibrate(x * 10, good, np.ones(4000))
    assert a * 10 == pytest.approx(2, abs=0.2) and b == pytest.approx(-1, abs=0.15)
    # A label sampled at a tenth weighs ten times.
    some = (good == 1) | (np.arange(4000) % 10 == 0)
    a, b = Q.calibrate(x[some] * 10, good[some], np.where(good[some] == 1, 1.0, 10.0))
    assert a * 10 == pytest.approx(2, abs=0.4) and b == pytest.approx(-1, abs=0.4)
    assert all(np.isfinite(Q.calibrate(np.array([5.0, 6, -5]), np.array([1.0, 1, 0]), np.ones(3))))


def test_held_out_rows_of_the_real_table(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rated = {r.doc_id: r for r in Q.rate(docs, Q.learn(docs, labels)).collect()}
    truth = duckdb.sql(f"SELECT doc_id, quality, text FROM '{SF}/documents.parquet' LEFT JOIN '{SF}/labels.parquet' USING (doc_id)").fetchall()
    assert len(rated) == len(truth)
    assert all(tuple(rated[i])[1:6] == plain(text) for i, _, text in truth)
    held = [(rated[i].probability, q) for i, q, _ in truth if q is not None and zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 50
    # Texts that only repeat their words look good to n-grams (measured: 0.957 of 94 rows); the base rules know them.
    assert np.mean([(p >= 0.5) == q for p, q in held]) >= 0.94
    assert all(rated[i].kept == q for i, q, _ in truth if q is not None and zlib.crc32(str(i).encode()) % 4 == 2 and not rated[i].base_failed)
    assert np.mean([(p - q) ** 2 for p, q in held]) <= 0.04
    assert abs(np.mean([p for p, _ in held]) - np.mean([q for _, q in held])) <= 0.05
    assert all(r.kept == (not r.base_failed and r.probability >= 0.5) and r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rated.values())


def rows(n):
    good, bad = "the cat sat on a mat and then it slept for {} hours in the sun by the door", "xx$$$ yy%%% {}&&& zz### qq*** !!"
    return [(i, (good if i % 2 else bad).format(i) + "".join(f" w{i}x{k}" for k in range(50))) for i in range(n)], [(i, i % 2, 0) for i in range(n)]


def test_odd_rows(spark):
    docs, labels = rows(120)
    labels += [(3, 0, 0), (None, 1, 0), (4, None, 0), (7, 1, 0), (9999, 1, 0)]
    docs += [(None, None), (500, ""), (501, "one two three " * 40), (502, None), (503, "big " + " ".join(f"n{i}" for i in range(300_000))), (5, docs[5][1])]
    df = spark.createDataFrame([(*d, 1, "p") for d in docs], DOCS + ", kept int, probability string").repartition(5)
    model = Q.learn(df, spark.createDataFrame(labels, LABELS))
    found = Q.rate(df, model).collect()
    assert len(found) == len(docs)
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[5]) == 2 and by[5][0] == by[5][1]
    assert all(by[i][0].base_failed and not by[i][0].kept for i in (None, 500, 501, 502))
    assert by[503][0].n_words == 300_001
    assert np.mean([by[i][0].kept == bool(i % 2) for i in range(120) if zlib.crc32(str(i).encode()) % 4 == 2]) > 0.9
    again = Q.rate(df, Q.learn(df, spark.createDataFrame(labels, LABELS).repartition(3))).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_without_labels_or_rows(spark):
    docs, _ = rows(4)
    df, none = spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS)
    assert Q.learn(df, none) is None
    assert Q.learn(df, spark.createDataFrame([(1, 1, 0), (3, 1, 0)], LABELS)) is None
    assert all(r.kept and r.probability is None for r in Q.rate(df, None).collect())
    assert Q.rate(spark.createDataFrame([], DOCS), None).collect() == []
