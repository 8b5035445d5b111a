"""The reversed search against a plain loop over all pairs of items and documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rosterspark.llm import reversed_search as R

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans(R.UPPER, R.LOWER)


def by_hand(docs, items, k=10):
    counted = [(i, Counter(TERM.findall(text.translate(LOWER)))) for i, text in docs if text is not None]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted: dict = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(TERM.findall((text or "").translate(LOWER)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, c in counted:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=repr)


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "ÉTÉ", "naïve", "x2", "日本"]
    return [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(n)]


def test_against_all_pairs(spark):
    docs = corpus(300)
    items = [(i, " ".join(random.Random(i).choices([t for _, x in docs[:20] for t in x.split()], k=12))) for i in range(25)]
    assert got(R.search(spark.createDataFrame(docs, DOCS).repartition(6), spark.createDataFrame(items, ITEMS))) == by_hand(docs, items)


def test_blocks_of_items_give_the_same_rows(spark):
    docs, items = corpus(80), [(i, text) for i, text in corpus(12, seed=7)]
    df = spark.createDataFrame(docs, DOCS)
    assert len(R._blocks(R.item_terms(spark.createDataFrame(items, ITEMS)), 40)) > 1
    assert got(R.search(df, spark.createDataFrame(items, ITEMS), postings=40)) == got(R.search(df, spark.createDataFrame(items, ITEMS))) == by_hand(docs, items)


def test_nulls_ties_repeated_rows_long_texts_and_terms(spark):
    docs = [*[(i, "same text here") for i in range(30)], (5, "same text here"), (None, "same text here"), (None, None), (40, None), (41, ""), (42, "... !?"), (43, "SAME_text-HERE\x00same"), (44, "long " * 400_000 + "text"), (45, "ſame ÉTÉ été text here")]
    items = [(1, "Same!"), (2, "text here"), (3, "absent words"), (4, ""), (5, None), (6, "été"), (6, "long"), (None, "TEXT"), (7, "same same same")]
    found = got(R.search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS)))
    assert found == by_hand(docs, items)
    assert {r[0] for r in found} == {1, 2, 6, 7, None}


def test_empty_tables_and_clashing_columns(spark):
    none, one = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b")], ITEMS)
    assert got(R.search(none, one)) == got(R.search(spark.createDataFrame([(1, "a")], DOCS), spark.createDataFrame([], ITEMS))) == []
    extra = spark.createDataFrame([(1, "a b", 9, "x"), (2, "b", 9, "x")], DOCS + ", score int, item_id string")
    assert got(R.search(extra, spark.createDataFrame([(1, "a", "y")], ITEMS + ", doc_id string"))) == by_hand([(1, "a b"), (2, "b")], [(1, "a")])


@pytest.mark.parametrize("k", [1, 3])
def test_heaps_keep_the_best_whatever_the_order(k):
    rng = np.random.default_rng(3)
    scores, docs = rng.integers(0, 6, (200, 4)), rng.permutation(200)
    heaps = R.Heaps(4, k)
    for at in range(0, 200, 17):
        heaps.update(scores[at : at + 17], docs[at : at + 17] % 50 > 0, docs[at : at + 17])
    for item in range(4):
        want = sorted((-s, d % 50 > 0, d) for s, d in zip(scores[:, item], docs, strict=True) if s > 0)[:k]
        mine = heaps.item == item
        assert [(-s, known, d) for s, known, d in zip(heaps.score[mine], heaps.known[mine], heaps.doc[mine], strict=True)] == want
