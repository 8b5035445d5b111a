"""Ranked lexical search turned round: the items' inverted index goes to the documents.

Items are few and documents many, so it is the items whose terms are indexed (term -> items) and broadcast. One pass over the documents counts
what the weights need: documents, terms, and the documents that hold each indexed term. A second pass streams each document's term counts
through the index; every task keeps the best K documents of each item in bounded heaps (arrays that each block of documents
updates together) and gives them out at its end. Heaps merge in two steps, by (item, salt) and then by item, so that no merge grows with the number
of tasks. No document's text is shuffled.

An index that is broadcast holds at most `postings` pairs of an item and a term (or one item's, if that alone has more): with more,
items are dealt into blocks, a pass over the documents each.

Defined results: a null text or one without terms is no document (N doesn't count it) and is never found; a null id comes before all
others among equal scores; repeated rows are documents of their own; rows of one item id are one item with all their terms; an item
without terms, or whose terms no document holds, gives no rows; empty tables give none. Other columns play no part.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: A term is a run of ASCII letters and digits and of all that isn't ASCII; only A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The same by bytes: other ASCII characters become spaces, bytes of longer characters stay.
TO_TERMS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))
#: Documents and bytes of text that are scored together, and cells of their score table.
BLOCK_ROWS, BLOCK_BYTES, BLOCK_CELLS = 512, 4 << 20, 2 << 20
#: Pairs of an item and a term in one broadcast index.
POSTINGS = 1_000_000
#: Heaps of so many groups of tasks merge first.
SALTS = 64


class Index:
    """term -> slot; a slot's items are items[starts[slot]:starts[slot + 1]]. ids: the items' ids."""

    def __init__(self, pairs: list[tuple[int | None, str]]) -> None:
        places = {i: n for n, i in enumerate(dict.fromkeys(i for i, _ in pairs))}
        self.ids = list(places)
        by_term: dict[bytes, list[int]] = {}
        for i, term in pairs:
            by_term.setdefault(term.encode(), []).append(places[i])
        self.slots = {t: n for n, t in enumerate(by_term)}
        self.items = np.array([i for found in by_term.values() for i in found], np.int64)
        self.starts = np.concatenate([[0], np.cumsum([len(found) for found in by_term.values()])]).astype(np.int64)
        self.weights = np.zeros(len(self.slots), np.int64)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """(ids, texts as bytes) of blocks of documents with a text; a long text is a block of its own."""
    for batch in batches:
        ids, texts, held = [], [], 0
        for i, text in zip(batch.column("doc_id"), batch.column("text").cast(pa.binary()), strict=True):
            if text.is_valid:
                data = text.as_buffer().to_pybytes()
                if texts and (len(texts) >= BLOCK_ROWS or held + len(data) > BLOCK_BYTES):
                    yield ids, texts
                    ids, texts, held = [], [], 0
                ids.append(i.as_py())
                texts.append(data)
                held += len(data)
        if texts:
            yield ids, texts


def _statistics(index: Index):
    """Rows (slot, n): the documents that hold a slot's term, all documents with terms (slot -1) and all terms (slot -2), of one task each."""
    slots = index.slots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, n_terms = np.zeros(len(slots), np.int64), 0, 0
        for _, texts in _texts(batches):
            hits: list[int] = []
            for data in texts:
                terms = data.translate(TO_TERMS).split()
                n_terms += len(terms)
                n_docs += bool(terms)
                hits.extend(map(slots.__getitem__, slots.keys() & set(terms)))
            df += np.bincount(np.array(hits, np.int64), minlength=len(df))
        held = np.nonzero(df)[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], held]), pa.int64()), pa.array(np.concatenate([[n_docs, n_terms], df[held]]), pa.int64())], ["slot", "n"])

    return run


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Heaps:
    """The best `k` (score, document) of each of n items so far; equal scores by ascending document, null first."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.floor = k, np.ones(n, np.int64)
        self.item, self.score, self.known, self.doc = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def update(self, scores: np.ndarray, known: np.ndarray, doc: np.ndarray) -> None:
        """scores: a row for each document, a column for each item."""
        row, item = np.nonzero(scores >= self.floor)
        if not len(row):
            return
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[row, item]])
        known, doc = np.concatenate([self.known, known[row]]), np.concatenate([self.doc, doc[row]])
        order = np.lexsort((doc, known, -score, item))
        item, score, known, doc = item[order], score[order], known[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = place < self.k
        self.item, self.score, self.known, self.doc = item[kept], score[kept], known[kept], doc[kept]
        full = place == self.k - 1
        self.floor[item[full]] = score[full]


def _scan(index: Index, n_docs: int, n_terms: int, k: int):
    """Rows (item_id, doc_id, score): a task's heaps."""
    slots, items, starts, weights = index.slots, index.items, index.starts, index.weights
    n_items = len(index.ids)
    rows_at_once = max(1, BLOCK_CELLS // max(1, n_items))

    def scored(ids: list[int | None], texts: list[bytes], heaps: Heaps) -> None:
        lengths, hit_row, hit_slot, hit_tf = [], [], [], []
        for row, data in enumerate(texts):
            terms = data.translate(TO_TERMS).split()
            lengths.append(len(terms))
            counts = Counter(terms)
            held = slots.keys() & counts.keys()
            hit_row += [row] * len(held)
            hit_slot += map(slots.__getitem__, held)
            hit_tf += map(counts.__getitem__, held)
        row, slot, tf = np.array(hit_row, np.int64), np.array(hit_slot, np.int64), np.array(hit_tf, np.int64)
        m = 100 - 90 + (90 * np.array(lengths, np.int64) * n_docs) // max(1, n_terms)
        part = weights[slot] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        many = starts[slot + 1] - starts[slot]
        ends = np.cumsum(many)
        item = items[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many - starts[slot], many)]
        table = np.zeros((len(texts), n_items), np.int64)
        np.add.at(table.reshape(-1), np.repeat(row, many) * n_items + item, np.repeat(part, many))
        known = np.array([i is not None for i in ids])
        heaps.update(table, known, np.array([i or 0 for i in ids], np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(n_items, k)
        for ids, texts in _texts(batches):
            for at in range(0, len(texts), rows_at_once):
                scored(ids[at : at + rows_at_once], texts[at : at + rows_at_once], heaps)
        names = pa.array(index.ids, pa.int64()).take(pa.array(heaps.item))
        for at in range(0, len(heaps.item), 10_000):
            some = slice(at, at + 10_000)
            yield pa.RecordBatch.from_arrays([names[some], pa.array(heaps.doc[some], mask=~heaps.known[some]), pa.array(heaps.score[some])], ["item_id", "doc_id", "score"])

    return run


def _best(df: DataFrame, by: list, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and each of its terms once."""
    terms = F.array_distinct(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0)))
    return items.select("item_id", F.explode(terms).alias("term")).distinct()


def _blocks(pairs: DataFrame, postings: int) -> list[DataFrame]:
    """The pairs in parts of at most `postings`, an item whole in one of them."""
    largest, total = (int(x or 0) for x in pairs.groupBy("item_id").count().agg(F.max("count"), F.sum("count")).first())
    n = max(1, math.ceil(total / postings))
    block = lambda: F.pmod(F.xxhash64("item_id"), F.lit(n))
    while n > 1 and pairs.groupBy(block()).count().agg(F.max("count")).first()[0] > max(postings, largest):
        n *= 2
    return [pairs.where(block() == b) for b in range(n)] if total else []


def search(docs: DataFrame, items: DataFrame, k: int = 10, postings: int = POSTINGS) -> DataFrame:
    """The k best documents (doc_id, text) of each item (item_id, text): item_id, rank from 1, doc_id, score above 0."""
    sc = docs.sparkSession.sparkContext
    texts = docs.select("doc_id", "text")
    pairs = staged(item_terms(items), "item-terms")
    heaps = []
    for block in _blocks(pairs, postings):
        # A block fits in memory by its count; sorted, so that reruns agree.
        index = Index([tuple(r) for r in block.orderBy("item_id", "term").collect()])
        if not index.ids:
            continue
        counts = dict(tuple(r) for r in texts.mapInArrow(_statistics(index), "slot long, n long").groupBy("slot").agg(F.sum("n")).collect())
        n_docs, n_terms = counts.pop(-1, 0), counts.pop(-2, 0)
        for slot, df in counts.items():
            index.weights[slot] = term_weight(n_docs, df)
        shared = sc.broadcast((index, n_docs, n_terms))
        heaps.append(texts.mapInArrow(lambda batches, shared=shared: _scan(*shared.value, k)(batches), "item_id long, doc_id long, score long"))
    if not heaps:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = reduce(DataFrame.unionByName, heaps).withColumn("salt", F.spark_partition_id() % SALTS)
    return _best(_best(found, ["item_id", "salt"], k), ["item_id"], k).select("item_id", "rank", "doc_id", "score")


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') AS terms FROM documents WHERE text IS NOT NULL),
g AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM d) GROUP BY 1, 2),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM i) GROUP BY 1),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM df, g),
s AS (SELECT item_id, rid, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(terms) * n_docs) // n_terms))))::BIGINT AS score
      FROM i JOIN w USING (term) JOIN tf USING (term) JOIN d USING (rid), g GROUP BY 1, 2),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s JOIN d USING (rid) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 10
"""
