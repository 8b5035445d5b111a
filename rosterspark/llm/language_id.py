"""Language identification by rank-order profiles.

A profile lists a language's most frequent letter n-grams (1 to 3 letters, runs of other characters read as one gap).
A document gets the language whose profile is nearest by out-of-place distance: the sum, over the document's own most
frequent n-grams, of how far each stands from its place in the profile; an n-gram that the profile lacks counts as the
profile's length. Ties between n-grams go by their code, ties between languages by code point.

Profiles are learnt from about `train_docs` documents of each language (the bound on the sample); whole texts count.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample, in_training, texts_in_small_batches

UNKNOWN = "und"
#: What stands for a run of other characters; no letter has this code.
GAP = 1
#: Letters beyond the first plane of Unicode share the codes from PLANES on, which no other letter has.
PLANES, PLANE_CODES = 0xE000, 0x1900
#: Bits of an n-gram: three letters of 16 bits.
BITS = np.int64(48)
#: Characters held in numpy arrays at a time, and texts (15 bits of a key number them).
CHUNK, TEXTS = 1 << 19, 2048


@lru_cache(maxsize=1)
def codes() -> np.ndarray:
    """The 16-bit code of every lower-cased character: letters have their own, the rest are GAP."""
    out = np.full(0x110000, GAP, dtype=np.uint16)
    letters = np.array([c for c in range(0x110000) if chr(c).isalpha()])
    out[letters] = np.where(letters < 0x10000, letters, PLANES + letters % PLANE_CODES)
    return out


def symbols(text: str) -> np.ndarray:
    found = codes()[np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype="<u4")]
    return found[~((found == GAP) & (np.concatenate(([0], found[:-1])) == GAP))]


def grams(symbols: list[np.ndarray]) -> np.ndarray:
    """The n-grams of each text as sorted keys: the text's number over 48 bits of gram. The lone gap isn't a gram."""
    flat = np.concatenate(symbols).astype(np.int64)
    sizes = np.array([len(s) for s in symbols])
    owner = np.repeat(np.arange(len(symbols), dtype=np.int64), sizes) << BITS
    two = owner[:-1] == owner[1:]
    pair = flat[:-1] << 16 | flat[1:]
    three = two[:-1] & two[1:]
    triple = pair[:-1] << 16 | flat[2:]
    one = flat != GAP
    keys = np.concatenate(((owner | flat)[one], (owner[:-1] | pair)[two], (owner[:-2] | triple)[three & (flat[1:-1] != GAP)]))
    keys.sort()
    return keys


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[at], np.diff(np.append(at, len(keys)))


def ranked(keys: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text its most frequent grams: text number, gram, rank from 0."""
    found, n = counted(keys)
    # Keys come in order of text and gram, so a stable order by text and count leaves ties in order of gram.
    order = found[np.argsort((found >> BITS) << 32 | ((1 << 31) - n), kind="stable")]
    owner = order >> BITS
    rank = np.arange(len(order)) - np.searchsorted(owner, owner)
    keep = rank < top
    return owner[keep], (order & ((1 << BITS) - 1))[keep], rank[keep]


class Profiles:
    """langs in order; grams sorted; places[lang, gram] with `top` for those that a profile lacks, in the last column for all others."""

    def __init__(self, profiles: dict[str, list[int]], top: int):
        self.top, self.langs = top, sorted(profiles)
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), dtype=np.int64)
        self.places = np.full((len(self.langs), len(self.grams) + 1), top, dtype=np.int64)
        for k, lang in enumerate(self.langs):
            self.places[k, np.searchsorted(self.grams, profiles[lang])] = np.arange(len(profiles[lang]))

    def nearest(self, texts: list[str]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        read = [symbols(t) for t in texts]
        some = [i for i, s in enumerate(read) if (s != GAP).any()]
        if not some or not self.langs:
            return langs, scores
        owner, gram, rank = ranked(grams([read[i] for i in some]), self.top)
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        at = np.where(self.grams[at] == gram, at, len(self.grams))
        n = np.bincount(owner, minlength=len(some))
        far = np.stack([np.bincount(owner, np.where(p[at] < self.top, np.abs(p[at] - rank), self.top), minlength=len(some)) for p in self.places])
        best = far.argmin(axis=0)
        for k, i in enumerate(some):
            langs[i], scores[i] = self.langs[best[k]], float(min(1.0, max(0.0, 1 - far[best[k], k] / (self.top * n[k]))))
        return langs, scores


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Slices of at most TEXTS texts and about CHUNK characters; a longer text stands alone."""
    start = held = 0
    for i, t in enumerate(texts):
        if i > start and (held + len(t) > CHUNK or i - start >= TEXTS):
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def learn(docs: DataFrame, top: int = 400, train_docs: int = 1500) -> Profiles:
    """Profiles of every language named in the training rows (see common.in_training). No other column is read.

    Rows without id count as training rows; null texts and languages teach nothing, repeated rows count as often as they stand there. What is
    collected is bounded by `top` grams a language.
    """
    texts_in_small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").where(in_training() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample = bounded_sample(rows, "lang", train_docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                for a, b in _chunks(own):
                    flat = grams([symbols(t) for t in own[a:b]]) & ((1 << BITS) - 1)
                    flat.sort()
                    found, n = counted(flat)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(n.astype("i8"))], ["lang", "gram", "n"])

    totals = sample.select("text", "lang").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = totals.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("place") <= top)
    profiles: dict[str, list[int]] = {}
    for r in sorted(best.collect(), key=lambda r: (r.lang, r.place)):
        profiles.setdefault(r.lang, []).append(r.gram)
    return Profiles(profiles, top)


def identify(docs: DataFrame, profiles: Profiles, keep: bool = False) -> DataFrame:
    """The nearest language of every whole text.

    Out: doc_id, lang_pred string, score double (1 less the distance to the nearest profile over the greatest possible one).
    `und` with score 0 if the text is null or has no letter, or if no language was learnt. One row out for each row in,
    repeated or not; a null id stays null. keep: all columns of docs come along; those that clash with lang_pred and score give way to them.
    """
    texts_in_small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(profiles)

    @F.arrow_udf("lang_pred string, score double")
    def nearest(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            texts, langs, scores = [t or "" for t in part.to_pylist()], [], []
            for a, b in _chunks(texts):
                found = held.value.nearest(texts[a:b])
                langs += found[0]
                scores += found[1]
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    names = [c for c in docs.columns if c not in ("lang_pred", "score")] if keep else ["doc_id"]
    # Only the text goes to Python, once; the other columns stay where they are.
    found = docs.select(*names, nearest.asNondeterministic()("text").alias("nearest"))
    return found.select(*names, "nearest.lang_pred", "nearest.score")
