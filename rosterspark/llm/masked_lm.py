"""Masked pseudo-likelihood: a bidirectional window network scores every token from both of its sides.

Tokens are words. A word's probability is that of its class between its neighbours, times that of the word within its class. Classes:
the corpus' most frequent words are classes of their own, all other words go by a hash of their ending. The network sees the classes of
two words on either side (a table of hidden values for each of the four places, tanh, a softmax over the classes) and predicts the class
between. Within a class, the words of the vocabulary (some thousands) have their share of its tokens; any other word has the share of all
such words times the probability of its spelling, byte after byte. A document's score is the sum of the log-probabilities of all of its
tokens, each masked in turn.

Words are counted over all documents, and every token of every document trains once: each of the `rounds` takes its part of them (`stride` can thin them out). Documents are dealt to shards of about `shard_tokens` tokens by a hash; each shard trains a network of its own in
numpy, from the last round's weights, and Spark averages the networks by their tokens. So what is gathered grows with the corpus, a model depends on
the documents alone and not on Spark's partitions, and network and vocabulary, the only things that are broadcast or reach the driver, have a fixed size.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, texts_in_small_batches

REACH = 2
PLACES = (-2, -1, 1, 2)
#: Class 0 stands before and after a text.
EDGE = 0


class Classes(dict):
    """Word to class, a byte; the cache is emptied when full."""

    def __init__(self, frequent: list[str], buckets: int):
        super().__init__()
        self.frequent, self.buckets = {w: i + 1 for i, w in enumerate(frequent)}, buckets

    def __missing__(self, word: str) -> int:
        c = self.frequent.get(word) or 1 + len(self.frequent) + zlib.crc32(word.rstrip(".,;:!?")[-3:].encode("utf-8", "replace")) % self.buckets
        if len(self) > 300_000:
            self.clear()
        self[word] = c
        return c

    def read(self, text: str | None) -> bytes:
        return bytes(map(self.__getitem__, (text or "").lower().split()))


class Words(list):
    """The frequent words (each a class), and what tells words of a class apart."""

    def __init__(self, frequent: list[str], terms: dict[str, float], other: np.ndarray, spelling: np.ndarray):
        super().__init__(frequent)
        self.terms, self.other, self.spelling = terms, other, spelling

    def __reduce__(self):
        return Words, (list(self), self.terms, self.other, self.spelling)

    def term(self, word: str, c: int) -> float:
        """The log-probability of a word within its class."""
        if c <= len(self):
            return 0.0
        if (found := self.terms.get(word)) is not None:
            return found
        before, after = pairs([word])
        return float(self.other[c] + self.spelling[before, after].sum())

    def each_term(self, words: list[str], classes: list[int], at_once: int = 20_000) -> list[float]:
        """term() of many words (none empty), whose spellings are summed together."""
        out: list[float] = []
        for at in range(0, len(words), at_once):
            part, c = words[at : at + at_once], np.array(classes[at : at + at_once])
            before, after = pairs(part)
            spelt = self.other[c] + np.add.reduceat(self.spelling[before, after], np.flatnonzero(before == 0))
            known = np.array([self.terms.get(w, np.nan) for w in part])
            out += np.where(c <= len(self), 0.0, np.where(np.isnan(known), spelt, known)).tolist()
        return out


def pairs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of the words and the byte after it; byte 0 stands before and after a word."""
    b = np.frombuffer(b"\0" + b"\0".join(w.replace("\0", " ").encode("utf-8", "replace") for w in words) + b"\0", dtype=np.uint8)
    return b[:-1], b[1:]


class Reader(dict):
    """Word to a number of its own, by which `classes` and `terms` hold its class and its term within the class."""

    def __init__(self, words: list[str], buckets: int):
        super().__init__()
        self.words, self.own, self.classes, self.terms, self.new = words, Classes(words, buckets), [], [], []

    def __missing__(self, word: str) -> int:
        self.classes.append(self.own[word])
        self.new.append(word)
        n = self[word] = len(self)
        return n

    def within(self) -> np.ndarray:
        """The terms of all words read so far; those of new words are worked out now."""
        found = self.classes[len(self.terms) :]
        self.terms += self.words.each_term(self.new, found) if isinstance(self.words, Words) else [0.0] * len(found)
        self.new.clear()
        return np.array(self.terms)


class Network:
    def __init__(self, weights: np.ndarray, classes: int, hidden: int):
        cut = np.cumsum([len(PLACES) * classes * hidden, hidden, hidden * classes])
        self.tables, self.bias, self.out, self.prior = (p.reshape(s) for p, s in zip(np.split(weights.astype(np.float32), cut), ((len(PLACES), classes, hidden), (hidden,), (hidden, classes), (classes,)), strict=True))

    @staticmethod
    def start(classes: int, hidden: int, seed: int) -> np.ndarray:
        random = np.random.default_rng(seed)
        return np.concatenate((random.normal(0, 0.3, len(PLACES) * classes * hidden), np.zeros(hidden), random.normal(0, 0.1, hidden * classes), np.zeros(classes))).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in (self.tables, self.bias, self.out, self.prior)])

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """context: a row of classes for each of PLACES."""
        h = np.take(self.tables[0], context[0], axis=0)
        h += self.bias
        for k in range(1, len(PLACES)):
            h += np.take(self.tables[k], context[k], axis=0)
        return np.tanh(h, out=h)

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        scores = self.hidden(context) @ self.out
        scores += self.prior
        # Hidden values lie between -1 and 1, so scores have a bound; only beyond it exp() could overflow.
        top = scores.max(axis=1) if (np.abs(self.out).sum(axis=0) + np.abs(self.prior)).max() > 80 else np.float32(0)
        chosen = np.take_along_axis(scores, target[:, None].astype(np.int64), 1)[:, 0] - top
        if np.ndim(top):
            scores -= top[:, None]
        return (chosen - np.log(np.exp(scores, out=scores) @ np.ones(scores.shape[1], dtype=np.float32))).astype(np.float64)

    def train(self, windows: np.ndarray, rate: float, batch: int, seed: int, past: list[np.ndarray] | None = None) -> list[np.ndarray]:
        """One pass of stochastic gradient steps, scaled by each weight's past gradients, which are returned."""
        past = past or [np.full_like(p, 1e-3) for p in (self.tables, self.bias, self.out, self.prior)]
        order = np.random.default_rng(seed).permutation(len(windows))
        for at in range(0, len(order), batch):
            w = windows[order[at : at + batch]].astype(np.intp)
            context, target = [w[:, k] for k in (0, 1, 3, 4)], w[:, 2]
            h = self.hidden(context)
            p = h @ self.out
            p += self.prior
            # As in log_probabilities(): only beyond this bound exp() could overflow.
            if (np.abs(self.out).sum(axis=0) + np.abs(self.prior)).max() > 80:
                p -= p.max(axis=1, keepdims=True)
            np.exp(p, out=p)
            p *= (1 / (len(target) * (p @ np.ones(p.shape[1], dtype=np.float32))))[:, None]
            p[np.arange(len(target)), target] -= np.float32(1 / len(target))
            back = (p @ self.out.T) * (1 - h * h)
            # The sums by place and class, a hidden value at a time.
            cells = np.concatenate([c + k * len(self.prior) for k, c in enumerate(context)])
            columns = np.tile(back.T.astype(np.float64), (1, len(PLACES)))
            tables = np.stack([np.bincount(cells, column, len(PLACES) * len(self.prior)) for column in columns], axis=1).astype(np.float32).reshape(self.tables.shape)
            for weight, slope, seen in zip((self.tables, self.bias, self.out, self.prior), (tables, back.sum(axis=0), h.T @ p, np.ones(len(p), dtype=np.float32) @ p), past, strict=True):
                seen += slope * slope
                weight -= rate * slope / np.sqrt(seen)
        return past


def word_counts(docs: DataFrame) -> DataFrame:
    """w, n: how often every word stands in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        rows = lambda: pa.RecordBatch.from_arrays([pa.array([w.encode("utf-8", "replace").decode() for w in found], pa.string()), pa.array(list(found.values()), pa.int64())], ["w", "n"])
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update((text or "").lower().split())
                if len(found) > 200_000:
                    yield rows()
                    found.clear()
        yield rows()

    return staged(docs.select("text").mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")), "lm-words")


def vocabulary(docs: DataFrame, frequent: int, buckets: int, size: int) -> tuple[Words, int]:
    """The most frequent words, each of the first a class of its own, and the spelling of all other words; the number of all tokens."""
    counts = word_counts(docs)
    # Through a table: the driver gets `size` rows, not as many of each task.
    known = {r.w: r.n for r in sorted(staged(counts.orderBy(F.desc("n"), "w").limit(size), "lm-known").collect(), key=lambda r: (-r.n, r.w))}
    first, classes = list(known)[:frequent], 1 + frequent + buckets
    sent = docs.sparkSession.sparkContext.broadcast((first, set(known)))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Up to 65,536: pairs of bytes; beyond: tokens of each class."""
        own, known = Classes(sent.value[0], buckets), sent.value[1]
        found = np.zeros((1 << 16) + classes)
        for batch in batches:
            rest = [(w, n) for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if w not in known]
            if rest:
                words, n = [w for w, _ in rest], np.array([n for _, n in rest], dtype=np.float64)
                before, after = pairs(words)
                # The pair that ends in a word's last byte 0 is still its own.
                nth = np.concatenate(([0], np.cumsum(after == 0)[:-1]))
                found[: 1 << 16] += np.bincount(before.astype(np.int64) * 256 + after, weights=n[nth], minlength=1 << 16)
                found[1 << 16 :] += np.bincount([own[w] for w in words], weights=n, minlength=classes)
        k = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype("i4")), pa.array(found[k])], ["k", "x"])

    found = np.zeros((1 << 16) + classes)
    for r in counts.mapInArrow(spell, "k int, x double").groupBy("k").agg(F.sum("x").alias("x")).collect():
        found[r.k] = r.x
    spelling = found[: 1 << 16].reshape(256, 256) + 0.01
    other = found[1 << 16 :] + 1  # no class is without room for a word never seen
    own, whole = Classes(first, buckets), other.copy()
    for w, n in known.items():
        whole[own[w]] += n
    terms = {w: float(np.log(n / whole[own[w]])) for w, n in known.items()}
    made = Words(first, terms, np.log(other / whole), np.log(spelling / spelling.sum(axis=1, keepdims=True)))
    return made, counts.agg(F.sum("n")).first()[0] or 0


def shards(docs: DataFrame, words: list[str], buckets: int, tokens: int, shard_tokens: int) -> DataFrame:
    """classes binary: a row for each shard, its documents' classes in an order that the documents alone decide, EDGE classes between them."""
    spark, given = docs.sparkSession, docs.sparkSession.sparkContext.broadcast(list(words))
    many = max(1, round(tokens / shard_tokens))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Classes(given.value, buckets)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.read(t) for t in batch.column(1).to_pylist()], pa.binary())], ["hash", "classes"])

    def pack(part: pa.Table) -> pa.Table:
        rows = sorted(zip(part.column("hash").to_pylist(), part.column("classes").to_pylist(), strict=True))
        return pa.table({"classes": pa.array([bytes(REACH).join([b"", *(c for _, c in rows if c), b""])], pa.binary())})

    # The id stands in the hash too, so copies of one text spread over the shards.
    place = F.xxhash64("doc_id", "text")
    read_docs = docs.select(place.alias("hash"), "text").mapInArrow(read, "hash long, classes binary")
    packed = read_docs.groupBy(F.pmod(F.col("hash"), F.lit(many)).alias("shard")).applyInArrow(pack, "classes binary")
    return staged(packed.repartition(min(many, 3 * spark.sparkContext.defaultParallelism)), "lm-shards")


def learn(docs: DataFrame, frequent: int = 95, buckets: int = 32, hidden: int = 16, stride: int = 1, rounds: int = 3, rate: float = 0.1, seed: int = 3, size: int = 8192, shard_tokens: int = 1 << 20) -> tuple[list[str], np.ndarray]:
    """Vocabulary and network weights. Null texts teach nothing; repeated rows count as often as they stand there.

    A shard is held by one task: about a byte for each of shard_tokens tokens, whatever the corpus.
    """
    texts_in_small_batches(docs.sparkSession)
    words, tokens = vocabulary(docs, frequent, buckets, size)
    classes = 1 + frequent + buckets
    held = shards(docs, words, buckets, tokens, shard_tokens)
    weights = Network.start(classes, hidden, seed)
    for r in range(rounds):
        sent = docs.sparkSession.sparkContext.broadcast(weights)

        def train(batches: Iterator[pa.RecordBatch], sent=sent, r=r) -> Iterator[pa.RecordBatch]:
            total, tokens = np.zeros(len(sent.value)), 0
            for batch in batches:
                for one in batch.column(0):
                    net, n, past = Network(sent.value.copy(), classes, hidden), 0, None
                    flat = np.frombuffer(one.as_buffer(), dtype=np.uint8)
                    at = np.flatnonzero(flat)[r * stride :: rounds * stride]
                    for part in np.array_split(at, len(at) // (1 << 17) + 1):
                        # Small steps first, then some that cost less a token.
                        past = net.train(flat[part[:, None] + np.arange(-REACH, REACH + 1)], rate, 128 if n < 1 << 15 else 1024, r, past)
                        n += len(part)
                    total += net.flat().astype("f8") * n
                    tokens += n
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype="i4")), pa.array(total), pa.array(np.full(len(total), tokens, dtype="i8"))], ["k", "x", "n"])

        mean = held.mapInArrow(train, "k int, x double, n long").groupBy("k").agg((F.sum("x") / F.sum("n")).alias("x")).toPandas()
        if len(mean):
            weights = mean.sort_values("k").x.to_numpy().astype(np.float32)
    return words, weights


def score(docs: DataFrame, words: list[str], weights: np.ndarray, frequent: int = 95, buckets: int = 32, hidden: int = 16, chunk: int = 1 << 12) -> DataFrame:
    """The masked pseudo-likelihood of every whole text.

    Out: doc_id, n_tokens long, log_prob double (sum over all tokens), per_token double. Texts without words (null, empty, blank) have
    0 tokens, log_prob 0 and per_token null. One row out for each row in, repeated or not; a null id stays null, other columns are left out.
    """
    texts_in_small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((words, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, net = Reader(sent.value[0], buckets), Network(sent.value[1], 1 + frequent + buckets, hidden)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                if len(own) > 300_000:
                    own = Reader(sent.value[0], buckets)
                texts = [(t or "").lower().split() for t in part.column(1).to_pylist()]
                sizes = np.array([len(t) for t in texts])
                read = np.fromiter(map(own.__getitem__, chain.from_iterable(texts)), dtype=np.int64, count=sizes.sum())
                starts = REACH + np.cumsum(sizes + REACH) - sizes - REACH
                held = np.arange(len(read)) + np.repeat(REACH * np.arange(1, len(texts) + 1), sizes)
                flat, each = np.zeros(len(read) + REACH * (len(texts) + 1), dtype=np.uint8), np.zeros(len(read) + REACH * (len(texts) + 1) + 1)
                flat[held] = np.array(own.classes, dtype=np.uint8)[read]
                for a in range(REACH, len(flat) - REACH, chunk):
                    b = min(a + chunk, len(flat) - REACH)
                    each[a + 1 : b + 1] = net.log_probabilities(np.stack([flat[a + p : b + p] for p in PLACES]), flat[a:b])
                each[held + 1] += own.within()[read]
                total = np.cumsum(each)
                sums = total[starts + sizes] - total[starts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes.astype("i8")), pa.array(sums)], ["doc_id", "n_tokens", "log_prob"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, log_prob double")
    return out.withColumn("per_token", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
