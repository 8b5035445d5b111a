"""Quality rules: a logistic regression on hashed word and character n-grams, and plain measures of a text beside it.

A text's features are its character n-grams (3 and 4 code points) and its words and word pairs, hashed into DIMENSIONS places; each of the
two kinds counts as shares of its own number, so that long texts weigh no more than short ones. The model is trained on labelled rows: at most
about `train_docs` of each label, chosen by a hash of the id among rows that aren't held out. Three in four of them are dealt into shards, each trained
in a task of its own, and the shards' weights are averaged; the fourth part calibrates: a line through the margins (Platt's, with his smoothed
targets), in which each label weighs as in the whole table, so that the score is a probability. Whole texts are scored in
Arrow batches, and a text is kept if its probability of being good reaches THRESHOLD and it passes the base rules.

The base rules count words (runs other than the six ASCII white-space characters), symbols, repeated lines and words inside three-word windows
that come again. A text fails with fewer than LEAST_WORDS words or with more than half of them in repeated windows.

Defined results: a null text has no words and fails; an empty one too; ids labelled in both ways, null ids and null labels teach nothing; without
labelled rows of both kinds there is no verdict, and all that passes the base rules is kept; repeated rows are rows of their own; texts
beyond PIECE characters are read in pieces cut at white space, n-grams across a cut aren't features (the base rules read whole texts).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, in_training, released, staged

BITS = 18
DIMENSIONS = 1 << BITS
PIECE = 1 << 20
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, REPEATED_PERCENT = 50, 50
#: A text is kept from this probability of being good on.
THRESHOLD = 0.5
#: Steps, size of a step and pull towards zero in training.
STEPS, RATE, DECAY = 60, 0.3, 1e-4
#: Sampled rows of the rarer label that make a shard worth training on its own.
SHARD_LEAST = 100

# Odd multipliers of the hashes.
_M = np.uint32(0x9E3779B1)
_R = 0x85EBCA6B
_R_INVERSE = pow(_R, -1, 1 << 32)
_SALTS = np.array([0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0xD3A2646D], np.uint32)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint32)
    out[:1] = 1
    return np.multiply.accumulate(out, dtype=np.uint32)


class Hasher:
    """Places of a text's n-grams. Holds tables of powers, so that hashes of words come from one running sum."""

    def __init__(self) -> None:
        self.up, self.down = _powers(_R, 1 << 14), _powers(_R_INVERSE, 1 << 14)

    def _piece(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = lambda h, salt: ((h ^ (h >> np.uint32(15))) * _M ^ _SALTS[salt]) * _M >> np.uint32(32 - BITS)
        three = (c[:-2] * _M + c[1:-1]) * _M + c[2:] if len(c) > 2 else c[:0]
        four = three[:-1] * _M + c[3:] if len(c) > 3 else c[:0]
        chars = np.concatenate([place(three, 0), place(four, 1)])
        if len(c) > len(self.up):
            n = 1 << len(c).bit_length()
            self.up, self.down = _powers(_R, n), _powers(_R_INVERSE, n)
        inside = np.concatenate([[False], ~((c == 32) | (c - np.uint32(9) < 5)), [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.concatenate([np.zeros(1, np.uint32), np.cumsum((c + np.uint32(1)) * self.up[: len(c)], dtype=np.uint32)])
        words = (sums[ends] - sums[starts]) * self.down[starts] if len(starts) else sums[:0]
        pairs = (words[:-1] * _M) ^ words[1:]
        return chars, np.concatenate([place(words, 2), place(pairs, 3)])

    def features(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places of character n-grams, places of words and word pairs) of each piece of the text."""
        at = 0
        while at < len(text):
            end = min(len(text), at + PIECE)
            if end < len(text):
                end = max((text.rfind(s, at + 1, end) for s in SPACES), default=-1)
                end = end if end > at else at + PIECE
            yield self._piece(np.frombuffer(text[at:end].encode("utf-32-le"), np.uint32))
            at = end


def vector(hasher: Hasher, text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of a text: the share of each place among its character n-grams, and among its words and pairs."""
    kinds: list[list[np.ndarray]] = [[], []]
    for found in hasher.features(text or ""):
        for kind, places in enumerate(found):
            kinds[kind].append(places)
    places = np.concatenate([np.zeros(0, np.uint32), *kinds[0], *kinds[1]])
    n = [sum(map(len, found)) for found in kinds]
    shares = np.repeat([1 / max(1, n[0]), 1 / max(1, n[1])], n)
    places, which = np.unique(places, return_inverse=True)
    return places.astype(np.int32), np.bincount(which, weights=shares, minlength=len(places)).astype(np.float32)


def margin(hasher: Hasher, weights: np.ndarray, text: str | None) -> float:
    """The sum of a text's values times their weights, without its constant."""
    sums, n = [0.0, 0.0], [0, 0]
    for found in hasher.features(text or ""):
        for kind, places in enumerate(found):
            sums[kind] += float(weights[places].sum())
            n[kind] += len(places)
    return sums[0] / max(1, n[0]) + sums[1] / max(1, n[1])


def _sample(docs: DataFrame, labels: DataFrame, train_docs: int, shards: int) -> DataFrame:
    """shard (-1: calibration), good, weight (rows of its label that it stands for), places, vals of the sampled rows."""
    once = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("good"), F.max("quality").alias("most")).where("good = most").select("doc_id", "good").where(in_training())
    chosen = bounded_sample(once, "good", train_docs)
    counts = once.groupBy("good").agg(F.count("*").alias("all_rows")).join(chosen.groupBy("good").agg(F.count("*").alias("taken")), "good").collect()  # two rows
    weight = reduce(lambda out, r: F.when(F.col("good") == r.good, r.all_rows / r.taken).otherwise(out), counts, F.lit(1.0))
    shards = max(1, min(shards, min((r.taken for r in counts), default=0) // SHARD_LEAST))
    turn = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(4 * shards))
    shard = F.when(turn % 4 == 0, -1).otherwise(F.floor(turn / 4)).cast("int")
    named = chosen.select("doc_id", "good", weight.alias("weight"))
    # The sample's ids are bounded by train_docs, so they go to the texts; only sampled texts move, one for each id however often it stands there.
    rows = docs.select("doc_id", "text").join(F.broadcast(named), "doc_id").groupBy("doc_id", "good", "weight", shard.alias("shard")).agg(F.max("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1)
                places, vals = vector(hasher, row.column("text")[0].as_py())
                found = [pa.array([places.tobytes()]), pa.array([vals.tobytes()])]
                yield pa.RecordBatch.from_arrays([*(row.column(c) for c in ("doc_id", "good", "weight", "shard")), *found], ["doc_id", "good", "weight", "shard", "places", "vals"])

    return staged(rows.mapInArrow(run, f"doc_id long, good {dict(labels.dtypes)['quality']}, weight double, shard int, places binary, vals binary"), "quality-sample")


def fit(places: list[np.ndarray], vals: list[np.ndarray], good: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Weights of the places, their constant last: steps of equal size along the gradient's sign and spread (Adam) over all rows, both labels weighing the same."""
    rows = np.repeat(np.arange(len(good)), [len(p) for p in places])
    at, x = np.concatenate(places), np.concatenate(vals).astype(np.float64)
    share = np.where(good == 1, 0.5 / max(1, (good == 1).sum()), 0.5 / max(1, (good == 0).sum()))
    w, first, second = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    for step in range(1, steps + 1):
        z = np.bincount(rows, weights=x * w[at], minlength=len(good)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - good) * share
        gradient = np.append(np.bincount(at, weights=x * error[rows], minlength=DIMENSIONS), error.sum()) + DECAY / DIMENSIONS * w
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-7)
    return w


def calibrate(margins: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, constant) of the line through the margins whose logistic curve is a probability; targets are smoothed by one row a label."""
    up, down = weight[good == 1].sum(), weight[good == 0].sum()
    target = np.where(good == 1, (up + 1) / (up + 2), 1 / (down + 2))
    scale = max(float(np.abs(margins).max(initial=0)), 1e-9)
    x = np.stack([margins / scale, np.ones(len(margins))], 1)
    a = np.array([1.0, 0.0])
    loss = lambda a: float((weight * (np.logaddexp(0, x @ a) - target * (x @ a))).sum())
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        gradient = x.T @ (weight * (p - target))
        hessian = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-6 and loss(a - size * step) > loss(a):
            size /= 2
        a = a - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(a[0] / scale), float(a[1])


class Model:
    """Weights of places, and the calibrated line over margins."""

    def __init__(self, weights: np.ndarray, slope: float, constant: float) -> None:
        self.weights, self.slope, self.constant = weights.astype(np.float32), slope, constant

    def probability(self, hasher: Hasher, text: str | None) -> float:
        z = self.slope * margin(hasher, self.weights, text) + self.constant
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def learn(docs: DataFrame, labels: DataFrame, train_docs: int = 2000, shards: int = 8) -> Model | None:
    """A model from docs (doc_id, text) and labels (doc_id, quality 0 or 1); None without rows of both labels."""
    sample = _sample(docs, labels, train_docs, shards)

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id", kind="stable")
        good = rows["good"].to_numpy(np.float64)
        w = fit([np.frombuffer(p, np.int32) for p in rows["places"]], [np.frombuffer(v, np.float32) for v in rows["vals"]], good) if 0 < good.sum() < len(good) else None
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "weights": [None if w is None else w.tobytes()]})

    # A shard is a share of the bounded sample.
    trained = sample.where("shard >= 0").groupBy("shard").applyInPandas(train, "shard int, weights binary").where("weights is not null").orderBy("shard").collect()
    rest = sample.where("shard < 0").select("good", "weight", "doc_id", "places", "vals")
    if not trained:
        return None
    weights = np.mean([np.frombuffer(r.weights) for r in trained], axis=0)

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            yield pd.DataFrame({"doc_id": rows["doc_id"], "good": rows["good"].astype(float), "weight": rows["weight"], "margin": [float((weights[np.frombuffer(p, np.int32)] * np.frombuffer(v, np.float32)).sum()) for p, v in zip(rows["places"], rows["vals"], strict=True)]})

    seen = rest.mapInPandas(measure, "doc_id long, good double, weight double, margin double").toPandas().sort_values(["doc_id", "margin"], kind="stable")
    released(sample)
    good = seen["good"].to_numpy()
    if not 0 < good.sum() < len(good):
        return Model(weights[:-1], 1.0, float(weights[-1]))
    return Model(weights[:-1], *calibrate(seen["margin"].to_numpy(), good, seen["weight"].to_numpy()))


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list) -> int:
    """How many words stand in a window of three that the text holds twice or more."""
    if len(words) < 4:
        return 0
    known: dict = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    pair = ids[:-2] * len(known) + ids[1:-1]
    if len(known) >= 1 << 20:  # three ids no longer fit in a whole number
        pair = np.unique(pair, return_inverse=True)[1]
    _, which, many = np.unique(pair * len(known) + ids[2:], return_inverse=True, return_counts=True)
    again = many[which] > 1
    marked = np.zeros(len(words), bool)
    for k in range(3):
        marked[k : len(words) - 2 + k] |= again
    return int(marked.sum())


def rate(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, the measures, base_failed, kept and probability (null without a model) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, model = Hasher(), shared.value
        for batch in batches:
            found, chance = [], []
            for value in batch.column("text"):  # one text at a time is held as a string
                text = value.as_py()
                found.append(measures(text))
                chance.append(model.probability(hasher, text) if model else None)
            columns = [pa.array([f[n] for f in found], pa.int64()) for n in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array(chance, pa.float64())], ["doc_id", *names, "probability"])

    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {', '.join(f'{n} long' for n in names)}, probability double")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return rows.select("doc_id", *names, failed.alias("base_failed"), (~failed & (F.coalesce("probability", F.lit(1.0)) >= THRESHOLD)).alias("kept"), "probability")
