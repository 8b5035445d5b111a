"""Toxicity by a weighted grammar of finite-state patterns over clauses.

A text is cut into clauses (at the ends of sentences and lines), its words become symbols: insult, threat, target, negation, report
(someone else's speech) or other. Small weighted transducers rewrite the insults and threats of a clause: the first those that a
negation precedes, the second those in reported speech, the third those aimed at a target. They are composed into one transducer, which reads
each clause forwards; the third one also reads it backwards, as targets may follow ("idiot, you"). What it writes are matched clauses: denied,
reported, aimed, or plain (an insult in a clause with other words). A threat matches only with a target, and a word that is the whole
clause matches nothing. The matches' weights are summed by kind over the whole text, and a logistic model turns the sums into a score.

Insults are a seed list and word beginnings learnt from labelled rows: those far likelier in toxic documents than chance
allows (Chernoff's bound), counted over the different words that they follow, as copies repeat theirs. Both the beginnings and the logistic model are
fitted on a sample of at most about `train_docs` documents of each label; what is broadcast is that lexicon.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, in_training, staged, texts_in_small_batches

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, DENIED, REPORTED, AIMED, AIMED_THREAT = SYMBOLS = range(10)

# Seed words of the grammar.
SEEDS = {
    INSULT: "idiot idiots moron morons loser losers clown clowns scum trash stupid pathetic worthless disgusting imbecile dumb idiota imbécil estúpido estúpida idiote crétin abruti dummkopf trottel abschaum",
    THREAT: "kill hurt destroy murder töten umbringen matar tuer",
    TARGET: "you your youre he she they them du dich ihr euch sie tú te usted ustedes tu toi vous",
    NEGATION: "not never no nicht kein keine nunca jamás ne jamais pas",
    REPORT: "said says told called claimed wrote quote sagte schrieb dijo dice escribió dit disait écrit",
}
KINDS = ("plain", "aimed", "denied", "reported", "aimed threat")
#: The kind of each symbol that a match can end as.
KIND_OF = {INSULT: 0, AIMED: 1, DENIED: 2, REPORTED: 3, AIMED_THREAT: 4}
#: A negation or report holds for so many words, a target for so many before or after a match.
REACH = 4
BEGINNINGS = range(3, 9)
CLAUSE_END = re.compile(r"[.!?;:]$")
EDGES = re.compile(r"^\W+|\W+$")


class Transducer:
    """arcs: (state, symbol) -> (next state, symbol written, weight). State 0 is the first."""

    def __init__(self, arcs: dict[tuple[int, int], tuple[int, int, float]]):
        self.arcs = arcs

    def read(self, symbols: list[int]) -> list[tuple[int, float]]:
        state, out = 0, []
        for s in symbols:
            state, written, weight = self.arcs[state, s]
            out.append((written, weight))
        return out


def after(trigger: int, rewritten: dict[int, tuple[int, float]]) -> Transducer:
    """Rewrites symbols that stand within REACH places after a trigger, with weights; the state is how far the trigger still reaches."""
    arcs = {}
    for state in range(REACH + 1):
        for s in SYMBOLS:
            written, weight = rewritten.get(s, (s, 1.0)) if state else (s, 1.0)
            arcs[state, s] = (REACH if s == trigger else max(0, state - 1), written, weight)
    return Transducer(arcs)


def compose(a: Transducer, b: Transducer) -> Transducer:
    """b reads what a writes; weights multiply. Only states that can be reached are kept."""
    numbers, arcs, rest = {(0, 0): 0}, {}, [(0, 0)]
    while rest:
        pair = rest.pop()
        for s in SYMBOLS:
            to_a, middle, w_a = a.arcs[pair[0], s]
            to_b, written, w_b = b.arcs[pair[1], middle]
            if (to_a, to_b) not in numbers:
                numbers[to_a, to_b] = len(numbers)
                rest.append((to_a, to_b))
            arcs[numbers[pair], s] = (numbers[to_a, to_b], written, w_a * w_b)
    return Transducer(arcs)


DENIALS = after(NEGATION, {INSULT: (DENIED, 1.0), THREAT: (DENIED, 1.0)})
QUOTES = after(REPORT, {INSULT: (REPORTED, 1.0), THREAT: (REPORTED, 1.0)})
TARGETS = after(TARGET, {INSULT: (AIMED, 1.0), THREAT: (AIMED_THREAT, 1.0)})
CLAUSES = compose(compose(DENIALS, QUOTES), TARGETS)


class Grammar:
    """insults: word beginnings (whole words end in a space) with their weights."""

    def __init__(self, insults: dict[str, float]):
        self.insults = {f"{w} ": 3.0 for w in SEEDS[INSULT].split()} | insults
        self.words = {w: s for s in (THREAT, TARGET, NEGATION, REPORT) for w in SEEDS[s].split()}
        self.seen: dict[str, tuple[int, float, bool]] = {}

    def read(self, word: str) -> tuple[int, float, bool]:
        """Symbol, weight and whether the clause ends after it."""
        bare = EDGES.sub("", word)
        spelt = f"{bare} "
        weight = max((self.insults[spelt[:k]] for k in (*BEGINNINGS, len(spelt)) if spelt[:k] in self.insults), default=0.0)
        symbol = INSULT if weight else self.words.get(bare, OTHER)
        found = (symbol, weight or 1.0, bool(CLAUSE_END.search(word)))
        if len(word) <= 40:
            if len(self.seen) > 40_000:
                self.seen.clear()
            self.seen[word] = found
        return found

    def sums(self, text: str) -> np.ndarray:
        """Weights of the matched clauses by kind."""
        out = np.zeros(len(KINDS))
        seen, read = self.seen, self.read
        for line in text.lower().split("\n"):
            found = [seen.get(w) or read(w) for w in line.split()]
            for i, (symbol, weight, _) in enumerate(found):
                if symbol != INSULT and symbol != THREAT:
                    continue
                # A transducer's state holds the last REACH symbols at most, so it reads the clause from there.
                start = i
                while start and i - start < REACH and not found[start - 1][2]:
                    start -= 1
                end = i + 1
                while end < len(found) and end - i <= REACH and not found[end - 1][2]:
                    end += 1
                if end - start == 1:
                    continue
                written, factor = CLAUSES.read([f[0] for f in found[start : i + 1]])[-1]
                if written in (INSULT, THREAT):
                    written, factor = TARGETS.read([f[0] for f in reversed(found[i:end])])[-1]
                if written in KIND_OF:
                    out[KIND_OF[written]] += weight * factor
        return out


def features(sums: np.ndarray) -> np.ndarray:
    return np.concatenate((np.ones(sums.shape[:-1] + (1,)), np.minimum(sums, 3.0), np.log1p(sums)), axis=-1)


#: Weights that may be negative: the intercept's and those of denied and reported matches.
FREE = [0, *(1 + k + len(KINDS) * half for half in (0, 1) for k in (KIND_OF[DENIED], KIND_OF[REPORTED]))]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.05, steps: int = 60) -> np.ndarray:
    """Ridge logistic regression by Newton steps; weights of matches never fall below 0 but for denied and reported ones.

    Without both labels: matches count alike, denied and reported ones against it."""
    w, bound = np.zeros(x.shape[1]), np.setdiff1d(np.arange(x.shape[1]), FREE)
    if not len(y) or y.min() == y.max():
        w[bound], w[FREE] = 1.0, -1.0
        w[0] = -3.0
        return w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.full(len(w), penalty)
        ridge[0] = 1e-6
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -2, 2)
        w[bound] = np.maximum(w[bound], 0.0)
        if np.abs(step).max() < 1e-7:
            break
    return w


def beginnings(text: str) -> set[str]:
    words = {EDGES.sub("", w) for w in set(text.lower().split())}
    return {w[:k] for w in words for k in BEGINNINGS if k <= len(w)} | {f"{w} " for w in words if 3 <= len(w) <= 40}


def learn(docs: DataFrame, labels: DataFrame, train_docs: int = 4000, alpha: float = 1e-5, purity: float = 4.0) -> tuple[Grammar, np.ndarray]:
    """The lexicon and the logistic weights, from labelled training rows only (common.in_training); id, source and lang are not read as inputs.

    purity: the least log odds (toxic against other documents) of a learnt beginning. Rows with null ids, labels or texts teach nothing;
    of repeated labels the highest counts; repeated documents count as often as they stand there."""
    texts_in_small_batches(docs.sparkSession)
    known = labels.select("doc_id", "toxic").where(in_training() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = bounded_sample(known, "toxic", train_docs)
    sample = staged(docs.select("doc_id", "text").where(in_training() & F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"), "toxic-sample")  # the sample's ids: bounded by train_docs a label
    counts = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = counts.get(1, 0), sum(n for k, n in counts.items() if k != 1)
    insults: dict[str, float] = {}
    if n1 and n0:

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hits: dict[int, Counter[str]] = {0: Counter(), 1: Counter()}
            for batch in batches:
                for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    hits[int(toxic == 1)].update(beginnings(text))
            every = list(hits[1] | hits[0])
            yield pa.RecordBatch.from_arrays([pa.array(every, pa.string()), pa.array([hits[1][b] for b in every], pa.int64()), pa.array([hits[0][b] for b in every], pa.int64())], ["b", "p", "n"])

        rate = n1 / (n1 + n0)
        tried = sample.select("text", "toxic").mapInArrow(count, "b string, p long, n long").groupBy("b").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
        share = F.col("p") / (F.col("p") + F.col("n"))
        # Chernoff: the chance of such a share is at most exp(-documents * divergence), whatever the beginning.
        divergence = share * F.log(share / rate) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
        odds = F.log((F.col("p") + 0.5) / (n1 + 1)) - F.log((F.col("n") + 0.5) / (n0 + 1))
        unlikely = lambda docs: (docs > 0) & (share > rate) & ((docs + F.col("n")) * divergence > math.log(1 / alpha))
        candidates = staged(tried.where(unlikely(F.col("p")) & (odds > purity)).withColumn("odds", odds), "toxic-beginnings")
        likely = {r.b: min(6.0, r.odds) for r in candidates.select("b", "odds").collect()}

        def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: set[tuple[str, str]] = set()
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    words = text.lower().split()
                    for before, word in zip(["", *words], words, strict=False):
                        spelt = EDGES.sub("", word) + " "
                        found.update((spelt[:k], before) for k in {*BEGINNINGS, len(spelt)} if spelt[:k] in likely)
            pairs = sorted(found)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], ["b", "before"])

        # Copies repeat their words: a beginning counts as often as it follows different words.
        apart = sample.where("toxic = 1").select("text").mapInArrow(contexts, "b string, before string").groupBy("b").agg(F.countDistinct("before").alias("apart"))
        kept = candidates.join(apart, "b").where(unlikely(F.least("p", "apart")))
        insults = {r.b: likely[r.b] for r in kept.select("b").collect()}
    grammar = Grammar(insults)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grammar(insults)
        for batch in batches:
            sums = [own.sums(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.list_(pa.float64())), batch.column(1)], ["sums", "toxic"])

    rows = sample.select("text", F.col("toxic").cast("int")).mapInArrow(measure, "sums array<double>, toxic int").groupBy("sums", "toxic").count().collect()
    x = np.repeat(features(np.array([r.sums for r in rows], dtype=float).reshape(-1, len(KINDS))), [r["count"] for r in rows], axis=0)
    y = np.repeat(np.array([float(r.toxic == 1) for r in rows]), [r["count"] for r in rows])
    return grammar, fit(x, y)


def score(docs: DataFrame, grammar: Grammar, weights: np.ndarray, threshold: float = 0.3, keep: bool = False) -> DataFrame:
    """The toxicity of every whole text.

    Out: doc_id, score double, predicted int (1 from the threshold on). A null or empty text has the score of a text without
    matches. One row out for each row in, repeated or not; a null id stays null. keep: all columns of docs come along; those that clash with score and
    predicted give way to them.
    """
    texts_in_small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast((grammar.insults, weights))

    @F.arrow_udf("score double, predicted int")
    def scored(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        insults, w = held.value
        own = Grammar(insults)
        for part in parts:
            sums = np.array([own.sums(t or "") for t in part.to_pylist()]).reshape(-1, len(KINDS))
            p = 1 / (1 + np.exp(-np.clip(features(sums) @ w, -30, 30)))
            yield pa.StructArray.from_arrays([pa.array(p), pa.array((p >= threshold).astype("i4"))], ["score", "predicted"])

    names = [c for c in docs.columns if c not in ("score", "predicted")] if keep else ["doc_id"]
    # Only the text goes to Python, once; the other columns stay where they are.
    return docs.select(*names, scored.asNondeterministic()("text").alias("scored")).select(*names, "scored.score", "scored.predicted")
