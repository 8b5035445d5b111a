"""N-gram Jaccard join on parity sketches, and the groups that its links form.

A document is the set of its distinct word shingles. Two sets of a and b shingles whose Jaccard similarity reaches t differ in at most
(1 - t) / (1 + t) * (a + b) shingles. A parity sketch flips one bit for each shingle, so two sketches differ in at most as many
bits as the sets differ in shingles. Sketches are cut into parts, one more than that bound and some to spare: shingles choose a
part and a bit by their hash, and of two linked documents at least 1 + spare parts are equal (pigeonhole). Parts are so wide (2**64 bits,
of which only the XOR of the set bits' numbers is kept) that parts of different shingles are hardly ever equal, however many documents there are. Parts
of few shingles say little, so a document leaves out as many parts as there are to spare, the last in an order by shingles and sketch; what either of
two documents leaves out of their equal parts, the one that leaves out the higher ones leaves out too, so one
equal part always remains. The bound depends on the size, so documents are joined per size band; a document near the upper end
of its band also enters the next one, where its larger partners are.

Parts that several documents share (a bucket) give candidates. They are verified exactly: by the sizes, by a folded sketch whose
distance can't exceed the bound, and by the shingle sets.

Groups need no list of all pairs. First each document is compared with two documents that stand first or last in most of its buckets;
verified links merge documents into components, and that is repeated with the buckets that still hold several. What is left of those
is compared in full inside the tasks, members of different components with each other, and only pairs that the sketches allow leave a
task. So a group of thousands of copies costs a few links a document, and no link between different components is missed.

Equal sets are one document (the smallest id stands for them). Words are runs of characters other than ASCII white space, after
A-Z are lower-cased. Texts with fewer words than a shingle are one shingle, the whole sequence. Null, empty and blank texts have no
shingles and are linked with nothing. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import released, staged, texts_in_small_batches

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Growth of size bands, and spare parts as a share of the bound.
BAND, SPARE = 1.6, 0.15
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingle hashes of a text. Word hashes come from a cache that is emptied when full."""

    def __init__(self, words: int, cache_size: int = 100_000):
        self.words, self.cache_size, self.cache = words, cache_size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = (text or "").encode("utf-8", "replace").translate(LOWER).split()  # bytes split at the six ASCII white-space characters
        if not tokens:
            return np.zeros(0, dtype=np.uint64)
        cache = self.cache
        try:
            hashes = [cache[t] for t in tokens]
        except KeyError:
            if len(cache) > self.cache_size:
                cache.clear()
            cache.update((t, xxhash.xxh3_64_intdigest(t)) for t in set(tokens) if t not in cache)
            hashes = [cache[t] for t in tokens]
        h = np.array(hashes, dtype=np.uint64)
        n = min(self.words, len(h))
        out = np.full(len(h) - n + 1, np.uint64(n))
        for k in range(n):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k])
        return np.unique(out)


def differing(t: float, total: int) -> int:
    """The most shingles in which two linked sets of so many shingles together can differ."""
    return math.floor((1 - t) / (1 + t) * total + 1e-9)


def band_of(n: int) -> int:
    return math.floor(math.log(n) / math.log(BAND) + 1e-9)


def band_end(band: int) -> int:
    """The largest size in a band."""
    end = math.ceil(BAND ** (band + 1)) + 1
    while band_of(end) > band:
        end -= 1
    return end


def part_keys(shingles: np.ndarray, t: float) -> np.ndarray:
    """Keys (band, part, sketch of the part) of a set, for its own band and, if partners may be there, the next."""
    n = len(shingles)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    own = band_of(n)
    bands = [own, own + 1] if band_end(own) + 1 <= n / t + 1e-9 else [own]
    spread, bits = mixed(shingles), mixed(shingles ^ np.uint64(0xD6E8FEB86659FD93))
    out = []
    for band in bands:
        bound = differing(t, 2 * band_end(band))
        spare = math.ceil(SPARE * bound)
        parts = bound + 1 + spare
        at = (((spread >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        sketch = np.zeros(parts, dtype=np.uint64)
        np.bitwise_xor.at(sketch, at, bits)
        names = mixed(sketch + mixed(np.arange(parts, dtype=np.uint64) + np.uint64(band << 40)))
        out.append(names[np.lexsort((names, np.bincount(at, minlength=parts)))[spare:]])
    return np.concatenate(out)


def folded(shingles: np.ndarray) -> bytes:
    """One parity sketch, of two to four bits a shingle (a power of two, 256 at least)."""
    bits = 1 << max(8, (2 * len(shingles) - 1).bit_length())
    at = (mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def halved(fold: np.ndarray, size: int) -> np.ndarray:
    """A folded sketch brought to fewer words: halves are joined by XOR, as if it had been made so."""
    while len(fold) > size:
        fold = fold[: len(fold) // 2] ^ fold[len(fold) // 2 :]
    return fold


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, print (128 bits of the whole set), fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = [shingler(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([folded(s) for s in sets], pa.binary())], ["doc_id", "n", "print", "fold"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, print binary, fold binary")


def _keys(docs: DataFrame, words: int, t: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys = [part_keys(s, t) for s in map(shingler, part.column(1).to_pylist())]
                ids = np.repeat(np.array(part.column(0).to_pylist(), dtype=np.int64), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(ids)], ["key", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(run, "key long, doc_id long")


def _candidates(pairs: DataFrame, sets: DataFrame, t: float) -> DataFrame:
    """Distinct pairs (a, b) that sizes and folded sketches allow to be linked."""
    left, right = (sets.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("fold").alias(f"f{x}")) for x in "ab")
    joined = pairs.distinct().join(left, "a").join(right, "b").where((F.least("na", "nb") >= F.greatest("na", "nb") * F.lit(t) - F.lit(1e-9)))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(k) for k in (2, 3, 4, 5)]
            keep = []
            for na, nb, fa, fb in zip(*columns, strict=True):
                folds = _folds([fa.as_py(), fb.as_py()])
                keep.append(bool(_allowed(folds[0], folds[1], na.as_py(), nb.as_py(), t)))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return joined.select("a", "b", "na", "nb", "fa", "fb").mapInArrow(near, "a long, b long")


def _folds(folds: list[bytes]) -> np.ndarray:
    """Folded sketches as rows, all of the length of the shortest."""
    words = [np.frombuffer(f, dtype=np.uint64) for f in folds]
    least = min(map(len, words))
    return np.stack([halved(w, least) for w in words])


def _allowed(fa: np.ndarray, fb: np.ndarray, na: np.ndarray, nb: np.ndarray, t: float) -> np.ndarray:
    return np.bitwise_count(fa ^ fb).sum(axis=-1) <= np.floor((1 - t) / (1 + t) * (na + nb) + 1e-9)


#: Words of the sketch that bucket members are compared by: the folded one brought to 1,024 bits.
SHORT = 16


def short(fold: bytes) -> bytes:
    words = halved(np.frombuffer(fold, dtype=np.uint64), SHORT)
    return np.tile(words, SHORT // len(words)).tobytes() if len(words) < SHORT else words.tobytes()


#: Words of the bitmap that tells which documents a step may need: 8 million bits, whatever the input.
BITMAP_WORDS = 1 << 17


def marked(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """docs with the column `marked`: true for every key of `ids` (one column) and, by chance, a few others.

    The bitmap is at most BITMAP_WORDS rows, so it is broadcast and no text moves.
    """
    bit = lambda c: F.pmod(F.xxhash64(c, F.lit("bit")), F.lit(64 * BITMAP_WORDS))
    bits = ids.select(bit(F.col(ids.columns[0])).alias("bit")).groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    here = docs.withColumn("bit", bit(F.col(key))).withColumn("word", F.expr("bit div 64"))
    found = here.join(F.broadcast(bits), "word", "left").withColumn("marked", F.coalesce(F.expr("shiftright(bits, cast(bit % 64 as int)) & 1L") == 1, F.lit(False)))
    return found.drop("bit", "word", "bits")


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose sets reach the similarity, compared exactly; the texts of a pair travel to it."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    texts = marked(docs.select("doc_id", "text"), needed).where("marked").drop("marked")
    both = pairs.join(texts.withColumnsRenamed({"doc_id": "a", "text": "ta"}), "a").join(texts.withColumnsRenamed({"doc_id": "b", "text": "tb"}), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        set_of = lru_cache(maxsize=64)(Shingler(words))
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column(2), batch.column(3), strict=True):
                own, other = set_of(ta.as_py()), set_of(tb.as_py())
                shared = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(100 * shared >= percent * (len(own) + len(other) - shared))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """id, component: the smallest id reachable by links (a, b) and earlier labels. Large-star and small-star rounds until nothing changes."""
    links = staged(links, "links")
    every = links if known is None else links.unionByName(known.where("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b")))
    edges = staged(every.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "star")
    released(links)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: every greater neighbour of u is linked with u's least neighbour (or u).
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its smaller neighbours are linked with the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        after = staged(small, "star")
        if after.count() == edges.count() and not after.join(edges, ["u", "v"], "left_anti").head(1):
            released(edges)
            return _labels(after)
        released(edges)
        edges = after


def _labels(stars: DataFrame) -> DataFrame:
    out = stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
    out.staged_at = stars.staged_at
    return out


def link_groups(docs: DataFrame, words: int = 4, percent: int = 85, block: int = 4096) -> DataFrame:
    """Every document's number of shingles and its component: the smallest doc_id reachable by links, itself included.

    Two documents link when 100 * shared >= percent * united shingles. Out: doc_id, n_shingles, component_id. Rows without a doc_id
    have no shingles counted as linked: they come back with a null component. Of rows that repeat a doc_id all come back; they are
    one node of the graph, linked through any of their texts. Other columns are left out.
    """
    t = percent / 100
    texts_in_small_batches(docs.sparkSession)
    sets = staged(_sets(docs, words), "shingle-sets")
    some = sets.where("doc_id is not null and n > 0")
    # Equal sets: one representative, linked with the rest. Only prints that several rows have are joined, from a table of their own, so that
    # Spark can split the rows of one that very many have.
    copied = staged(some.groupBy("print").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows")).where("rows > 1").drop("rows"), "copied-prints")
    equal = staged(some.select("doc_id", "print").join(copied, "print").where("doc_id <> rep"), "equal-sets")
    reps = staged(some.join(equal, ["doc_id", "print"], "left_anti").drop("print"), "set-reps")
    # Only documents that are copies of another are looked up among the representatives; the others are their own.
    seen = marked(docs.where("doc_id is not null").select("doc_id", "text"), equal.select("doc_id"))
    own = seen.where("not marked").select("doc_id", "text")
    texts = own.unionByName(seen.where("marked").join(reps.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "text"))
    own_texts = docs.where("doc_id is not null").select("doc_id", "text")
    by_key = Window.partitionBy("key")
    buckets = staged(
        _keys(texts, words, t)
        .withColumn("first", F.min("doc_id").over(by_key))
        .withColumn("last", F.max("doc_id").over(by_key))
        .where("first <> last")
        .distinct(),
        "buckets",
    )
    pairs = [buckets.select(F.col("first").alias("pivot"), "doc_id"), buckets.select(F.col("last").alias("pivot"), "doc_id")]
    tried = staged(_candidates(_nearest(pairs[0].unionByName(pairs[1]).where("pivot <> doc_id")), reps, t), "tried")
    labels = components(_verified(tried, own_texts, words, percent))
    opened = _open(buckets, labels)
    released(buckets)
    again = _nearest(_pivots(opened))
    more = staged(_candidates(again, reps, t).join(tried, ["a", "b"], "left_anti"), "tried")
    labels = components(_verified(more, own_texts, words, percent), labels)
    # Every other pair of a bucket is either within a component or compared here, so no further round is needed.
    still = _open(opened, labels)
    released(opened)
    left = staged(_candidates(_between(still, reps, t, block), reps, t).join(tried.unionByName(more), ["a", "b"], "left_anti"), "between")
    released(still, tried, more)
    labels = components(_verified(left, own_texts, words, percent), labels)
    united = components(equal.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")), labels)
    released(left, copied, equal, reps)
    out = sets.join(united, sets.doc_id == united.id, "left")
    return out.select(sets.doc_id, F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _nearest(pairs: DataFrame, most: int = 2) -> DataFrame:
    """a < b for each document with the pivots that it meets in most buckets. pairs: pivot, doc_id, a row for each bucket."""
    counted = pairs.groupBy("doc_id", "pivot").count()
    best = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("count"), "pivot"))
    return counted.withColumn("r", best).where(F.col("r") <= most).select(F.least("doc_id", "pivot").alias("a"), F.greatest("doc_id", "pivot").alias("b"))


def _open(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """key, doc_id, component, members of the buckets that hold several components."""
    labelled = buckets.select("key", "doc_id").join(labels, F.col("doc_id") == F.col("id"), "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    several = labelled.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("members")).where("c0 <> c1").select("key", "c0", "members")
    return staged(labelled.join(several, "key"), "open-buckets")


def _pivots(opened: DataFrame) -> DataFrame:
    """In every bucket the first document of the least component, as pivot for those of other components."""
    pivot = opened.where("component = c0").groupBy("key").agg(F.min("doc_id").alias("pivot"))
    return opened.where("component <> c0").join(pivot, "key").select("pivot", "doc_id")


def _between(opened: DataFrame, sets: DataFrame, t: float, block: int) -> DataFrame:
    """Pairs of different components that share a bucket and that sizes and short sketches allow.

    Buckets lie whole in one task, up to `block` members; larger ones are cut into blocks, whose pairs (i <= j) are tasks' rows of their own.
    """
    count = F.ceil(F.col("members") / block).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), count).cast("int")
    members = opened.join(sets.select("doc_id", "n", "fold"), "doc_id")
    zero = F.lit(0)
    whole = members.where(F.col("members") <= block).select("key", zero.alias("i"), zero.alias("j"), zero.alias("own"), "doc_id", "component", "n", "fold")
    large = members.where(F.col("members") > block).withColumn("own", own).withColumn("other", F.explode(F.sequence(zero, count - 1)))
    cut = large.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc_id", "component", "n", "fold")
    dealt = whole.unionByName(cut).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, now]).combine_chunks() if held is not None else now
            group = _group_numbers(held)
            if len(group) and group[-1] > 0:  # the last bucket may go on in the next batch
                cut_at = int(np.searchsorted(group, group[-1]))
                yield _allowed_pairs(held.slice(0, cut_at), group[:cut_at], t)
                held = held.slice(cut_at)
        if held is not None and held.num_rows:
            yield _allowed_pairs(held, _group_numbers(held), t)

    return dealt.mapInArrow(compare, "a long, b long")


def _group_numbers(rows: pa.Table) -> np.ndarray:
    if not rows.num_rows:
        return np.zeros(0, dtype=np.int64)
    changed = np.zeros(rows.num_rows - 1, dtype=bool)
    for c in ("key", "i", "j"):
        x = rows.column(c).to_numpy()
        changed |= x[1:] != x[:-1]
    return np.concatenate(([0], np.cumsum(changed)))


def _allowed_pairs(rows: pa.Table, group: np.ndarray, t: float) -> pa.RecordBatch:
    """All pairs of equal group, each row with those 1, 2, 3 ... places after it."""
    doc, component, n, i, j, own = (rows.column(c).to_numpy() for c in ("doc_id", "component", "n", "i", "j", "own"))
    folds = rows.column("fold").to_pylist()
    words = np.array([len(f) // 8 for f in folds], dtype=np.int64)
    brief = np.frombuffer(b"".join(map(short, folds)), dtype=np.uint64).reshape(-1, SHORT)
    found = [np.zeros((0, 2), dtype=np.int64)]
    for lag in range(1, len(group)):
        at = np.flatnonzero(group[lag:] == group[:-lag])
        if not len(at):
            break
        b = at + lag
        keep = (component[at] != component[b]) & ((i[at] == j[at]) | (own[at] != own[b])) & (np.minimum(n[at], n[b]) >= np.maximum(n[at], n[b]) * t - 1e-9)
        at, b = at[keep], b[keep]
        # Sketches shorter than SHORT words are repeated to that length, so their distance is repeated as often.
        times = SHORT // np.minimum(np.minimum(words[at], words[b]), SHORT)
        for a0 in range(0, len(at), 1 << 16):
            x, y = at[a0 : a0 + (1 << 16)], b[a0 : a0 + (1 << 16)]
            left, right = brief[x], brief[y]
            mixed_sizes = np.flatnonzero(words[x] != words[y])
            far = np.bitwise_count(left ^ right).sum(axis=1) / times[a0 : a0 + (1 << 16)]
            for k in mixed_sizes:
                small = int(min(words[x[k]], words[y[k]], SHORT))
                far[k] = np.bitwise_count(halved(left[k][: max(small, int(min(words[x[k]], SHORT)))], small) ^ halved(right[k][: max(small, int(min(words[y[k]], SHORT)))], small)).sum()
            ok = far <= np.floor((1 - t) / (1 + t) * (n[x] + n[y]) + 1e-9)
            found.append(np.stack((np.minimum(doc[x[ok]], doc[y[ok]]), np.maximum(doc[x[ok]], doc[y[ok]])), axis=1))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


#: DuckDB SQL for link_groups() with the defaults.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * shared >= 85 * (na + nb - shared)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS id, doc_id AS c FROM s UNION SELECT r.id, l.b FROM reach r JOIN both_ways l ON r.c = l.a)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, min(r.c)::BIGINT AS component_id FROM s JOIN reach r ON s.doc_id = r.id GROUP BY 1, 2
"""
