"""Searches, near duplicates, mixing and the pipeline against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rosterspark.llm import curve_search, exact_topk, mixing, near_duplicates

SF = "/root/testdata/sf0.001"
V = "vec_id long, embedding array<float>, rank string"


def vectors(spark, n=400, dims=12, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)).astype(np.float32)
    x[50:90] = x[50]  # a crowd of equal vectors
    rows = [(i, x[i].tolist(), "c") for i in range(n)]
    rows += [(n, None, "c"), (n + 1, [None] * dims, "c"), (n + 2, [float("nan")] * dims, "c"), (n + 3, [float("inf")] * dims, "c"), (n + 4, [1.0], "c"), (None, x[0].tolist(), "c"), (7, x[7].tolist(), "c")]
    return spark.createDataFrame(rows, V), x


def test_exact_topk_equals_brute_force(spark):
    df, x = vectors(spark)
    whole = np.floor(x.astype(np.float64) * 256)
    got = {}
    for r in exact_topk.search(df, F.col("id") % 10 == 0, pivots=8, block=64).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 400, 10))
    for q, rows in got.items():
        scores = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(400), -scores)) if i != q][:5]
        assert sorted(rows) == [(k + 1, i, int(scores[i])) for k, i in enumerate(order)]


def test_exact_topk_with_repeated_rows(spark):
    """Tight clusters, ten copies of a query and of a row beside it, and an id with many vectors."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(10, 8)) * 4
    x = (centres[np.arange(200) % 10] + rng.normal(size=(200, 8)) * 0.01).astype(np.float32)
    x[[0, 1, 2]] = [np.eye(8)[0] * 90, np.eye(8)[0] * 90 + 0.05, np.eye(8)[1] * 90]
    rows = [(i, v.tolist(), "") for i, v in enumerate(x)]
    rows += [rows[0]] * 10 + [rows[1]] * 10 + [(2, (np.eye(8)[1] * 90 + 0.1 * n).astype(np.float32).tolist(), "") for n in range(1, 10)]
    df = spark.createDataFrame(rows, V).repartition(4)
    whole = {(i, *np.floor(np.array(v, dtype=np.float32).astype(np.float64) * 256)) for i, v, _ in rows}
    for pivots in (4, 40, 220):
        got = {}
        for r in exact_topk.search(df, F.col("id") < 20, pivots=pivots).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        for q in range(20):
            scores = sorted((-int(np.dot(a[1:], b[1:])), int(b[0])) for a in whole if a[0] == q for b in whole if b[0] != q)[:5]
            assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]


def test_exact_topk_few_rows_and_large_numbers(spark):
    assert exact_topk.search(spark.createDataFrame([], V), F.lit(True)).count() == 0
    df = spark.createDataFrame([(1, [1e9, 2.0], ""), (2, [1e9, -2.0], "")], V)
    most = 2**63 - 1
    assert [tuple(r) for r in exact_topk.search(df, F.lit(True)).orderBy("query_id").collect()] == [(1, 1, 2, most), (2, 1, 1, most)]
    small = spark.createDataFrame([(1, [3e5, 2.0], ""), (2, [3e5, -2.0], "")], V)
    n = int(3e5) * 256
    assert [tuple(r) for r in exact_topk.search(small, F.lit(True)).orderBy("query_id").collect()] == [(1, 1, 2, n * n - 512 * 512), (2, 1, 1, n * n - 512 * 512)]


@pytest.mark.parametrize("kind", ["array<float>", "array<double>"])
def test_exact_topk_keeps_every_finite_vector(spark, kind):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(60)]
    rows += [(100, [3e16, 1.0, 0.0, -1.0]), (101, [3e16, -2.0, 0.5, 0.0]), (102, [1.0, 3e16, 0.0, 0.0]), (103, [-1e30, 1e30, 1.0, 2.0]), (104, [1.5, 1e18, 0.0, 0.0])]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    if kind == "array<double>":
        rows += [(105, [1e308, 0.0, 0.0, 0.0]), (106, [-1e308, 1.0, 0.0, 0.0])]
    most = 2**63 - 1
    scaled = {i: [int(np.floor(np.clip(np.float64(256) * x, -exact_topk.MOST, exact_topk.MOST))) for x in v] for i, v in rows}
    want = []
    for q, a in scaled.items():
        scores = sorted((-max(-most, min(most, sum(x * y for x, y in zip(a, b, strict=True)))), i) for i, b in scaled.items() if i != q)
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:5], 1)]
    with np.errstate(all="ignore"):
        got = exact_topk.search(spark.createDataFrame(rows, f"vec_id long, embedding {kind}"), F.lit(True), pivots=8, block=16)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_hilbert_curve_steps_to_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        keys = curve_search.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_curve_search_recall_and_scores(spark):
    df, x = vectors(spark, 600, 16, 2)
    data = x.astype(np.float64)
    got = {}
    for r in curve_search.search(df, F.col("id") % 20 == 0, block=50).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q in range(0, 600, 20):
        far = np.sqrt(((data - data[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(600), far)) if i != q][:10]
        rows = sorted(got[q])
        assert [r[0] for r in rows] == list(range(1, 11)) and all(s == pytest.approx(far[i], abs=1e-12) for _, i, s in rows)
        assert rows == sorted(rows, key=lambda r: (r[2], r[1]))
        hits, total = hits + len({i for _, i, _ in rows} & set(order)), total + 10
    assert hits / total >= 0.9
    assert [i for _, i, _ in sorted(got[60])] == [i for i in range(50, 61) if i != 60]  # equal vectors: the smallest ids


def test_curve_search_edges(spark):
    assert curve_search.search(spark.createDataFrame([], V), F.lit(True)).count() == 0
    df = spark.createDataFrame([(1, [0.0, 0.0], ""), (2, [1.0, 0.0], ""), (3, [1.0, 1.0], "")], V)
    assert [tuple(r) for r in curve_search.search(df, F.lit(True)).orderBy("query_id").collect()] == [(2, 1, 3, 1.0), (3, 1, 2, 1.0)]


def test_curve_search_ties_go_to_the_smaller_id(spark):
    rows = [(0, [0.2] * 40, "")] + [(i + 1, [float(i == j) for j in range(40)], "") for i in range(40)]
    got = curve_search.search(spark.createDataFrame(rows, V), F.col("id") == 0, block=8).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == list(range(1, 11)) and len({r.score for r in got}) == 1


def test_curve_search_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [r for r in df.select("vec_id", "embedding").collect() if r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding) and any(r.embedding)]
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    got = {}
    for r in curve_search.search(df, F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        far = np.where(ids == ids[q], np.inf, ((x - x[q]) ** 2).sum(axis=1))
        hits, total = hits + len(got[ids[q]] & set(ids[np.lexsort((ids, far))[:10]].tolist())), total + 10
    assert hits / total >= 0.9


def test_voronoi_bounds_prune_clustered_vectors(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16)) * 5
    x = (centres[np.arange(2000) % 40] + rng.normal(size=(2000, 16)) * 0.05).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), "") for i, v in enumerate(x)], V)
    assert exact_topk.replication(df, F.col("id") % 50 == 0, pivots=64) < 0.3
    whole = np.floor(x.astype(np.float64) * 256)
    for r in exact_topk.search(df, F.col("id") % 50 == 0, pivots=64).where("rank = 5").collect():
        scores = np.delete(whole @ whole[r.query_id], r.query_id)
        assert r.score == int(np.sort(scores)[-5])


def brute_groups(rows, words=4, percent=85):
    sets = {}
    for i, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in __import__("re").split("[\x20\x09-\x0d]+", low) if x]
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def texts(seed=4):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(400)]
    out = [None, "", " \t", "One", "one", "two words", "TWO words", "a b c d", "a b c d"]
    passage = [rng.choice(vocab) for _ in range(45)]
    for n in (8, 15, 30, 60, 120, 300, 900):
        for _ in range(2):
            base = [rng.choice(vocab) for _ in range(n)]
            out.append(" ".join(base))
            for _ in range(8):  # copies with a few words changed: some reach the threshold, some don't
                copy = list(base)
                for _ in range(rng.randint(0, max(1, n // 25))):
                    copy[rng.randrange(n)] = rng.choice(vocab)
                out.append(" ".join(copy))
    for _ in range(40):  # a passage that many share
        out.append(" ".join(passage + [rng.choice(vocab) for _ in range(rng.randint(2, 25))]))
    chain = [rng.choice(vocab) for _ in range(100)]
    for k in range(12):  # links in a chain whose ends aren't linked
        out.append(" ".join(chain[k * 2 : k * 2 + 70]))
    return out


def test_groups_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_shingles string")
    want = brute_groups(rows)
    for block in (4096, 7):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.link_groups(df, block=block).collect()}
        assert got == want
    assert len({c for _, c in want.values()}) < len(want)


def test_groups_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e", "x"), (5, "a b c d e", "x"), (5, "a b c d e", "x"), (3, "A B C D E", "x")], "doc_id long, text string, lang string")
    assert sorted(map(tuple, near_duplicates.link_groups(df).collect()), key=str) == sorted([(None, 2, None), (5, 2, 3), (5, 2, 3), (3, 2, 3)], key=str)
    assert near_duplicates.link_groups(df.limit(0)).count() == 0


def water_fill(size, weight, total):
    cap = {s: 2 * n for s, n in size.items()}
    done = {}
    while True:
        rest = [s for s in size if s not in done]
        left = total - sum(done.values())
        share = {s: left * weight[s] / sum(weight[t] for t in rest) for s in rest}
        over = [s for s in rest if share[s] >= cap[s]]
        if not over:
            return done | share
        done |= {s: cap[s] for s in over}
        if len(done) == len(size):
            return done


def test_mix_reaches_targets(spark):
    rng = random.Random(5)
    rows = [(i, None if i % 97 == 0 else "w " * rng.randint(0, 60), rng.choice(["b", "a", "c", "c", "c", None, "é", "zero"]), "x") for i in range(3000)]
    rows = [(i, "" if s == "zero" else t, s, x) for i, t, s, x in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    out = mixing.mix(df).collect()
    size, order = {}, sorted({s for _, _, s, _ in rows if s is not None}) + [None]
    for _, t, s, _ in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    want = water_fill(size, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(size.values()))
    taken = {}
    for r in out:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == size[r.source] and r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert len(out) == 3000 and all(abs(taken[s] - want[s]) <= 60 for s in size)
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))


def test_mix_edges(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    one = mixing.mix(spark.createDataFrame([(None, "a b", "s"), (None, "a b", "s")], schema)).collect()
    assert sorted(r.taken for r in one) == [2, 4] and one[0].target == 6.0
    blank = mixing.mix(spark.createDataFrame([(1, None, None)], schema)).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)]
    kept = mixing.mix(spark.createDataFrame([(1, "a", "s", 7)], schema + ", target int"), keep=True)
    assert kept.columns[:3] == ["doc_id", "text", "source"] and kept.count() == 1


def test_near_duplicate_stage_with_repeated_and_null_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, a), (5, a), (3, a), (3, a), (None, a), (None, b), (None, b), (7, c), (8, "x"), (8, "x"), (9, None), (9, None), (None, None), (None, None), (None, "y"), (None, "y")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicate(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(3, a), (None, b), (7, c), (8, "x"), (9, None), (None, None), (None, "y")], key=str)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(900_001, "12345 !!!", "en", "src0", 9), (900_002, None, None, None, None)], docs.schema)
    now = docs.unionByName(extra)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "toxicity", "near_duplicates", "mixing", "tokens"]
    for name, stage in corpus_pipeline.STAGES:
        before = now
        now = stage(spark, before, SF)
        if name != "tokens":
            assert now.columns == docs.columns
        if name == "language":
            assert sorted(r.doc_id for r in before.join(now, "doc_id", "left_anti").collect()) == [900_001, 900_002]
        if name == "toxicity":
            gone = {r.doc_id for r in before.join(now, "doc_id", "left_anti").collect()}
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert gone and all(labels.get(d, 1) == 1 for d in gone)
        if name == "near_duplicates":
            want = {c for _, c in brute_groups([(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]).values()}
            assert sorted(r.doc_id for r in now.collect()) == sorted(want)
        if name == "mixing":
            copies = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
            assert {r.doc_id: r["count"] for r in now.groupBy("doc_id").count().collect()} == {d: c for d, c in copies.items() if c}
        now = now.cache()
    assert now.count() == before.count() > 0
