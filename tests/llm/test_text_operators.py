"""HTML text, tokens, languages, toxicity and pseudo-likelihood: edge cases, and brute force or held-out accuracy."""

import hashlib
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterspark.llm import bpe, html_text, language_id, masked_lm, token_counts, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS, PIECES = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
PARTS = ["a", "é", " ", "  ", "\n", "\t", "\x85", "\xa0", "'s", "'t", "1", "²", "Ⅷ", "漢", "😀", "​", "\x1c", ".", "!!", "▁", "<s>", "<|endoftext|>", "́"]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return [None, "", " ", "x" * 50_000, "word " * 30_000, *("".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n))]


def documents(spark, texts, extra="clash"):
    rows = [(i, t, extra) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_bpe_equals_the_library_and_round_trips(spark):
    import tiktoken

    texts = odd_texts(400)
    tokens = bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    docs = documents(spark, texts)
    got = {r.doc_id: r for r in bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    encoded = bpe.encode(docs, RANKS)
    assert {r.doc_id: r.text for r in bpe.decode(encoded, RANKS).collect()} == {i: t or "" for i, t in enumerate(texts)}
    for r in encoded.where("doc_id > 4").collect():
        text = texts[r.doc_id]
        assert all(0 <= a < b <= len(text) for a, b in zip(r.starts, r.ends, strict=True))
        assert {k for a, b in zip(r.starts, r.ends, strict=True) for k in range(a, b)} == set(range(len(text)))


def test_bpe_other_pattern_whole_texts(spark):
    docs = documents(spark, ["ab  cd", "it's"])
    assert [r.text for r in bpe.decode(bpe.encode(docs, RANKS, r"\S+|\s+"), RANKS).orderBy("doc_id").collect()] == ["ab  cd", "it's"]


def test_bpe_empty_table(spark):
    assert bpe.round_trip(documents(spark, []), RANKS).count() == 0 and bpe.encode(documents(spark, []), RANKS).count() == 0


def test_token_counts_equal_the_library(spark):
    texts = odd_texts(400, 2)
    sp = token_counts.model(PIECES)
    got = {r.doc_id: r for r in token_counts.token_counts(documents(spark, texts), PIECES, limit=10).collect()}
    for i, t in enumerate(texts):
        n = len(sp.encode_as_ids(t or ""))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 10)
    assert token_counts.token_counts(documents(spark, []), PIECES).count() == 0


PAGE = """<html><head><title>t</title><style>p{}</style></head><body class="no-sidebar"><header><h1>Site</h1></header><nav><a href=x>m</a></nav><div class="sidebar">side text</div>
<div id="main-content"><h1>Title &amp; so</h1><p>First para with <a href=1>link</a> text, long enough to be content, really.<p>Second
  para&nbsp;with <b>bold</b><br>line<ul><li>one<li>two</ul><blockquote>quote</blockquote><div class="comments"><p>reader said</p></div></div>
<aside>x</aside><form><input><p>form p</p></form><footer>f</footer><script>var a="<p>zz</p>";</script></body></html>"""


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE).split("\n") == ["Title & so", "First para with link text, long enough to be content, really.", "Second para with bold line", "one", "two", "quote"]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<p>", ""), ("plain text", "plain text"), (" a < b & c ", "a < b & c"), ("<div>only</div>", "only"),
        ("<article><header><h1>T</h1><span>by x</span></header><p>a</p><section id=comments>z</section></article>", "T\na"),
        ("<article><p>a<!-- <p>no</p> -->b<p>c</article><div class='ad banner'>buy</div>", "ab\nc"),
        ("<article><p>x &amp;amp; y &#233; &eacute</p></article>", "x &amp; y é é"),
        ("<div>" * 3000 + "x" + "</div>" * 3000, "x"),
    ],
)
def test_main_text_cases(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article><p class="notice">Cookies<p>Real text</article>', "Real text"),
        ('<ul><li class="share">x<li>y</ul><p>Text', "y\nText"),
        ('<div><p class="ad">buy<h2>T</h2>a<p>b</div>', "T\na\nb"),
        ('<div><div class="ad"><p>buy</div><p>text</div>', "text"),
        ("<div><nav><ul><li>a<li>b</div><p>text", "text"),
        ('<article><p>a <span class="ad">buy</p><p>b</article>', "a\nb"),
        ('<article><dl><dt class="share">x<dd>y<dt>z</dl>t</article>', "y\nz\nt"),
        ('<article><table><tr class="ad"><td>buy<td>now<tr><td>a<td>b</table><p>c</article>', "a\nb\nc"),
        ("<table><thead hidden><tr><th>x<tbody><tr><td>y</table>", "y"),
        ('<ul><li class="share"><ul><li>x<li>y</ul><li>z</ul>', "z"),
        ('<p class="notice">x<hr>y', "y"),
        ("<html><head><title>x</title><meta charset=a><body><p>y", "y"),
        ('<div><a href=x><div class="ad">buy</a> now</div></div><p>y', "y"),
        ('<div><h3 class="related">x</h2><p>y</div>', "y"),
        ('<div class="ad"><p>x<p>y<ul><li>z</ul>still</div><p>y', "y"),
        ('<div><table class="ad"><tr><td>x</div>buy</table>y</div>', "y"),
    ],
)
def test_left_out_elements_with_omitted_end_tags(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><p>a</p><a title=it's>b</a></article>", "a\nb"),
        ('<p>a<p class="x>Hello', "a"),  # a quote that doesn't end takes the rest
        ("a < b <3 <p>c</p", "a < b <3\nc"),
        ("<p>a<!-- x --!>b<!-->c</>d</3>e<?php x ?>f", "abcdef"),
        ("<p>x<a href=>y</a> <b =x>z</b>", "xy z"),
        ('<p data-id="ad" title="class=ad">x</p>', "x"),
        ("<script>a</scriptx></script >t", "t"),
        ('<article><p class="search-engine">a<p class="related-work">b<p class="ad-slot-2">c<p class=siteFooter>d</article>', "a\nb"),
        ('<article><p>a<ins class="adsbygoogle">b</ins><div class="share-buttons">c</div><div class="alert">d</div><div class="fb-comments">e</div><div class="AdUnit_3">f</div><p class="address">g<p class="adverbs">h</article>', "a\ng\nh"),
        ("<article><header><h1>T</h1><p>lead</header><p>b</article>", "T\nlead\nb"),
    ],
)
def test_tags_as_html_reads_them(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page", ["<a " * 350_000, "<a b='" * 180_000, "<!-- " * 250_000, "<script>" + "</script " * 120_000, "<" * 1_000_000, "<a" + " b" * 500_000])
def test_a_page_of_a_megabyte_takes_seconds(page):
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 2


def plain_density(node, body_share):
    """(characters, link characters, tags, link tags, density) by recursion over what the node holds."""
    c = lc = t = lt = 0
    for x in node.children:
        if isinstance(x, str):
            c += len(" ".join(x.split()))
        else:
            a, b, d, e = plain_density(x, body_share)[:4]
            c, lc, t, lt = c + a, lc + b, t + d + 1, lt + e + (x.name == "a")
    if node.name == "a":
        lc = c
    if not c:
        return c, lc, t, lt, 0.0
    tags, links = max(1, t), max(1, lt)
    base = math.log(c / max(1, c - lc) * lc + body_share * c + math.e)
    return c, lc, t, lt, c / tags * max(0.0, math.log(max(1e-9, c / max(1, lc) * tags / links)) / base)


def test_densities_and_the_chosen_subtree_of_pages_without_article():
    rng = random.Random(9)
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(2, 7)):
            words = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(n))
            parts.append(f"<div>{''.join(rng.choice([f'<p>{words(rng.randrange(1, 60))}</p>', f'<a href=x>{words(2)}</a>', f'<div><p>{words(9)}</p></div>']) for _ in range(rng.randrange(1, 6)))}</div>")
        root = html_text.parse("".join(parts))
        nodes = html_text.in_order(root)
        html_text.measure(nodes)
        c, lc = plain_density(root, 0.0)[:2]
        share = lc / max(1, c)
        for node in nodes:
            assert node.density == pytest.approx(plain_density(node, share)[4])
        sums = [sum(plain_density(x, share)[4] for x in node.children if not isinstance(x, str)) for node in nodes]
        again = html_text.parse("".join(parts))
        best = html_text.in_order(again)[max(range(len(nodes)), key=lambda k: (sums[k], -k))]
        chosen = html_text.content(again)
        assert best in chosen or any(best in html_text.in_order(x) for x in chosen)


def test_extract_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>é  b</p>", 0), (1, "u", "<p>é  b</p>", 0), (None, None, None, 0)], "page_id long, url string, html string, text int")
    assert sorted(map(tuple, html_text.extract(df).collect()), key=str) == sorted([(1, "u", "é b", 3), (1, "u", "é b", 3), (None, None, "", 0)], key=str)
    assert html_text.extract(df.limit(0)).count() == 0


def test_articles_of_the_sample_pages(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html_text.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(b for b in blocks if b)


def test_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    profiles = language_id.learn(docs)
    out = language_id.identify(docs, profiles).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert held and sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.95 and all(0 <= r.score <= 1 for r in out)
    odd = documents(spark, [None, "", "123 ... 😀", "the", "é" * 5000, "The and of the " * 20_000])
    got = {r.doc_id: r for r in language_id.identify(odd, profiles).collect()}
    assert [got[i].lang_pred for i in range(3)] == ["und"] * 3 and got[0].score == 0.0 and got[5].lang_pred == "en"
    kept = language_id.identify(odd.withColumn("score", F.lit("mine")), profiles, keep=True)
    assert kept.columns == ["doc_id", "text", "n_tokens", "lang_pred", "score"] and kept.count() == 6
    empty = language_id.learn(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(odd, empty).collect()} == {"und"} and language_id.identify(docs.limit(0), profiles).count() == 0


def test_out_of_place_distance_by_hand():
    a, b, c = map(ord, "abc")
    p = language_id.Profiles({"x": [a, b], "y": [b, c]}, 4)
    langs, scores = p.nearest(["aab"])
    count = {}
    text = [1, a, a, b, 1]
    for n in (1, 2, 3):
        for i in range(len(text) - n + 1):
            g = text[i : i + n]
            if g == [1] or n == 3 and g[1] == 1:
                continue
            key = sum(c << 16 * (n - 1 - k) for k, c in enumerate(g))
            count[key] = count.get(key, 0) + 1
    ranked = sorted(count, key=lambda g: (-count[g], g))[:4]
    far = {lang: sum(abs(prof.index(g) - r) if g in prof else 4 for r, g in enumerate(ranked)) for lang, prof in (("x", [a, b]), ("y", [b, c]))}
    assert langs == [min(far, key=lambda k: (far[k], k))] and scores[0] == pytest.approx(1 - min(far.values()) / (4 * len(ranked)))


def test_toxicity_learns_words_in_clauses(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        text = [rng.choice(words) for _ in range(60)]
        toxic = int(i % 5 == 0)
        for _ in range(2 * toxic):
            text.insert(rng.randrange(60), "grubl" + rng.choice(["ot", "ix", "ung"]))
        rows.append((i, " ".join(text), "s"))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    lab = spark.createDataFrame([*labels, (None, 1), (5000, None)], "doc_id long, toxic int")
    grammar, w = toxicity.learn(docs, lab)
    got = {r.doc_id: r for r in toxicity.score(docs, grammar, w).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].predicted == labels[i][1] for i in held) / len(held) > 0.95
    odd = {r.doc_id: r for r in toxicity.score(documents(spark, [None, "", "grublot " * 20_000]), grammar, w).collect()}
    assert odd[0].score == odd[1].score < 0.3 and odd[2].predicted == 1
    assert toxicity.score(docs.limit(0), grammar, w).count() == 0


def test_toxicity_without_labels(spark):
    docs = documents(spark, ["you idiot", "a calm day"])
    grammar, w = toxicity.learn(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.predicted for r in toxicity.score(docs, grammar, w).orderBy("doc_id").collect()] == [1, 0]


def test_grammar_kinds():
    g = toxicity.Grammar({})
    kinds = lambda text: [toxicity.KINDS[k] for k in np.flatnonzero(g.sums(text))]
    assert kinds("what an idiot") == ["plain"]
    assert kinds("you are an idiot") == ["aimed"] and kinds("idiot , you") == ["aimed"]
    assert kinds("he is not an idiot") == ["denied"]
    assert kinds("someone said idiot") == ["reported"]
    assert kinds("kill them") == ["aimed threat"] and kinds("nothing here") == []
    assert kinds("doctors treat people hurt in the accident") == [] and kinds("idiot") == [] and kinds("idiot.\nyou") == []  # no target; no clause
    assert kinds("you\tidiot") == kinds("you\u00a0idiot") == ["aimed"]  # any white space parts words
    assert kinds("he said she will not kill you") == ["denied"]
    assert kinds("you. an idiot") == ["plain"]  # clauses end at full stops


def test_composed_transducers_equal_those_one_after_the_other():
    rng = random.Random(2)
    for _ in range(300):
        clause = [rng.choice((0, 0, toxicity.INSULT, toxicity.THREAT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT)) for _ in range(rng.randrange(1, 15))]
        read, weights = clause, [1.0] * len(clause)
        for t in (toxicity.DENIALS, toxicity.QUOTES, toxicity.TARGETS):
            out = t.read(read)
            read, weights = [s for s, _ in out], [w * x for w, (_, x) in zip(weights, out, strict=True)]
        assert toxicity.CLAUSES.read(clause) == list(zip(read, weights, strict=True))


def test_pseudo_likelihood_equals_a_plain_loop(spark):
    classes, hidden = 1 + 5 + 4, 3
    words = ["the", "of", "a", "in", "to"]
    weights = masked_lm.Network.start(classes, hidden, 1)
    texts = [None, "", "the", "the end of a day", "x " * 3000]
    got = {r.doc_id: r for r in masked_lm.score(documents(spark, texts), words, weights, 5, 4, hidden, chunk=64).collect()}
    net, read = masked_lm.Network(weights, classes, hidden), masked_lm.Classes(words, 4)
    for i, t in enumerate(texts):
        c = [0, 0, *read.read(t), 0, 0]
        total = 0.0
        for k in range(2, len(c) - 2):
            h = np.tanh(net.bias + sum(net.tables[j][c[k + p]] for j, p in enumerate(masked_lm.PLACES)))
            s = h @ net.out + net.prior
            total += s[c[k]] - np.log(np.exp(s).sum())
        assert got[i].n_tokens == len(c) - 4 and got[i].log_prob == pytest.approx(total, rel=1e-4, abs=1e-5)
    assert got[0].per_token is None


def test_shuffled_and_invented_words_score_below_text(spark):
    rng = random.Random(5)
    subjects, verbs, things = (["".join(rng.choice("abcdefghijklmnopr") for _ in range(6)) + e for _ in range(60)] for e in ("ant", "ide", "ory"))
    texts = [" ".join(f"the {rng.choice(subjects)} will {rng.choice(verbs)} a {rng.choice(things)} ." for _ in range(20)) for _ in range(200)]
    words, weights = masked_lm.learn(documents(spark, texts), frequent=5, buckets=8)
    new = {w: "".join(rng.choice("qwxyz") for _ in range(6)) + w[-3:] for w in subjects + verbs + things}
    real = texts[0].split()
    odd = [" ".join(real), " ".join(rng.sample(real, len(real))), " ".join(new.get(w, w) for w in real), " ".join("zzzzqxant" if w in subjects else w for w in real)]
    got = [r.per_token for r in masked_lm.score(documents(spark, odd), words, weights, 5, 8).orderBy("doc_id").collect()]
    assert got[0] > got[1] + 0.5 and got[0] > got[2] + 1 and got[0] > got[3] + 0.5
    own, shares = masked_lm.Classes(words, 8), {}
    for w in subjects + verbs + things:
        shares[own[w]] = shares.get(own[w], 0) + np.exp(words.term(w, own[w]))
    assert all(0.95 < p <= 1 for p in shares.values())


def test_terms_of_many_words_equal_those_of_each():
    random = np.random.default_rng(5)
    words = masked_lm.Words(["the"], {"known": -2.5}, random.normal(size=40), random.normal(size=(256, 256)))
    given = ["the", "known", "x", "é\0ñ", "\ud800", "w" * 3000, *(f"made{k}" for k in range(50))]
    classes = [1, *(2 + k % 38 for k in range(len(given) - 1))]
    expected = [words.term(w, c) for w, c in zip(given, classes, strict=True)]
    for at_once in (1, 7, 1000):
        assert np.allclose(words.each_term(given, classes, at_once), expected, rtol=1e-12)
    assert words.each_term([], []) == []


def test_held_out_perplexity_beats_a_unigram_model(spark):
    rng = random.Random(8)
    subjects, verbs, things = (["".join(rng.choice("abcdefghijklmnopr") for _ in range(5)) + e for _ in range(20)] for e in ("ant", "ide", "ory"))
    text = lambda: " ".join(f"the {rng.choice(subjects)} will {rng.choice(verbs)} a {rng.choice(things)} ." for _ in range(20))
    seen, held_out = [text() for _ in range(150)], [text() for _ in range(20)]
    words, weights = masked_lm.learn(documents(spark, seen), frequent=5, buckets=8)
    counts = Counter(w for t in seen for w in t.split())
    unigram = np.mean([np.log(counts[w] / sum(counts.values())) for t in held_out for w in t.split()])
    r = masked_lm.score(documents(spark, held_out), words, weights, 5, 8).agg((F.sum("log_prob") / F.sum("n_tokens")).alias("x")).first()
    assert np.exp(-r.x) < 0.7 * np.exp(-unigram)


def test_a_model_depends_on_the_documents_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    models = [masked_lm.learn(docs.repartition(n), shard_tokens=1 << 14) for n in (1, 6)]
    assert models[0][0] == models[1][0] and np.allclose(models[0][1], models[1][1], atol=1e-5)


def test_training_raises_the_likelihood(spark):
    docs = spark.createDataFrame([(i, "the cat sat on the mat . " * 40) for i in range(40)], "doc_id long, text string")
    mean = lambda model: masked_lm.score(docs, *model).agg(F.avg("per_token")).first()[0]
    assert mean(masked_lm.learn(docs, stride=4)) > mean(masked_lm.learn(docs, stride=4, rounds=0)) + 1
    words, weights = masked_lm.learn(docs.limit(0))
    assert words == [] and masked_lm.score(docs.limit(0), words, weights).count() == 0
