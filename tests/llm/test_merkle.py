"""The Merkle manifest against a plain walk over lists of hashes."""

import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from rosterspark.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)])


def tree(hashes):
    """The root and, for each place, the siblings (before, after) level by level."""
    paths, at, nodes = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = a // 8 * 8
            paths[i].append((nodes[run:a], nodes[a + 1 : run + 8]))
        at = [a // 8 for a in at]
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def by_hand(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row, leaf(row, row[1])))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda p: (p[0][0] is not None, p[0][0] or 0, p[1]))
        trees[g] = tree([p[1] for p in groups[g]])
    root, upper = tree([trees[g][0] for g in names]) if names else (None, [])
    out = []
    for g, up in zip(names, upper, strict=True):
        subroot, low = trees[g]
        for (row, own), path in zip(groups[g], low, strict=True):
            path = path + up
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None
            acc = leaf(row, row[1].translate(LOWER)) if bad else own
            for before, after in path:
                acc = h(*before, acc, *after)
            proof = h(*[x for before, after in path for x in (*before, *after)])
            out.append((row[0], own, subroot, root, proof, acc, acc == root))
    return sorted(out, key=repr)


def got(df):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)


def document(i, lang="en", text="Some Text {}", source="web"):
    text = None if text is None else text.format(i)
    return (i, text, lang, source, None if text is None else len(text))


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 74, 520])
def test_sizes_around_the_powers_of_eight(spark, n):
    rows = [document(i) for i in range(n)]
    assert got(merkle.verified(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows)


def test_many_groups_nulls_ties_and_repeated_rows(spark):
    rows = [document(i, lang=f"l{i % 11}" if i % 13 else None, text=None if i % 7 == 0 else "É Ab {}", source=None if i % 5 == 0 else "s") for i in range(150)]
    rows += [document(3, lang="l3", text="other {}"), document(3, lang="l3", text="other {}"), (None, "No Id", "l3", None, None), (None, None, None, None, None), (-4, "", "", "", 0), (5, "X" * 300_000, "hot", "s", 1)]
    rows += [document(i, lang="hot", text="ABC") for i in range(1000, 1090)]
    found = got(merkle.verified(spark.createDataFrame(rows, SCHEMA).repartition(7)))
    assert found == by_hand(rows)
    assert any(r[-1] for r in found) and not all(r[-1] for r in found)


def test_tampered_leaves_fail_and_texts_without_capitals_do_not(spark):
    rows = [document(i, text="lower {}" if i % 2 else "Upper {}") for i in range(40)]
    for r in merkle.verified(spark.createDataFrame(rows, SCHEMA)).collect():
        assert r.verified == (r.doc_id % 2 == 1 or zlib.crc32(str(r.doc_id).encode()) % 3 != 0)


def test_empty_table_and_clashing_columns(spark):
    assert merkle.verified(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [document(i) for i in range(12)]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA + ", lo int, leaf string, grp string")
    assert got(merkle.verified(df)) == by_hand(rows)


def test_the_manifest_keeps_intervals_and_paths(spark):
    """A node's children cover its interval without gaps, and a path has one step a level."""
    ranks = merkle.ranked(merkle.leaves(spark.createDataFrame([document(i) for i in range(100)], SCHEMA)), ["doc_id", "leaf"], "t")
    levels = merkle.build(ranks, "leaf", "t")
    assert [level.count() for level in levels] == [13, 2, 1]
    for level in levels:
        for node in level.collect():
            edges = [(c.lo, c.hi) for c in node.children]
            assert edges[0][0] == node.lo and edges[-1][1] == node.hi and all(a[1] == b[0] for a, b in zip(edges, edges[1:], strict=False))
    assert {len(r.path) for r in merkle.paths(ranks, levels).collect()} == {3}
