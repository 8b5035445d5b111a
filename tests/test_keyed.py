"""Keyed tables that streams fill: what a batch touches, what a crash leaves, how many files remain."""

import os

import pytest

from rosterspark.streaming import keyed

SCHEMA = "k int, v string, n int, day string"


def files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows(spark, path):
    return sorted((r.k, r.v, r.n, r.day) for r in spark.read.schema(SCHEMA).parquet(path).collect())


def put(spark, path, batch, data, **how):
    keyed.rewrite(spark.createDataFrame(data, SCHEMA), path, batch, ["day"], ["k"], keyed.latest(["k"], "n", **how))


def test_batches_merge_by_key_and_leave_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, 0, [(1, "a", 1, "d1"), (2, "b", 1, "d2"), (1, "older", 0, "d1")])
    before = files(path)
    put(spark, path, 1, [(1, "c", 2, "d1"), (3, "d", 1, "d1")])
    put(spark, path, 2, [(1, "late", 1, "d1"), (3, "d", 1, "d1")])
    assert rows(spark, path) == [(1, "c", 2, "d1"), (2, "b", 1, "d2"), (3, "d", 1, "d1")]
    after = files(path)
    assert len(after) == 2 and [f for f in after if "d2" in f] == [f for f in before if "d2" in f]
    put(spark, path, 3, [])
    assert files(path) == after


def test_first_wins_and_nulls(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, 0, [(1, "a", 5, "d1"), (None, "x", 1, None)], last=False)
    put(spark, path, 1, [(1, "b", 6, "d1"), (None, "y", 2, None), (2, None, None, "d1")], last=False)
    assert sorted(map(str, [tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).collect()])) == sorted(map(str, [(1, "a", 5, "d1"), (None, "x", 1, None), (2, None, None, "d1")]))


def test_many_batches_leave_as_many_files_as_days(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(12):
        put(spark, path, batch, [(batch, "v", 1, f"d{batch % 3}"), (0, "again", batch, "d0")])
    assert len(files(path)) == 3 and len(rows(spark, path)) == 12


def test_a_batch_that_broke_off_runs_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    put(spark, path, 0, [(1, "a", 1, "d1"), (2, "b", 1, "d1")])
    # The batch is written beside the table, then the table loses its partition and the run ends.
    with monkeypatch.context() as m:
        m.setattr(keyed, "remove", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            put(spark, path, 1, [(1, "c", 2, "d1")])
    for f in files(path):
        os.remove(os.path.join(path, f))
    put(spark, path, 1, [(1, "c", 2, "d1")])
    assert rows(spark, path) == [(1, "c", 2, "d1"), (2, "b", 1, "d1")]
    assert not os.path.exists(f"{path}.pending/1")


def test_a_small_batch_of_results_rewrites_its_bucket_alone(spark, tmp_path):
    path = str(tmp_path / "state")
    state = spark.createDataFrame([(k, "manual_approved" if k % 5 == 0 else "rescrape" if k % 2 else "", None, f"name {k}") for k in range(200)], "k int, status string, result int, name string")
    keyed.write_state(state, path, ["k"], 8)
    before = files(path)
    bucket = {r.k: r.bucket for r in spark.range(200).selectExpr("cast(id as int) as k").select("k", keyed.bucket_of(["k"], 8)).collect()}
    some = [k for k in bucket if bucket[k] == 3][:10]
    arrived = spark.createDataFrame([(k, "matched", k * 10 + n) for k in some for n in range(2)], "k int, status string, result int")
    keyed.reprocess_batch(arrived, path, 0, ["k"], "status", ["result"], "result", 8)
    after = files(path)
    assert {f for f in after if after[f] != before.get(f)} == {f for f in after if "bucket=3" in f} and len([f for f in after if "bucket=3" in f]) == 1
    got = {r.k: r for r in spark.read.parquet(path).collect()}
    assert len(got) == 200
    for k in range(200):
        want = ("matched", k * 10 + 1) if k in some and k % 5 else ("manual_approved" if k % 5 == 0 else "rescrape" if k % 2 else "", None)
        assert (got[k].status, got[k].result, got[k]["name"]) == (*want, f"name {k}")
    # The same batch again, and results of rows that the table lacks, change nothing.
    keyed.reprocess_batch(arrived, path, 0, ["k"], "status", ["result"], "result", 8)
    keyed.reprocess_batch(spark.createDataFrame([(999, "matched", 1)], "k int, status string, result int"), path, 1, ["k"], "status", ["result"], "result", 8)
    assert {(r.k, r.status, r.result) for r in spark.read.parquet(path).collect()} == {(k, r.status, r.result) for k, r in got.items()}


def test_streams_fill_both(spark, tmp_path):
    src, path, cp = (str(tmp_path / n) for n in ("src", "t", "cp"))
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    for n in range(3):
        spark.createDataFrame([(1, f"v{n}", n, "d1"), (n + 10, "x", 0, "d2")], SCHEMA).coalesce(1).write.mode("append").parquet(src)
        for _ in range(2):
            keyed.merge_stream(stream(), path, cp, ["day"], ["k"], "n")
    assert rows(spark, path) == [(1, "v2", 2, "d1"), (10, "x", 0, "d2"), (11, "x", 0, "d2"), (12, "x", 0, "d2")]
