"""Token counts by a map-side two-tier lookup.

The first tier is a table of the lengths of frequent pre-tokens, learnt from a bounded sample and broadcast
(its size is the parameter `frequent`). What it lacks goes through a cache in each Python worker, whose misses the
sentencepiece library encodes. Nothing is shuffled: the only shuffle counts the sample's pre-tokens.

Pre-tokens: a run of spaces with the characters up to the next space. No piece of the model holds a space mark after
another character (checked when the model is loaded), so no merge crosses from one pre-token to the next and the
lengths add up to the length of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_in_small_batches

MARK = "▁"


@lru_cache(maxsize=2)
def model(path: str):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("a piece of this model crosses a word boundary; count whole texts with it instead")
    return sp


class Lengths(dict):
    """Pre-token (without its first space) to its number of tokens; emptied down to the first tier when full."""

    def __init__(self, path: str, frequent: dict[str, int], size: int):
        super().__init__(frequent)
        self.sp, self.frequent, self.size = model(path), frequent, size

    def __missing__(self, word: str) -> int:
        n = len(self.sp.encode_as_ids(word)) if word else 1  # the lone space mark
        if len(word) <= 64:
            if len(self) >= self.size:
                self.clear()
                self.update(self.frequent)
            self[word] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        words = text.replace(MARK, " ").split(" ")  # the model reads both as the space mark and puts one before the text
        if "" not in words:
            return sum(map(self.__getitem__, words))
        total, spaces = 0, 0
        for word in words[:-1]:
            if word:
                total += self[" " * spaces + word]
                spaces = 0
            else:
                spaces += 1
        return total + self[" " * spaces + words[-1]]


def frequent_lengths(docs: DataFrame, model_path: str, text_col: str, sample_docs: int, frequent: int) -> dict[str, int]:
    """The commonest pre-tokens of sample_docs documents with their lengths; it changes the speed, never a count."""
    words = docs.select(text_col).limit(sample_docs).select(F.explode(F.split(F.col(text_col), " ")).alias("w")).where("length(w) between 1 and 64")
    rows = words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(frequent).collect()
    sp = model(model_path)
    return {r.w: len(sp.encode_as_ids(r.w)) for r in rows if MARK not in r.w}


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, sample_docs: int = 500, frequent: int = 20_000, cache_size: int = 200_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text, and whether the tokens exceed the limit.

    Out: id_col, n_bytes long, n_tokens long, over_limit boolean. A null text counts as empty: 0 bytes, 0 tokens. One row
    out for each row in, repeated or not; other columns are left out.
    """
    texts_in_small_batches(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, model_path, text_col, sample_docs, frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(model_path, table.value, cache_size)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                counts = [lengths.count(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    return read.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("id", id_col)
