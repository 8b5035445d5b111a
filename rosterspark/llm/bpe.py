"""Byte-level BPE encoding and decoding.

The tokenizers library encodes Arrow batches. Bytes are written as printable characters (the byte table of
byte-level BPE), so that every string can be encoded; decoding turns the characters of each token back into
bytes and joins the bytes of all tokens before any text is read from them, so characters that the vocabulary
splits over several tokens come back whole.

A vocabulary is a rank file (one base64 token and its rank a line). Merges are derived from the ranks on the
driver, once; what is broadcast is the vocabulary alone, a few MB whatever the input.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import texts_in_small_batches

#: In this pattern a space can only begin a match or stand in a run of white space.
SPACE_LED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_table() -> list[str]:
    """The character of each byte: itself if printable Latin-1, else the next code point from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of their rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def tokenizer_json(tokens: list[bytes], pattern: str) -> str:
    """A tokenizers-library file with this vocabulary, whose merges are those that the ranks imply."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    rank = {t: i for i, t in enumerate(tokens)}
    shown = byte_table()
    text = lambda t: "".join(shown[b] for b in t)
    merges = []
    for own, token in enumerate(tokens):
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: rank.get(parts[i] + parts[i + 1], own))
            if rank.get(parts[best] + parts[best + 1], own) >= own:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) == 2:
            merges.append((text(parts[0]), text(parts[1])))
    made = Tokenizer(models.BPE(vocab={text(t): i for i, t in enumerate(tokens)}, merges=merges))
    made.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made.to_str()


class Codec:
    """Encodes and decodes in one Python worker. Words seen before come from a cache that is emptied when full."""

    def __init__(self, spec: str, word_wise: bool, cache_size: int = 60_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        back = {c: b for b, c in enumerate(byte_table())}
        vocab = json.loads(spec)["model"]["vocab"]
        self.bytes_of = [b""] * len(vocab)
        for shown, i in vocab.items():
            self.bytes_of[i] = bytes(back[c] for c in shown)
        self.lengths = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.word_wise, self.cache_size = word_wise, cache_size
        self.cache: dict[str, bytes] = {}

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self.word_wise:
            for text in texts:
                yield self.ids_of([text])[0]
            return
        for text in texts:
            # Cut before a space that follows or precedes something else than white space: no match spans such a cut.
            words = text.split(" ") if not re.search(r"\s \s", text) else re.split(r" (?=\S)|(?<=\S) ", text)
            first, rest = words[0], words[1:]
            new = list({w for w in rest if w not in self.cache})
            if len(self.cache) + len(new) > self.cache_size:
                self.cache.clear()
                new = list(set(rest))
            self.cache.update(zip(new, self.ids_of([" " + w for w in new]), strict=True))
            yield b"".join([self.ids_of([first])[0], *map(self.cache.__getitem__, rest)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    def offsets(self, text: str, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Of each token, the first character it holds a byte of and the end after the last such character."""
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        char_at = np.cumsum((raw & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.lengths[np.frombuffer(ids, dtype="<u4")])
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        return (char_at[starts], char_at[ends - 1] + 1) if len(ends) else (ends, ends)


@lru_cache(maxsize=2)
def codec(spec: str, word_wise: bool) -> Codec:
    return Codec(spec, word_wise)


def _spec(spark: SparkSession, ranks_path: str, pattern: str):
    """The vocabulary, broadcast, and whether texts may be cut at spaces: no token may hold a space beside other white space."""
    texts_in_small_batches(spark)
    tokens = read_ranks(ranks_path)
    cut = pattern == SPACE_LED and not any(len(t) > 1 and b" " in t and t.isspace() for t in tokens)
    return spark.sparkContext.broadcast(tokenizer_json(tokens, pattern)), cut


def encode(docs: DataFrame, ranks_path: str, pattern: str = SPACE_LED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids with the character span of each token.

    Out: id_col, ids array<int>, starts array<int>, ends array<int>. A null or empty text has no tokens; repeated
    rows, null ids and other columns change nothing (one row out for each row in, other columns are left out).
    Spans of tokens that share a character overlap.
    """
    spec, word_wise = _spec(docs.sparkSession, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec.value, word_wise)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = list(own.encode(texts))
                spans = [own.offsets(t, i) for t, i in zip(texts, ids, strict=True)]
                lists = [pa.array([np.frombuffer(i, dtype="<u4").astype("i4") for i in ids], pa.list_(pa.int32())), *(pa.array([s[k].astype("i4") for s in spans], pa.list_(pa.int32())) for k in (0, 1))]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists], ["id", "ids", "starts", "ends"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>, starts array<int>, ends array<int>")
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The bytes and the text of each list of ids; a null list gives an empty text, bytes that are not UTF-8 read as U+FFFD.

    Out: id_col, raw binary, text string.
    """
    spec, word_wise = _spec(encoded.sparkSession, ranks_path, SPACE_LED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec.value, word_wise)
        for batch in batches:
            raw = [own.decode(np.array(i or [], dtype="<u4").tobytes()) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary()), pa.array([r.decode("utf-8", "replace") for r in raw], pa.string())], ["id", "raw", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind}, raw binary, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str = SPACE_LED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every text in one pass and keeps digests only, so no list of ids leaves its task.

    Out: id_col, n_tokens long, ids_sha256, decoded_sha256 (lowercase hex of the ids as little-endian unsigned
    32-bit integers and of the decoded bytes). A null text counts as empty. One row out for each row in, repeated or not; null ids stay
    null, other columns are left out.
    """
    spec, word_wise = _spec(docs.sparkSession, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec.value, word_wise)
        last, found = None, (0, "", "")
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                if text != last or not out:  # a text that is repeated in a row is encoded once
                    ids = next(own.encode([text or ""]))
                    last, found = text, (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest())
                out.append(found)
            counts, left, right = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(left, pa.string()), pa.array(right, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
