"""Rows out of JSON and XML payloads, driven by a map from canonical columns to paths."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import plain_text
from ..operators.tables import staged

#: Payloads that fail alone are remembered up to so many a source and task.
MOST_KNOWN = 10_000


def flatten_json(df: DataFrame, payload: str, schema: str, fields: Mapping[str, str], where: Column | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """A row for each record of a payload (an object or an array of objects) with the fields' columns as strings, blanks where missing."""
    many = schema.strip().lower().startswith("array")
    parsed = df.withColumn("record__", F.explode_outer(F.from_json(payload, schema)) if many else F.from_json(payload, schema))
    if where is not None:
        parsed = parsed.where(where)
    kept = [c for c in (keep if keep is not None else df.columns) if c != payload and c not in fields]
    return parsed.select(*kept, *[F.coalesce(F.col(f"record__.{path}").cast("string"), F.lit("")).alias(name) for name, path in fields.items()])


def read_xml(spark: SparkSession, path: str, row_tag: str, fields: Mapping[str, str], schema: str) -> DataFrame:
    """Records of XML files; markup that fields hold as text is taken off."""
    df = spark.read.format("xml").options(rowTag=row_tag).schema(schema).load(path)
    return df.select(*[plain_text(F.coalesce(F.col(p).cast("string"), F.lit(""))).alias(n) for n, p in fields.items()])


def by_source(df: DataFrame, parsers: Mapping[str, Callable[[pd.DataFrame], pd.DataFrame]], columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows by each source's own parser; what a parser can't read goes to a second table with the reason.

    df has source and payload. Parsers turn a frame of a source's rows into a frame with the columns (missing ones are blank). They get all of a
    source's rows in a batch at once; where that fails, halves of them, down to the row that fails alone. A payload that failed alone fails wherever it comes
    again in the partition, without another try. Sources without a parser fail as they are.
    """
    names = list(columns)

    def parsed(source: str, rows: pd.DataFrame) -> pd.DataFrame:
        out = parsers[source](rows).reindex(columns=names).fillna("").astype(str).astype(object)
        out.insert(0, "error", None)
        return out

    def failed(errors: Sequence[str]) -> pd.DataFrame:
        return pd.DataFrame({"error": list(errors), **{c: "" for c in names}}, dtype=object)

    def read(source: str, rows: pd.DataFrame, known: dict[str, str]) -> Iterator[pd.DataFrame]:
        """The rows' results; known: payloads that fail alone, with the reason."""
        parts = [rows]
        while parts:
            part = parts.pop()
            if known:
                bad = part.payload.isin(known)
                if bad.any():
                    yield failed([known[x] for x in part.payload[bad]])
                    part = part[~bad]
            if part.empty:
                continue
            try:
                yield parsed(source, part.reset_index(drop=True))
            except Exception as e:
                if len(part) > 1:
                    parts += [part.iloc[len(part) // 2 :], part.iloc[: len(part) // 2]]
                    continue
                reason = f"{type(e).__name__}: {e}"
                if len(known) < MOST_KNOWN:
                    known[part.payload.iloc[0]] = reason
                yield failed([reason])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, dict[str, str]] = {}
        for part in parts:
            for source, rows in part.groupby("source", sort=False, dropna=False):
                if source in parsers:
                    found = pd.concat(list(read(source, rows, known.setdefault(source, {}))))
                else:
                    found = failed([f"KeyError: {source!r}"] * len(rows))
                found.insert(0, "source", source)
                yield found.astype(object)

    # Both tables come from one reading.
    result = staged(df.select("source", "payload").mapInPandas(run, ", ".join(f"`{c}` string" for c in ("source", "error", *names))), "parsed")
    return result.where("error is null").drop("error"), result.where("error is not null").select("source", "error")


def configured(df: DataFrame, config: DataFrame, key: str = "source") -> DataFrame:
    """Rows with the configuration of their source; rows of sources without one go."""
    return df.join(config, key, "inner")
