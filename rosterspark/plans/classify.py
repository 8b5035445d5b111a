"""Classification by responses that arrive as a table, and verdicts on rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import plausible_link

FIELDS = ("Computer Science", "Mathematics or Statistics", "Other", "Unknown", "Invalid")


def prompt(text: Column, question: str, least: int = 100, most: int = 12_000) -> Column:
    """The question with the text's beginning; null for texts too short to tell (the limit is what a classifier reads)."""
    return F.when(F.length(text) >= least, F.concat(F.lit(question + "\n\n"), F.substring(text, 1, most)))


def score(df: DataFrame, prompt_col: str, scorer: Callable[[pd.Series], pd.Series], name: str = "raw") -> DataFrame:
    """Responses of a scorer that takes and gives a pandas Series of strings."""
    return df.withColumn(name, F.pandas_udf(scorer, "string")(prompt_col))


def parse(df: DataFrame, raw: str, taxonomy: Sequence[str], most: int = 5, fields: Sequence[str] = FIELDS) -> DataFrame:
    """field and subfields ("|" list) of JSON responses: names of the taxonomy in any case, each once, at most `most`; only computer science has any.

    Invalid JSON and unknown fields give a blank field.
    """
    canon = lambda names: F.create_map(*[F.lit(x) for n in names for x in (n.lower(), n)])
    r = F.from_json(raw, "struct<field:string,subfields:array<string>>")
    field = F.coalesce(F.element_at(canon(fields), F.lower(F.trim(r["field"]))), F.lit(""))
    found = F.array_distinct(F.filter(F.transform(r["subfields"], lambda s: F.element_at(canon(taxonomy), F.lower(F.trim(s)))), lambda x: x.isNotNull()))
    return df.withColumn("field", field).withColumn("subfields", F.when(F.col("field") == "Computer Science", F.array_join(F.slice(found, 1, most), "|")))


def cascade(first: Column, second: Column, had_text: Column) -> Column:
    """The first source's label, else the second's, else whether there was anything to read."""
    return F.coalesce(first, second, F.when(had_text, "no_signal").otherwise("no_data"))


def drop_rejected(df: DataFrame, verdicts: DataFrame, key: str, name: str = "name", url: str = "url") -> DataFrame:
    """Rows whose verdict is false go, unless their link is plausible for the name; rows without a verdict stay."""
    joined = df.join(verdicts.select(key, F.col("verdict").alias("verdict__")), key, "left")
    return joined.where(F.coalesce("verdict__", F.lit(True)) | F.coalesce(plausible_link(F.col(url), F.col(name)), F.lit(False))).drop("verdict__")
