"""Text functions that Spark has no built-in for, as Arrow-batched UDFs.  Apply
them to distinct values and join back where values repeat."""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType

CHUNK_CHARS = 1000 * 4
OVERLAP_CHARS = 120 * 4


def _plain(text: str) -> str:
    """Compatibility form without combining marks, lower case."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def title_key(text: str | None) -> str:
    return re.sub("[^a-z0-9]+", " ", _plain(text or "")).strip()


def institution_key(text: str | None) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in _plain(text or "")).split())


def chunk_text(text: Column, target: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> Column:
    """Chunks of a text as a fold over its lines, all in the JVM.

    A line that would make the open chunk longer than ``target`` closes it, even
    an empty one; the next chunk begins with the ``overlap`` characters that
    ended it.  Lines are without white space around them, blank ones don't count."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+\z", ""))
    lines = F.filter(lines, lambda x: x != "")
    begin = F.struct(F.array().cast("array<string>").alias("closed"), F.lit("").alias("open"))

    def step(state: Column, line: Column) -> Column:
        closed, held = state["closed"], state["open"]
        closes = F.length(held) + F.length(line) > target
        before = F.when(closes, F.concat(F.right(held, F.lit(overlap)), F.lit("\n"))).when(held != "", F.concat(held, F.lit("\n"))).otherwise("")
        return F.struct(F.when(closes, F.array_append(closed, held)).otherwise(closed).alias("closed"), F.concat(before, line).alias("open"))

    rest = lambda state: F.when(state["open"] != "", F.array_append(state["closed"], state["open"])).otherwise(state["closed"])
    return F.aggregate(lines, begin, step, rest)


@pandas_udf(StringType())
def normalize_title(s: pd.Series) -> pd.Series:
    return s.map(title_key)


@pandas_udf(StringType())
def normalize_institution(s: pd.Series) -> pd.Series:
    return s.map(institution_key)


@pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block ratio of two strings, to 3 places."""
    return pd.Series([round(difflib.SequenceMatcher(None, x or "", y or "").ratio(), 3) for x, y in zip(a, b)])


def on_distinct(df: DataFrame, value: str, udf: Callable[[Column], Column], name: str) -> DataFrame:
    """``df`` with ``name`` = udf(value), evaluated once for each value."""
    seen = df.select(F.col(value).alias("_value")).distinct().withColumn(name, udf(F.col("_value")))
    return df.join(seen, F.col(value).eqNullSafe(F.col("_value")), "left").drop("_value")
