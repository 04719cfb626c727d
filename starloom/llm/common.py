"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of word characters; none for a missing text."""
    return WORD.findall(text.lower()) if text else []


def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first longer one that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_key(text: Column) -> Column:
    """Two independent 64-bit hashes of a text (missing: empty), to tell repeated ids apart."""
    whole = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(whole).alias("a"), F.xxhash64(F.lit("starloom"), whole).alias("b"))
