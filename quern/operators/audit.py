"""Audit of a collection: counts, duplicates, empty partitions and length extremes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts_by(docs: DataFrame, key: str, order: str) -> DataFrame:
    """(key, n) by falling count; keys of equal counts in the order in which they first come."""
    return docs.groupBy(key).agg(F.count("*").alias("n"), F.min(order).alias("_first")).orderBy(F.desc("n"), "_first").select(key, "n")


def duplicates(docs: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n): values that several rows share, in one pass over all columns; null and empty values do not count."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return docs.select(F.inline(pairs)).where("value <> ''").groupBy("column", "value").agg(F.count("*").alias("n")).where("n > 1")


def empty_partitions(expected: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """Keys that have no document."""
    return expected.select(key).distinct().join(docs.select(key), key, "left_anti")


def summary(docs: DataFrame, chars: Column) -> DataFrame:
    """One row: documents and their shortest, longest and mean length (null of an empty table)."""
    return docs.agg(F.count("*").alias("documents"), F.min(chars).alias("min_chars"), F.max(chars).alias("max_chars"), F.avg(chars).alias("avg_chars"))


def shortest(docs: DataFrame, chars: str, order: list[str], n: int = 200) -> DataFrame:
    """The n shortest rows, ties earliest first."""
    return docs.orderBy(chars, *order).limit(n)


def longest(docs: DataFrame, chars: str, order: list[str], n: int = 200) -> DataFrame:
    """The n longest rows, longest first, ties latest first."""
    return docs.orderBy(F.desc(chars), *[F.desc(c) for c in order]).limit(n)


def by_file(docs: DataFrame, chars: Column, file: str = "source_file") -> DataFrame:
    """(file, documents, chars): what each file holds."""
    return docs.groupBy(file).agg(F.count("*").alias("documents"), F.sum(chars).alias("chars"))


def roll_up(files: DataFrame, expected: DataFrame | None = None, file: str = "source_file") -> DataFrame:
    """One row over the counts of ``by_file``: files, files that hold any document, documents, and mean characters (0 where there is none). ``expected``: all files, those without rows too."""
    every = files if expected is None else expected.select(file).distinct().join(files, file, "left")
    n, total = F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("chars"), F.lit(0))
    return every.agg(F.count("*").alias("podcast_files"), F.count_if(F.col("documents") > 0).alias("nonempty_podcast_files"), n.alias("documents"), F.when(n > 0, total / n).otherwise(0.0).alias("avg_chars"))


def validated(docs: DataFrame, chars: Column, order: list[str]) -> DataFrame:
    """One row: documents, their shortest, longest and mean length, and title, address and first 300 characters of the first. An empty table gives zero documents and nulls."""
    first = F.min_by(F.struct("title", "url", F.substring("clean_text", 1, 300).alias("text_preview")), F.struct(*order))
    return docs.agg(F.count("*").alias("documents"), F.min(chars).alias("min_chars"), F.max(chars).alias("max_chars"), F.avg(chars).alias("avg_chars"), first.alias("sample"))
