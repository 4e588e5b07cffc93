"""Line-delimited JSON: lenient, strict, dropping and resuming scans, discovery by folder, line numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

CORRUPT = "_corrupt"


def strict(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Every line must be an object; the first broken one fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def dropping(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Broken lines are left out without notice."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(paths)


def lenient(spark: SparkSession, paths: str | list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """(documents, problems): broken lines are reported as (source_file, line), blank ones skipped."""
    wide = Ty._parse_datatype_string(schema).add(CORRUPT, "string")
    read = spark.read.text(paths).select(F.col("_metadata.file_path").alias("source_file"), "value").where(F.trim("value") != "")
    rows = read.withColumn("_doc", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    broken = F.col(f"_doc.{CORRUPT}").isNotNull()
    names = [f"_doc.`{f.name}`" for f in wide.fields if f.name != CORRUPT]
    return rows.where(~broken).select(*names, "source_file"), rows.where(broken).select("source_file", F.col("value").alias("line"))


def numbered(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Documents with ``source_file`` and ``line_no``, the physical line from 1, blank lines counted; ``broken`` marks lines that are no object (their fields are null), ``_line`` is the line.

    Files are split as any text file is: lines are numbered within each split and moved on by the lines of the splits before, so that no file is one task.
    """
    read = lambda: spark.read.text(paths).select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_block"), "value")
    before = Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = read().groupBy("source_file", "_block").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("source_file", "_block").orderBy("_at"))
    lines = read().withColumn("_at", F.monotonically_increasing_id()).withColumn("_in", within).join(splits, ["source_file", "_block"])
    wide = Ty._parse_datatype_string(schema).add(CORRUPT, "string")
    parsed = lines.where(~F.col("value").rlike(r"^\s*$")).withColumn("_doc", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    names = [f.name for f in wide.fields if f.name != CORRUPT]
    return parsed.select("source_file", (F.col("_before") + F.col("_in")).cast("bigint").alias("line_no"), F.col("value").alias("_line"), F.col(f"_doc.{CORRUPT}").isNotNull().alias("broken"), *[F.col(f"_doc.`{n}`").alias(n) for n in names])


def slug_of(file: Column) -> Column:
    """The folder a file lies in."""
    return F.regexp_extract(file, r"([^/]+)/[^/]+$", 1)


def partitioned(spark: SparkSession, folder: str, schema: str, name: str = "source_documents.jsonl", skip: tuple[str, ...] = ("catalog",), max_files: int | None = None) -> DataFrame:
    """``folder``/*/``name``: documents with source_file and podcast_slug (the folder), without the folders ``skip``; the first ``max_files`` by path."""
    rows = spark.read.schema(schema).json(f"{folder}/*/{name}").withColumn("source_file", F.col("_metadata.file_path"))
    rows = rows.withColumn("podcast_slug", slug_of(F.col("source_file"))).where(~F.col("podcast_slug").isin(*skip))
    if max_files is None:
        return rows
    first = rows.select("source_file").distinct().orderBy("source_file").limit(max_files)
    return rows.join(first, "source_file", "left_semi")


def recursive(spark: SparkSession, folder: str, schema: str, name: str = "source_documents_clean.jsonl", max_files: int | None = None) -> DataFrame:
    """All files of a name at any depth, strictly: a broken line fails the read; the first ``max_files`` by path."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").option("recursiveFileLookup", "true").option("pathGlobFilter", name).json(folder)
    rows = rows.withColumn("source_file", F.col("_metadata.file_path"))
    if max_files is None:
        return rows
    return rows.join(rows.select("source_file").distinct().orderBy("source_file").limit(max_files), "source_file", "left_semi")


def slug_below(file: Column, root: str) -> Column:
    """The top folder below ``root`` in which a file lies, null where it lies in none; of ``name=value`` folders the value."""
    rest = F.regexp_extract(F.regexp_replace(file, "^[a-z][a-z0-9+.-]*:/*", "/"), "^" + re.escape("/" + re.sub("^[a-z][a-z0-9+.-]*:/*", "", root).strip("/")) + "/+([^/]+)/", 1)
    return F.nullif(F.regexp_replace(rest, "^[^=]+=", ""), F.lit(""))


def document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One JSON document over many lines."""
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema else reader).json(path)
