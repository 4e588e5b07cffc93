"""Writers: JSON lines, partitions by podcast, reports, write-once pages, the vector table, the latest result."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.storage import stored


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> int:
    """Write rows as JSON lines; their number is observed while they are written. Null fields are kept."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)
    return seen.get["rows"]


def write_partitions(df: DataFrame, path: str, by: str = "podcast_slug", format: str = "json", expected: DataFrame | None = None) -> None:
    """A folder for each value of ``by``; rewriting replaces the folders that have rows, and those of ``expected`` (column ``by``) that have none become empty: an empty file stands in each.

    Only the names of folders without rows reach the driver.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).format(format).save(path)
    if expected is None:
        return
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    names = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for row in expected.select(by).where(F.col(by).isNotNull()).distinct().join(df.select(by).distinct(), by, "left_anti").toLocalIterator():
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{names.getPartitionPathString(by, str(row[0]))}")
        fs = folder.getFileSystem(conf)
        fs.delete(folder, True)
        fs.mkdirs(folder)
        fs.create(jvm.org.apache.hadoop.fs.Path(folder, f"part-none.{format}")).close()


def write_report(df: DataFrame, path: str) -> None:
    """A small report (a single row or a top-k) as one JSON file."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def pretty(row: Column) -> Column:
    """A struct as JSON text over several lines, null fields and non-ASCII kept."""
    return F.to_json(row, {"pretty": "true", "ignoreNullFields": "false"})


def write_texts(rows: DataFrame, folder: str, name: str, *texts: str) -> int:
    """A file for each row and text column: ``name`` with the column's ending (``md`` -> .md, ``meta_json`` -> .meta.json), written by the tasks that hold the rows. Null texts give no file. Returns the number of files."""
    spark = rows.sparkSession
    base = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(base)
    uri = fs.makeQualified(base).toString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, root = pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))
        for b in batches:
            n = 0
            for row in b.to_pylist():
                for text in texts:
                    if row[text] is not None:
                        with out.open_output_stream(f"{root}/{row[name]}.{text.replace('_', '.')}") as f:
                            f.write(row[text].encode())
                        n += 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return rows.select(F.col(name).cast("string").alias(name), *texts).mapInArrow(run, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def first_rows(df: DataFrame, key: str, order: list[Column] | None = None) -> DataFrame:
    """One row for each ``key``: the first in ``order``. Null keys are one key. Found by an aggregate, so a hot key is no sort."""
    if order is None:
        return df.dropDuplicates([key])
    return df.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(*order)).alias("_row")).select("_row.*")


#: Most keys that are sent to the scan of a table that is appended to.
LOOKED_UP = 10_000


def append_new(df: DataFrame, path: str, key: str, order: list[Column] | None = None) -> DataFrame:
    """Append the rows whose key the Parquet table at ``path`` does not hold, of equal keys the first in ``order``; returns the table. The first write creates it.

    Of the table only keys are read, and for up to LOOKED_UP new keys only those of row groups whose Bloom filters may hold one. Rows with a null key are always new.
    """
    spark = df.sparkSession
    fresh = stored(first_rows(df, key, order), "fresh")
    if exists(spark, path):
        held, keys = spark.read.parquet(path).select(key), fresh.select(key).limit(LOOKED_UP + 1).collect()
        if len(keys) <= LOOKED_UP:
            held = held.where(F.col(key).isin([r[0] for r in keys if r[0] is not None]))
        fresh = fresh.join(held, key, "left_anti").select(*df.columns)
    fresh.write.mode("append").option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path)
    return spark.read.parquet(path)


def open_table(spark: SparkSession, path: str, schema: str, metric: str = "cosine") -> tuple[DataFrame, int]:
    """(rows, count) of a vector table; one that is missing is created empty. Its metric is kept with it, and opening it by another is an error."""
    note = f"{path}/_metric"
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)
        spark.createDataFrame([(metric,)], "value string").coalesce(1).write.mode("overwrite").text(note)
    elif exists(spark, note) and (held := spark.read.text(note).first()[0]) != metric:
        raise ValueError(f"the table {path} has the metric {held}, not {metric}")
    rows = spark.read.schema(schema).parquet(path)
    return rows, rows.count()


def keep_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Fetched pages (kind, slug, url, html) kept as they came, write-once: a page whose path the table holds is not written again. Returns the table (path, kind, slug, url, html)."""
    return append_new(pages.where("html is not null").select(raw_path(F.col("kind"), F.col("slug"), F.col("url")).alias("path"), "kind", "slug", "url", "html"), folder, "path", [F.col("url")])


def raw_path(kind: Column, slug: Column, url: Column) -> Column:
    """Where a raw page belongs, by its kind: catalogue pages and lists by number, episodes by slug, anything else by a hash of its address."""
    page = F.format_string("page_%03d.html", F.coalesce(T.page_number(url), F.lit(1)))
    return (
        F.when(kind == "catalog_page", F.concat(F.lit("catalog/"), page))
        .when(kind == "podcast_list_page", F.concat(slug, F.lit("/list_pages/"), page))
        .when(kind == "episode_page", F.concat(slug, F.lit("/episode_pages/"), T.slug_from_url(url), F.lit(".html")))
        .otherwise(F.concat(F.lit("misc/"), F.substring(T.sha256(url), 1, 16), F.lit(".html")))
    )


def reset(df: DataFrame, path: str) -> None:
    """Begin the table anew with these rows."""
    df.write.mode("overwrite").parquet(path)


def latest(runs: DataFrame, by: str = "run_ts") -> DataFrame:
    """The rows of the newest run."""
    newest = runs.agg(F.max(by).alias("_newest"))
    return runs.join(F.broadcast(newest), F.col(by) == F.col("_newest"), "left_semi")  # a single row
