"""Incremental ingestion as a stream: new JSON lines are cleaned and added once, by address."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.config import CleanConfig
from quern.operators import clean
from quern.sources import sinks


def arriving(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1_000) -> DataFrame:
    """A stream of the JSON lines of files that come into the folders below ``folder``."""
    read = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").json(folder)
    return read.withColumn("_file", F.col("_metadata.file_path")).withColumn("_block", F.col("_metadata.file_block_start"))


def ingest(stream: DataFrame, table: str, checkpoint: str, key: str = "url", config: CleanConfig = CleanConfig()) -> StreamingQuery:
    """Clean what arrives and append, for each key, the first row (by file and place in it) that the table did not hold. Rows with a null key are left out; it ends when all is read.

    A batch that is run again after a failure finds its own rows in the table and adds none twice.
    """

    def add(batch: DataFrame, _: int) -> None:
        at = [c for c in ("_file", "_block") if c in batch.columns]
        placed = batch.withColumn("_at", F.monotonically_increasing_id())
        ready = clean.cleaned(placed.where(F.col(key).isNotNull()), config=config).where(F.length("cleaned_text") >= config.min_chars)
        first = sinks.first_rows(ready, key, [F.col(c) for c in (*at, "_at")])
        sinks.append_new(first.drop(*at, "_at"), table, key)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
