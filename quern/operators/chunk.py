"""Chunking of documents: time blocks, long-text splitting, greedy packing with overlap, identities and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.config import ChunkConfig
from quern.functions import kernels
from quern.functions import text as T

TEXT_COLUMNS = ("clean_text", "text_clean", "cleaned_text", "text", "content", "transcript")


def present(df: DataFrame, names: tuple[str, ...]) -> list[Column]:
    return [F.col(n) for n in names if n in df.columns]


def first_text(df: DataFrame, names: tuple[str, ...] = TEXT_COLUMNS) -> Column:
    """The first of the columns that is a non-blank string, stripped; '' where none is."""
    return F.coalesce(*[F.nullif(T.strip(c.cast("string")), F.lit("")) for c in present(df, names)], F.lit(""))


def first_true(df: DataFrame, names: tuple[str, ...]) -> Column:
    """The first of the columns that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in present(df, names)], F.lit(None).cast("string"))


def blocks(text: Column) -> tuple[Column, Column]:
    """(blocks before splitting, timestamp-aware) of a text: see ``kernels.time_blocks``. One Arrow pass, no shuffle."""
    found = kernels.blocks_udf(text)
    return found["blocks"], found["aware"]


def chunked(docs: DataFrame, config: ChunkConfig = ChunkConfig(), provider: str = "quern", source_type: str = "podcast_transcript", slug: Column | None = None, source_file: Column | None = None) -> DataFrame:
    """Documents with ``chunks`` (array), ``timestamp_aware`` and ``skip_reason`` (missing_text, no_blocks_after_split, no_chunks_after_chunking, null).

    Text, id, title and address are taken from the first of their usual columns that holds one; a missing id is made from slug, title, address and file.
    """
    own = docs.withColumn("_text", first_text(docs))
    own = own.withColumn("_found", kernels.chunks_udf(config.target_chars, config.max_chars, config.min_chunk_chars, config.overlap_blocks)(F.col("_text")))
    own = own.withColumn("timestamp_aware", F.col("_found.aware"))
    reason = F.when(F.col("_text") == "", "missing_text").when(F.col("_found.blocks") == 0, "no_blocks_after_split").when(F.size("_found.chunks") == 0, "no_chunks_after_chunking")
    slug = first_true(docs, ("podcast_slug", "show_slug", "series_slug")) if slug is None else slug
    file = F.lit("") if source_file is None else source_file
    title, url = first_true(docs, ("title", "episode_title", "name")), first_true(docs, ("url", "source_url"))
    seed = F.concat_ws("|", F.coalesce(slug, F.lit("None")), F.coalesce(title, F.lit("None")), F.coalesce(url, F.lit("None")), file)
    ident = F.coalesce(first_true(docs, ("doc_id", "id")), F.concat(F.lit("doc_"), T.short_hash(seed)))
    own = own.withColumn("_id", ident).withColumn("_title", title).withColumn("_url", url).withColumn("_slug", slug).withColumn("_file", file)

    def record(c: Column, i: Column) -> Column:
        return F.struct(
            chunk_id(F.col("_id"), i).alias("chunk_id"), F.col("_id").alias("doc_id"), i.cast("bigint").alias("chunk_index"), F.lit(provider).alias("provider"),
            F.lit(source_type).alias("source_type"), F.col("_slug").alias("podcast_slug"), F.col("_title").alias("title"), F.col("_url").alias("url"), c["start_timestamp"].alias("start_timestamp"),
            c["end_timestamp"].alias("end_timestamp"), c["char_count"].alias("char_count"), c["block_count"].alias("block_count"), c["text"].alias("text"), F.col("_file").alias("source_file"),
            F.col("timestamp_aware").alias("timestamp_aware"), T.chunk_hash(c["text"]).alias("chunk_content_hash"),
        )

    out = own.withColumn("chunks", F.transform("_found.chunks", record)).withColumn("skip_reason", reason)
    return out.drop("_text", "_found", "_id", "_title", "_url", "_slug", "_file")


def records(docs: DataFrame) -> DataFrame:
    """One row for each chunk."""
    return docs.select(F.inline("chunks"))


def repeated_hashes(chunks: DataFrame) -> DataFrame:
    """(chunk_content_hash, n) of hashes that several chunks share."""
    return chunks.groupBy("chunk_content_hash").agg(F.count("*").alias("n")).where("n > 1")


def statistics(docs: DataFrame) -> DataFrame:
    """One row: documents, skips, chunks, and minimum, maximum, mean and median of characters per chunk and chunks per document that has any. One pass over the chunks."""
    sizes = F.transform("chunks", lambda c: c["char_count"])
    each = docs.select(F.col("skip_reason").isNull().alias("ok"), "timestamp_aware", F.size("chunks").alias("n"), F.posexplode_outer(sizes).alias("at", "chars")).withColumn("first", F.coalesce("at", F.lit(0)) == 0)
    first, ok, aware = F.col("first"), F.col("first") & F.col("ok"), F.col("timestamp_aware")
    return each.agg(
        F.count_if(first).alias("documents_seen"), F.count_if(ok).alias("documents_written"), F.count_if(first & ~F.col("ok")).alias("documents_skipped"),
        F.count_if(ok & aware).alias("timestamp_aware_docs"), F.count_if(ok & ~aware).alias("non_timestamp_docs"), *spread(F.when(ok, F.col("n")), "chunks_per_doc"),
        F.count("chars").alias("chunks_written"), *spread(F.col("chars"), "chunk_chars"),
    )


def skip_reasons(docs: DataFrame) -> DataFrame:
    """(skip_reason, n) of the documents without chunks."""
    return docs.where("skip_reason is not null").groupBy("skip_reason").agg(F.count("*").alias("n"))


def chunk_id(doc_id: Column, index: Column) -> Column:
    return F.format_string("%s::chunk_%04d", doc_id, index)


def spread(x: Column, name: str) -> list[Column]:
    """Minimum, maximum, mean and median."""
    return [F.min(x).cast("bigint").alias(f"{name}_min"), F.max(x).cast("bigint").alias(f"{name}_max"), F.avg(x).alias(f"{name}_avg"), F.median(x).alias(f"{name}_median")]
