"""Retrieval: merge of the variants' candidates, threshold, capped pick, coverage, source pack."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.config import RetrieveConfig
from quern.functions import kernels
from quern.functions import text as T


def usable_variants(variants: Column, query: Column) -> Column:
    """Non-blank query variants; the query itself where none is."""
    kept = F.filter(variants, lambda v: T.strip(v) != "")
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(query))


def flattened(results: DataFrame) -> DataFrame:
    """Rows of parallel result lists (ids, distances, documents by variant): (query_id, query_index, rank, chunk_id, distance, document). Missing inner lists give no rows."""
    outer = results.select("query_id", F.posexplode(F.arrays_zip("ids", "distances", "documents")).alias("query_index", "r"))
    inner = outer.select("query_id", "query_index", F.posexplode(F.arrays_zip(F.col("r.ids").alias("i"), F.col("r.distances").alias("d"), F.col("r.documents").alias("t"))).alias("rank", "x"))
    return inner.select("query_id", "query_index", (F.col("rank") + 1).alias("rank"), F.col("x.i").alias("chunk_id"), F.col("x.d").alias("distance"), F.col("x.t").alias("document"))


def merged(candidates: DataFrame, query: str = "query_id") -> DataFrame:
    """One row for each query and chunk: the smallest distance (the first of equal ones) with its variant, and the variants that met it, in order.

    ``candidates``: query, query_index, rank, matched_query, chunk_id, distance. At most variants times raw k rows for each query.
    """
    first = F.struct("distance", "query_index", "rank")
    seen = F.sort_array(F.collect_list(F.struct("query_index", "rank", "matched_query")))
    out = candidates.groupBy(query, "chunk_id").agg(
        F.min("distance").alias("distance"), F.min_by("matched_query", first).alias("matched_query"), F.min_by("query_index", first).alias("matched_query_index"), seen.alias("_seen")
    )
    order = F.col("_seen")[0]
    return out.select(query, "chunk_id", "distance", "matched_query", "matched_query_index", F.array_distinct(F.transform("_seen", lambda s: s["matched_query"])).alias("matched_queries"), order["query_index"].alias("first_index"), order["rank"].alias("first_rank"))


def relevant(candidates: DataFrame, config: RetrieveConfig = RetrieveConfig()) -> DataFrame:
    return candidates.where(F.col("distance") <= config.min_relevance_distance)


_PICK_IN = ("chunk_id", "doc_id", "podcast_slug", "title_key", "content_hash")


def picked(candidates: DataFrame, query: str = "query_id", config: RetrieveConfig = RetrieveConfig()) -> DataFrame:
    """Candidates of the capped greedy pick with their ``rank`` from 1.

    ``candidates``: query, chunk_id, distance, first_index, first_rank, doc_id, podcast_slug, title, chunk_content_hash, ... Each query's are
    ranked by distance, then in the order in which they were first met; caps see empty keys as uncapped. One query has at most variants times raw k.
    """
    keyed = candidates.select(
        query, "chunk_id", "distance", "first_index", "first_rank", F.coalesce("doc_id", F.lit("")).alias("doc_id"), F.coalesce("podcast_slug", F.lit("")).alias("podcast_slug"),
        T.title_key(F.col("title")).alias("title_key"), F.coalesce("chunk_content_hash", F.lit("")).alias("content_hash"),
    )
    listed = keyed.groupBy(query).agg(F.sort_array(F.collect_list(F.struct("distance", "first_index", "first_rank", *_PICK_IN))).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rows in batch.column(1).to_pylist():
                chosen = kernels.greedy_pick(rows, config.final_top_k, config.max_chunks_per_doc, config.max_chunks_per_podcast, config.max_chunks_per_title)
                out.append([{"rank": i + 1, "chunk_id": r["chunk_id"]} for i, r in enumerate(chosen)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.struct([("rank", pa.int32()), ("chunk_id", pa.string())])))], [query, "picked"])

    kind = candidates.schema[query].dataType.simpleString()
    chosen = listed.mapInArrow(run, f"`{query}` {kind}, picked array<struct<rank:int,chunk_id:string>>").select(query, F.inline("picked"))
    return chosen.join(candidates.drop("rank"), [query, "chunk_id"])


def coverage(selected: DataFrame, queries: DataFrame, query: str = "query_id", config: RetrieveConfig = RetrieveConfig()) -> DataFrame:
    """(query, coverage_status, usable_source_count, strong_source_count) of every query, those without sources included."""
    counts = selected.groupBy(query).agg(F.count("*").alias("u"), F.count_if(F.col("distance") <= config.weak_relevance_distance).alias("s"))
    both = queries.select(query).distinct().join(counts, query, "left")
    usable, strong = F.coalesce("u", F.lit(0)), F.coalesce("s", F.lit(0))
    status = F.when(usable == 0, "none").when(usable < config.min_sources_required, "weak").when(strong >= config.min_sources_required, "strong").otherwise("medium")
    return both.select(query, status.alias("coverage_status"), usable.alias("usable_source_count"), strong.alias("strong_source_count"))


def listing(sources: Column, preview: int = RetrieveConfig.preview_chars) -> Column:
    """Lines that show a pack's sources: for each its rank and distance, identity, times, number of variants that met it and the beginning of its text."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    fields = ("chunk_id", "title", "podcast_slug", "url")

    def entry(s: Column) -> Column:
        return F.concat(
            F.array(F.format_string("[%d] distance=%.4f", s["rank"], s["distance"])), F.array(*[F.concat(F.lit(f"{c}: "), text(s[c])) for c in fields]),
            F.array(F.concat(F.lit("timestamp: "), text(s["start_timestamp"]), F.lit(" - "), text(s["end_timestamp"])), F.format_string("matched_queries: %d", F.size(s["matched_queries"])), F.concat(F.lit("preview: "), T.preview(text(s["text"]), preview))),
        )

    return F.flatten(F.transform(sources, entry))


def source_packs(queries: DataFrame, selected: DataFrame, chunks: DataFrame, query: str = "query_id", config: RetrieveConfig = RetrieveConfig()) -> DataFrame:
    """One nested row for each query: all columns of ``queries`` (such as user_query and query_rewrite), the parameters, its coverage and its sources in order of rank; missing metadata is ''."""
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    meta = chunks.select("chunk_id", text("doc_id"), text("title"), text("podcast_slug"), text("url"), text("start_timestamp"), text("end_timestamp"), "chunk_index", "char_count", text("text"))
    mine = selected.select(query, "rank", "distance", "chunk_id", "matched_queries").join(meta, "chunk_id")
    source = F.struct("rank", "distance", "chunk_id", "doc_id", "title", "podcast_slug", "url", "start_timestamp", "end_timestamp", "chunk_index", "char_count", "matched_queries", "text")
    packs = mine.groupBy(query).agg(F.sort_array(F.collect_list(source)).alias("sources"))
    covered = coverage(selected, queries, query, config)
    params = F.struct(*[F.lit(getattr(config, n)).alias(n) for n in ("raw_top_k_per_query", "final_top_k", "max_chunks_per_doc", "max_chunks_per_podcast", "max_chunks_per_title", "min_relevance_distance")])
    out = queries.join(covered, query).join(packs, query, "left").withColumn("retrieval_params", params)
    empty = F.array().cast(packs.schema["sources"].dataType)
    return out.withColumn("coverage", F.struct("coverage_status", "usable_source_count", "strong_source_count")).withColumn("sources", F.coalesce("sources", empty)).drop("coverage_status", "usable_source_count", "strong_source_count")
