"""Whole stages, put together from operators: corpus building and answering a batch of requests."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quern import adapters
from quern.adapters import Embedder, Generator
from quern.config import ChunkConfig, CleanConfig, GenerateConfig, RetrieveConfig, RewriteConfig
from quern.functions import text as T
from quern.operators import chunk, clean, generate, index, retrieve, rewrite
from quern.sources import sinks
from quern.storage import stored


def build_chunks(docs: DataFrame, order: list[str], clean_config: CleanConfig = CleanConfig(), chunk_config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """Interim documents to chunk records."""
    ready = clean.rewritten(clean.decided(clean.cleaned(docs, config=clean_config), order, clean_config))
    return chunk.records(chunk.chunked(ready, chunk_config, slug=F.col("metadata.podcast_slug")))


def candidates(queries: DataFrame, vectors: DataFrame, config: RetrieveConfig = RetrieveConfig()) -> DataFrame:
    """Nearest vectors of every variant. ``queries``: query_id, query_index, matched_query, q_embedding; ``vectors``: chunk_id, embedding, metadata."""
    return index.nearest(queries, vectors, config.raw_top_k_per_query, ["query_id", "query_index", "matched_query"], "chunk_id")


def retrieve_batch(queries: DataFrame, vectors: DataFrame, chunks: DataFrame, config: RetrieveConfig = RetrieveConfig(), rewrites: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(picked sources, source packs) of a batch of requests.

    ``queries``: query_id, query_index, matched_query, q_embedding; ``vectors``: chunk_id, embedding; ``chunks``: chunk records with unique chunk_id;
    ``rewrites``: query_id, user_query, query_rewrite (by default a request is its first variant, not rewritten).
    """
    found = retrieve.relevant(retrieve.merged(candidates(queries, vectors, config)), config)
    meta = chunks.select("chunk_id", "doc_id", "podcast_slug", "title", "chunk_content_hash")
    picked = stored(retrieve.picked(found.join(meta, "chunk_id"), config=config), "picked")  # read for sources and for coverage
    if rewrites is None:
        asked = queries.groupBy("query_id").agg(F.min_by("matched_query", "query_index").alias("user_query"))
        rewrites = asked.withColumn("query_rewrite", rewrite.not_rewritten(F.col("user_query"), F.lit(None).cast("string")))
    return picked, retrieve.source_packs(rewrites, picked, chunks, config=config)


def completed(rows: DataFrame, messages: str, make: Callable[[], Generator], column: str = "answer") -> DataFrame:
    """``rows`` with a model's answer to their messages, and ``error``: a failed call is a value in its row."""
    schema = StructType([*rows.schema.fields, StructField(column, StringType()), StructField("error", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for b in batches:
            answers, errors = [], []
            for m in b.column(messages).to_pylist():
                try:
                    answers.append(model.complete(m))
                    errors.append(None)
                except Exception as e:  # one request's failure leaves the others alone
                    answers.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(answers, pa.string()), pa.array(errors, pa.string())], [*b.schema.names, column, "error"])

    return rows.mapInArrow(run, schema)


def rewrite_batch(requests: DataFrame, cache: DataFrame, make: Callable[[], Generator], provider: str, base_url: str, model: str, config: RewriteConfig = RewriteConfig()) -> tuple[DataFrame, DataFrame]:
    """(query, result) of every request and the new rows of the cache (cache_key, result): only successful rewrites that it did not hold.

    ``requests``: query; ``cache``: cache_key, result, at (the order of its rows). A disabled rewrite or a failed one gives the query itself.
    """
    asked = requests.select("query").distinct().withColumn("cache_key", rewrite.cache_key(F.col("query"), provider, base_url, model, config))
    kind = cache.schema["result"].dataType
    if not config.enabled:
        off = asked.select("query", rewrite.not_rewritten(F.col("query"), F.lit("rewrite_disabled")).cast(kind).alias("result"))
        return off, cache.limit(0).select("cache_key", "result")
    held = rewrite.cached(asked, cache, "at") if config.cache_enabled else asked.withColumn("result", F.lit(None).cast(kind))
    open_ = held.where("result is null").select("query", "cache_key", rewrite.prompt(F.col("query"), config.max_queries).alias("messages"))
    # Stored: the answers are read for the results and for the cache, and the model is asked once.
    new = stored(rewrite.parsed(completed(open_, "messages", make), provider=provider, model=model, config=config).select("query", "cache_key", F.col("result").cast(kind).alias("result")), "rewrites")
    done = held.where("result is not null").select("query", "result").unionByName(new.select("query", "result"))
    return done, new.where("result.rewrite_used").select("cache_key", "result")


def cache_table(spark, path: str) -> DataFrame:
    """The cache of rewrites (cache_key, result, at) in a folder; empty where there is none yet."""
    schema = f"cache_key string, result {rewrite.RESULT}, at timestamp"
    return spark.read.schema(schema).parquet(path) if sinks.exists(spark, path) else spark.createDataFrame([], schema)


def rewritten_requests(requests: DataFrame, make: Callable[[], Generator], provider: str = "", base_url: str = "", model: str = "", cache_path: str | None = None, config: RewriteConfig = RewriteConfig()) -> DataFrame:
    """(query_id, user_query, query_rewrite) of requests (query_id, query). Successful rewrites are appended to the cache in ``cache_path``."""
    spark = requests.sparkSession
    cache = cache_table(spark, cache_path) if cache_path else spark.createDataFrame([], f"cache_key string, result {rewrite.RESULT}, at timestamp")
    done, new = rewrite_batch(requests.select("query"), cache, make, provider, base_url, model, config)
    done = stored(done, "rewritten")
    if cache_path and config.enabled:
        new.withColumn("at", F.current_timestamp()).write.mode("append").parquet(cache_path)
    return requests.join(done, "query").select("query_id", F.col("query").alias("user_query"), F.col("result").alias("query_rewrite"))


def variants(rewrites: DataFrame, make: Callable[[], Embedder]) -> DataFrame:
    """(query_id, query_index, matched_query, q_embedding) of the usable variants of rewritten requests."""
    usable = retrieve.usable_variants(F.col("query_rewrite.retrieval_queries"), F.col("user_query"))
    each = rewrites.select("query_id", F.posexplode(usable).alias("query_index", "matched_query"))
    return adapters.embedded(each, "matched_query", make, "q_embedding")


def answer(requests: DataFrame, vectors: DataFrame, chunks: DataFrame, embed: Callable[[], Embedder], rewriter: Callable[[], Generator], generator: Callable[[], Generator], language: str = "English", extra: str = "",
           retrieve_config: RetrieveConfig = RetrieveConfig(), rewrite_config: RewriteConfig = RewriteConfig(), generate_config: GenerateConfig = GenerateConfig(), cache_path: str | None = None, **rewrite_names) -> tuple[DataFrame, DataFrame]:
    """(source packs, dialogues) of a batch of requests (query_id, query), end to end: rewrite, variants, neighbours, merge, pick, coverage, prompt, model, appendix."""
    rewrites = rewritten_requests(requests, rewriter, cache_path=cache_path, config=rewrite_config, **rewrite_names)
    packs = stored(retrieve_batch(variants(rewrites, embed), vectors, chunks, retrieve_config, rewrites)[1], "packs")
    return packs, dialogues(packs, generator, language, extra, generate_config)


def dialogues(packs: DataFrame, make: Callable[[], Generator], language: str = "English", extra: str = "", config: GenerateConfig = GenerateConfig(), dry_run: bool = False, model: str = "") -> DataFrame:
    """(query_id, prompt_json, prompt_chars, rounds[, dialogue_md, dialogue_lines, meta_json, error]) of source packs: prompt, model, its own source notes cut, appendix added.

    The prompt gets the core query and the terms of the pack's rewrite. A failed call has a null dialogue and its error.
    """
    rounds = T.rounds(F.col("user_query"), config.rounds, config.max_rounds)
    rewritten = F.col("query_rewrite")
    search = F.struct(F.coalesce(rewritten["core_query"], F.lit("")).alias("core_query"), F.coalesce(rewritten["canonical_terms"], F.array().cast("array<string>")).alias("canonical_terms"))
    prompt = generate.messages(F.col("user_query"), rounds, F.lit(language), F.col("coverage"), search, F.col("sources"), F.lit(extra), config)
    asked = packs.select("query_id", "user_query", "coverage", "sources", rounds.alias("rounds"), prompt.alias("messages")).withColumn("prompt_chars", generate.prompt_chars(F.col("messages"))).withColumn("prompt_json", generate.as_json(F.col("messages")))
    if dry_run:
        return asked.select("query_id", "prompt_json", "prompt_chars", "rounds")
    answered = completed(asked, "messages", make)
    whole = answered.withColumn("dialogue_md", F.when(F.col("error").isNull(), generate.document(F.coalesce("answer", F.lit("")), F.col("sources"), config.appendix_excerpt_chars)))
    meta = F.struct("query_id", F.lit(model).alias("model"), "rounds", (F.col("rounds") * 2).alias("total_dialogue_lines"), F.lit(language).alias("language"), "coverage", "user_query")
    return whole.select("query_id", "prompt_json", "prompt_chars", "rounds", "dialogue_md", F.regexp_count("answer", F.lit(r"(?m)^\s*\S")).alias("dialogue_lines"), F.when(F.col("error").isNull(), sinks.pretty(meta)).alias("meta_json"), "error")
