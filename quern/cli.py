"""Command line: scrape, validate, audit, clean, chunk, index, rewrite, retrieve, dialogue and the whole pipeline, over folders of JSON lines and Parquet tables.

    python -m quern.cli clean --input interim --output processed --report reports

Embedders and generators are named as ``module:factory`` and made on the executors; the defaults are the offline stand-ins.
"""

from __future__ import annotations

import argparse
import datetime
import functools
import importlib
from collections.abc import Callable
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import adapters
from quern.config import ChunkConfig, CleanConfig, GenerateConfig, RetrieveConfig, RewriteConfig, load_yaml, merged
from quern.operators import audit, chunk, clean, index, retrieve
from quern.plans import acquire, pipeline
from quern.schemas import CHUNK, DOCUMENT
from quern.sources import jsonl, sinks
from quern.storage import stored

FILE = "source_documents.jsonl"


def factory(name: str, **options) -> Callable:
    """What ``module:factory`` names, with options given."""
    module, _, attribute = name.partition(":")
    made = getattr(importlib.import_module(module), attribute)
    return functools.partial(made, **options) if options else made


def _interim(spark: SparkSession, folder: str, max_files: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, broken lines, files) of interim folders; broken lines are reported and are no documents."""
    lines = jsonl.numbered(spark, f"{folder}/*/{FILE}", DOCUMENT).withColumn("podcast_slug", jsonl.slug_of(F.col("source_file"))).where("podcast_slug <> 'catalog'")
    files = spark.read.format("binaryFile").load(f"{folder}/*/{FILE}").select(F.col("path").alias("source_file")).withColumn("podcast_slug", jsonl.slug_of(F.col("source_file"))).where("podcast_slug <> 'catalog'")
    if max_files:
        files = files.orderBy("source_file").limit(max_files)
        lines = lines.join(F.broadcast(files.select("podcast_slug")), "podcast_slug", "left_semi")  # at most max_files rows
    return lines.where("not broken").drop("_line", "broken"), lines.where("broken").select("source_file", "line_no", F.col("_line").alias("line")), files


def run_scrape(spark: SparkSession, a: argparse.Namespace) -> None:
    fetch = functools.partial(adapters.HttpFetcher, timeout=a.timeout, pause=a.sleep)
    host = urlparse(a.catalog_url or a.podcast_url).netloc
    raw = f"{a.output}/raw" if a.save_raw_html else None
    if a.catalog_url:
        series = stored(acquire.podcasts(spark, a.catalog_url, fetch, host, a.max_catalog_pages, a.max_podcasts, raw=raw), "series")
        sinks.write_jsonl(series, f"{a.output}/catalog")
    else:
        series = spark.createDataFrame([(a.podcast_url, urlparse(a.podcast_url).path.rstrip("/").rsplit("/", 1)[-1], None)], "url string, slug string, title string")
    held = f"{a.output}/documents"
    resume = not a.no_resume and sinks.exists(spark, held)
    existing = jsonl.dropping(spark, held, DOCUMENT).select("url") if resume else spark.createDataFrame([], "url string")
    now = datetime.datetime.now(datetime.UTC).isoformat()
    docs, summary = acquire.new_documents(series, existing, fetch, host, a.site, now, a.max_pages, not a.drop_timestamps, max_episodes=a.max_episodes, raw=raw)
    sinks.write_jsonl(docs.withColumn("slug", F.col("metadata.podcast_slug")), held, append=resume)
    sinks.write_report(summary, f"{a.output}/summary")
    if a.validate:
        written = spark.read.schema(DOCUMENT).option("mode", "FAILFAST").json(held)
        sinks.write_report(clean.rounded(audit.validated(written, F.length(F.coalesce("clean_text", F.lit(""))), ["url"])), f"{a.output}/validation")


def run_validate(spark: SparkSession, a: argparse.Namespace) -> None:
    docs, _, files = _interim(spark, a.input)
    counts = audit.by_file(docs.withColumn("chars", F.length(F.coalesce("clean_text", F.lit("")))), F.col("chars"), "podcast_slug")
    sinks.write_report(clean.rounded(audit.roll_up(counts, files, "podcast_slug")), a.report)


def run_audit(spark: SparkSession, a: argparse.Namespace) -> None:
    docs, broken, files = _interim(spark, a.input)
    rows = stored(docs.select("podcast_slug", "title", "url", "doc_id", F.length(F.coalesce("clean_text", F.lit(""))).alias("chars"), "content_hash", "source_file", "line_no"), "audit-rows")
    order = ["source_file", "line_no"]
    sinks.write_report(clean.rounded(audit.summary(rows, F.col("chars"))), f"{a.report}/summary")
    sinks.write_report(audit.counts_by(rows.withColumn("at", F.struct(*order)), "podcast_slug", "at"), f"{a.report}/counts")
    sinks.write_jsonl(audit.duplicates(rows, ["url", "doc_id", "content_hash"]), f"{a.report}/duplicates")
    sinks.write_report(audit.shortest(rows, "chars", order), f"{a.report}/shortest_200")
    sinks.write_report(audit.longest(rows, "chars", order), f"{a.report}/longest_200")
    sinks.write_report(audit.empty_partitions(files, rows, "podcast_slug"), f"{a.report}/empty")
    sinks.write_jsonl(broken, f"{a.report}/broken_lines")


def run_clean(spark: SparkSession, a: argparse.Namespace) -> None:
    config = merged(CleanConfig(dedupe=not a.no_dedupe), None, min_chars=a.min_chars)
    docs, broken, files = _interim(spark, a.input, a.max_files)
    order = ["source_file", "line_no"]
    decided = stored(clean.decided(clean.cleaned(docs, config=config), order, config), "decided")  # computed once, all reports read it
    if not a.dry_run:
        sinks.write_partitions(clean.rewritten(decided), a.output, expected=files)
    rows = clean.report(decided).select("podcast_slug", "title", "url", "original_chars", "cleaned_chars", "removed_chars", "cleaned_hash", "skip_reason", *order)
    sinks.write_report(clean.rounded(clean.summary(decided)), f"{a.report}/summary")
    sinks.write_report(clean.reason_histogram(decided), f"{a.report}/remove_reasons")
    sinks.write_jsonl(rows.where("skip_reason is not null"), f"{a.report}/skipped")
    sinks.write_report(clean.largest_reductions(rows, order), f"{a.report}/largest_reductions")
    sinks.write_report(clean.shortest_written(rows, order), f"{a.report}/shortest_cleaned")
    sinks.write_report(clean.written_by(rows, "podcast_slug", F.struct(*order)), f"{a.report}/podcast_counts")
    sinks.write_jsonl(broken, f"{a.report}/broken_lines")


def run_chunk(spark: SparkSession, a: argparse.Namespace) -> None:
    config = merged(ChunkConfig(), None, target_chars=a.target_chars, max_chars=a.max_chars, min_chunk_chars=a.min_chunk_chars, overlap_blocks=a.overlap_blocks)
    docs = jsonl.recursive(spark, a.input, DOCUMENT, a.pattern, a.max_files)
    if a.max_docs:
        docs = docs.orderBy("source_file", "doc_id").limit(a.max_docs)
    slug = F.coalesce(jsonl.slug_below(F.col("source_file"), a.input), jsonl.slug_of(F.col("source_file")))
    done = stored(chunk.chunked(docs, config, slug=slug, source_file=F.col("source_file")), "chunked")
    sinks.write_jsonl(chunk.records(done), a.output)
    sinks.write_report(clean.rounded(chunk.statistics(done), 2), a.summary)
    sinks.write_report(chunk.skip_reasons(done), f"{a.summary}_skips")


def run_index(spark: SparkSession, a: argparse.Namespace) -> None:
    chunks = index.window(jsonl.strict(spark, a.chunks, CHUNK), ["chunk_id", "chunk_index"], a.start_offset, a.max_chunks)
    ready = sinks.first_rows(index.metadata(chunks, ()), "chunk_id", [F.col("doc_id"), F.col("chunk_index")])
    embed = factory(a.embedder)
    if a.reset or not sinks.exists(spark, a.table):
        sinks.reset(adapters.embedded(ready, "text", embed), a.table)
        return
    held = spark.read.parquet(a.table).select(F.col("chunk_id").alias("id"))
    sinks.append_new(adapters.embedded(index.missing(ready, held), "text", embed), a.table, "chunk_id")


def _requests(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return spark.createDataFrame(list(enumerate(a.query)), "query_id int, query string")


def _settings(a: argparse.Namespace) -> tuple[RewriteConfig, RetrieveConfig, dict]:
    given = load_yaml(a.config) if a.config else {}
    rewriting = merged(RewriteConfig(enabled=not a.disable_rewrite and bool(a.rewriter)), {k: v for k, v in given.get("query_rewrite", {}).items() if k != "enabled"})
    retrieving = merged(RetrieveConfig(), given.get("retrieval", {}), final_top_k=a.top_k, raw_top_k_per_query=a.raw_top_k, max_chunks_per_doc=a.max_chunks_per_doc, max_chunks_per_podcast=a.max_chunks_per_podcast, max_chunks_per_title=a.max_chunks_per_title, min_relevance_distance=a.max_distance, preview_chars=a.preview_chars)
    return rewriting, retrieving, {"provider": a.rewriter or "", "base_url": "", "model": a.rewrite_model}


def _rewrites(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    config, _, names = _settings(a)
    return pipeline.rewritten_requests(_requests(spark, a), factory(a.rewriter or "quern.adapters:EchoGenerator"), cache_path=a.cache, config=config, **names)


def _packs(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    table = spark.read.parquet(a.table)
    rewrites = _rewrites(spark, a)
    return stored(pipeline.retrieve_batch(pipeline.variants(rewrites, factory(a.embedder)), table.select("chunk_id", "embedding"), table.drop("embedding"), _settings(a)[1], rewrites)[1], "packs")


def run_rewrite(spark: SparkSession, a: argparse.Namespace) -> None:
    sinks.write_report(_rewrites(spark, a), a.output)


def _show(packs: DataFrame, preview: int) -> None:
    for r in packs.select("query_id", F.explode(retrieve.listing(F.col("sources"), preview)).alias("line")).orderBy("query_id").collect():  # the final picks of the requests given on the command line
        print(r.line)


def run_retrieve(spark: SparkSession, a: argparse.Namespace) -> None:
    packs = _packs(spark, a)
    sinks.write_report(packs, a.output)
    _show(packs, _settings(a)[1].preview_chars)


def _write_dialogues(spark: SparkSession, a: argparse.Namespace, packs: DataFrame) -> None:
    config = merged(GenerateConfig(), load_yaml(a.generation_config).get("dialogue", {}) if a.generation_config else {}, rounds=a.rounds)
    made = stored(pipeline.dialogues(packs, factory(a.generator), a.language, a.extra_instructions, config, a.dry_run, a.model), "dialogues")
    name = F.concat(F.lit(datetime.datetime.now().strftime("dialogue_%Y%m%d_%H%M%S_")), F.col("query_id").cast("string"))
    rows = made.withColumn("name", name)
    prompts = [F.col("prompt_json")] if a.save_prompt or a.dry_run else []
    texts = [] if a.dry_run else [F.col("dialogue_md").alias("md"), "meta_json"]
    sinks.write_texts(rows.select("name", *prompts, *texts), a.output, "name", *(["prompt_json"] if prompts else []), *([] if a.dry_run else ["md", "meta_json"]))
    if not a.dry_run:
        sinks.write_texts(rows.select(F.concat(F.lit("latest_"), F.col("query_id").cast("string")).alias("name"), F.col("dialogue_md").alias("md"), "meta_json"), a.output, "name", "md", "meta_json")
        if failed := made.where("error is not null").select("query_id", "error").collect():  # requests given on the command line
            raise RuntimeError(f"requests without a dialogue: {[tuple(r) for r in failed]}")


def run_dialogue(spark: SparkSession, a: argparse.Namespace) -> None:
    _write_dialogues(spark, a, _packs(spark, a))


def run_pipeline(spark: SparkSession, a: argparse.Namespace) -> None:
    packs = _packs(spark, a)
    sinks.write_report(packs, f"{a.output}/source_packs")
    _write_dialogues(spark, a, packs)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quern")
    sub = p.add_subparsers(required=True)

    def command(name: str, run, *required: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        c.set_defaults(run=run)
        for r in required:
            c.add_argument(f"--{r}", required=True)
        return c

    c = command("scrape", run_scrape, "output")
    where = c.add_mutually_exclusive_group(required=True)
    where.add_argument("--catalog-url")
    where.add_argument("--podcast-url")
    c.add_argument("--site", default="site")
    c.add_argument("--sleep", type=float, default=1.0)
    c.add_argument("--timeout", type=float, default=30)
    for name in ("max-pages", "max-catalog-pages", "max-podcasts", "max-episodes"):
        c.add_argument(f"--{name}", type=int)
    for name in ("drop-timestamps", "no-resume", "save-raw-html", "validate"):
        c.add_argument(f"--{name}", action="store_true")
    command("validate", run_validate, "input", "report")
    command("audit", run_audit, "input", "report")
    c = command("clean", run_clean, "input", "output", "report")
    c.add_argument("--min-chars", type=int)
    c.add_argument("--max-files", type=int)
    c.add_argument("--no-dedupe", action="store_true")
    c.add_argument("--dry-run", action="store_true")
    c = command("chunk", run_chunk, "input", "output", "summary")
    c.add_argument("--pattern", default="*.json")
    for name in ("target-chars", "max-chars", "min-chunk-chars", "overlap-blocks", "max-docs", "max-files"):
        c.add_argument(f"--{name}", type=int)
    c = command("index", run_index, "chunks", "table")
    c.add_argument("--max-chunks", type=int)
    c.add_argument("--start-offset", type=int, default=0)
    c.add_argument("--reset", action="store_true")
    c.add_argument("--embedder", default="quern.adapters:HashEmbedder")
    for name, run, needs in (("rewrite", run_rewrite, ("output",)), ("retrieve", run_retrieve, ("table", "output")), ("dialogue", run_dialogue, ("table", "output")), ("pipeline", run_pipeline, ("table", "output"))):
        c = command(name, run, *needs)
        c.add_argument("--query", action="append", required=True)
        c.add_argument("--config")
        c.add_argument("--rewriter", help="module:factory of the model that rewrites; none: requests stay as they are")
        c.add_argument("--rewrite-model", default="")
        c.add_argument("--disable-rewrite", action="store_true")
        c.add_argument("--cache", help="folder of the cache of rewrites")
        c.add_argument("--embedder", default="quern.adapters:HashEmbedder")
        c.add_argument("--max-distance", type=float)
        for option in ("top-k", "raw-top-k", "max-chunks-per-doc", "max-chunks-per-podcast", "max-chunks-per-title", "preview-chars"):
            c.add_argument(f"--{option}", type=int)
        if name in ("dialogue", "pipeline"):
            c.add_argument("--generator", default="quern.adapters:EchoGenerator")
            c.add_argument("--model", default="")
            c.add_argument("--generation-config")
            c.add_argument("--rounds", "--turns", type=int)
            c.add_argument("--language", default="English")
            c.add_argument("--extra-instructions", default="")
            c.add_argument("--dry-run", action="store_true")
            c.add_argument("--save-prompt", action="store_true")
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(SparkSession.builder.appName("quern").getOrCreate(), args)


if __name__ == "__main__":
    main()
