"""Query rewriting: cache keys and lookup, validation of a model's answer, ordered distinct variants, fallback."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern import schemas
from quern.config import RewriteConfig
from quern.functions import kernels
from quern.functions import text as T

RESULT = schemas.REWRITE_STRUCT
ANSWER = "struct<canonical_terms:string,retrieval_queries:string,core_query:string>"


def quoted(x: Column) -> Column:
    """A string as a JSON literal, non-ASCII kept."""
    inner = F.to_json(F.struct(x.alias("v")))
    return F.regexp_replace(inner, r"(?s)^\{\"v\":(.*)\}$", "$1")


def cache_key(query: Column, provider: str, base_url: str, model: str, config: RewriteConfig = RewriteConfig()) -> Column:
    """SHA-1 of the JSON text of the six settings in order of their names, with ", " and ": " between them."""
    fixed = {"base_url": base_url, "max_queries": config.max_queries, "model": model, "prompt_version": config.prompt_version, "provider": provider}
    before = json.dumps(fixed, ensure_ascii=False, sort_keys=True)[:-1]
    return F.sha1(F.concat(F.lit(before + ', "query": '), quoted(query), F.lit("}")))


def cached(requests: DataFrame, cache: DataFrame, order: str) -> DataFrame:
    """Requests with the ``result`` of the first cache row of their key; null where there is none or it is empty."""
    first = cache.groupBy("cache_key").agg(F.min_by("result", order).alias("result"))
    return requests.join(first, "cache_key", "left")


def parsed(answers: DataFrame, answer: str = "answer", query: str = "query", provider: str = "", model: str = "", include_original: bool = True, config: RewriteConfig = RewriteConfig()) -> DataFrame:
    """``answers`` with ``result``: the checked rewrite, or the query itself with the reason why the rewrite failed.

    Terms that are no list count as none; queries that are no list, an answer that is no JSON object and one without any query fail.
    The original (if included), the core query (else the distinct terms in one string) and the rewrites are made
    distinct in order, whatever their case, and cut to the greatest number.
    """
    raw = answers.withColumn("_object", kernels.json_object(F.col(answer))).withColumn("_fields", F.from_json("_object", ANSWER))
    terms = F.filter(F.coalesce(F.when(_is_list(F.col("_fields.canonical_terms")), F.from_json("_fields.canonical_terms", "array<string>")), F.array().cast("array<string>")), lambda t: T.strip(t) != "")
    found = F.when(F.col("_fields.retrieval_queries").isNull(), F.array().cast("array<string>")).when(_is_list(F.col("_fields.retrieval_queries")), F.from_json("_fields.retrieval_queries", "array<string>"))
    core = T.strip(F.coalesce("_fields.core_query", F.lit("")))
    joined = F.array_join(T.distinct_ignoring_case(terms), " ")
    second = F.when(core != "", F.array(core)).when(joined != "", F.array(joined)).otherwise(F.array().cast("array<string>"))
    first = F.array(F.col(query)) if include_original else F.array().cast("array<string>")
    variants = F.slice(T.distinct_ignoring_case(F.concat(first, second, F.coalesce(found, F.array().cast("array<string>")))), 1, config.max_queries)
    reason = F.when(F.col("_object").isNull(), "rewrite_failed:not_a_json_object").when(found.isNull(), "rewrite_failed:retrieval_queries is not a list").when(F.size(variants) == 0, "rewrite_failed:no valid queries")
    good = F.struct(
        F.col(query).alias("original_query"), terms.alias("canonical_terms"), core.alias("core_query"), variants.alias("retrieval_queries"), F.lit(True).alias("rewrite_used"),
        F.lit(provider).alias("provider"), F.lit(model).alias("model"), F.lit(None).cast("string").alias("fallback_reason"),
    )
    return raw.withColumn("result", F.when(reason.isNull(), good).otherwise(not_rewritten(F.col(query), reason))).drop("_object", "_fields")


def not_rewritten(query: Column, reason: Column) -> Column:
    """The result for a request that is used as it is, and why."""
    null = F.lit(None).cast("string")
    return F.struct(
        query.alias("original_query"), F.lit(None).cast("array<string>").alias("canonical_terms"), null.alias("core_query"), F.array(query).alias("retrieval_queries"), F.lit(False).alias("rewrite_used"),
        null.alias("provider"), null.alias("model"), reason.alias("fallback_reason"),
    )


def _is_list(x: Column) -> Column:
    return F.substring(x, 1, 1) == "["


def prompt(query: Column, max_queries: int) -> Column:
    """Messages that ask a model for a rewrite (role, content)."""
    system = "You turn a question about podcasts into search queries. Answer with one JSON object and nothing else."
    rules = (
        'Give the keys "canonical_terms" (names and terms as transcripts spell them, a list), "core_query" (one short query with the subject only) '
        f'and "retrieval_queries" (at most {max_queries} different queries, a list). Do not invent facts.\nQuestion: '
    )
    return F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")), F.struct(F.lit("user").alias("role"), F.concat(F.lit(rules), T.collapse(query)).alias("content")))
