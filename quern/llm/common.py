"""Shared terms of the llm operators: shared storage, words, podcasts, pages.

Every function here is a DataFrame or Column transformation; nothing collects rows of the input.
"""

from __future__ import annotations

from urllib.parse import quote

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.storage import new_path, remove, shared_dir, stored

__all__ = ["name_key", "new_path", "opened", "page_key", "qualified", "remove", "sampled", "shared_dir", "stored", "with_podcast", "words"]

def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system's scheme, so that kernels open the same file system as Spark does."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path within it of a qualified path, for kernels."""
    if "://" not in path:
        path = "file://" + quote(path.removeprefix("file:"))
    return pafs.FileSystem.from_uri(path)


def words(text: Column) -> Column:
    """The longest runs of letters of any script, lower-cased. Null for null."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(\p{L}+)"), F.lit(1)), F.lower)


def sampled(rows: DataFrame, sample: int, least: int, longest: int) -> list[str]:
    """The ``text`` of up to ``sample`` rows (id, text) of ``least`` to ``longest`` characters: those with the smallest hashes of their ids. Little more than these is sent by the tasks."""
    share = 1_000_000 * 1.5 * sample / max(rows.count(), 1)
    fit = rows.where(F.length("text").between(least, longest)).select(F.pmod(F.xxhash64("id"), F.lit(1_000_000)).alias("h"), "id", "text")
    return [r.text for r in sorted(fit.where(F.col("h") < share).limit(4 * sample).collect())[:sample]]


# Accented Latin letters and the plain letters that stand for them in slugs.
ACCENTED = "àáâãäåāăąçćčďèéêëēėęěìíîïīłñńňòóôõöøōőřśšťùúûüūůűýÿźžż"
PLAIN = "aaaaaaaaacccdeeeeeeeeiiiiilnnnooooooooorsstuuuuuuuyyzzz"


def name_key(name: Column) -> Column:
    """A spelling-free key of a title or slug: case, accents, width, punctuation, ``&`` and page suffixes do not count."""
    wide = "".join(chr(0xFF01 + i) for i in range(94)) + "　 "
    narrow = "".join(chr(0x21 + i) for i in range(94)) + "  "
    x = F.lower(F.translate(name, wide, narrow))
    x = F.regexp_replace(F.translate(x, ACCENTED, PLAIN), r"&amp;|&#38;|&", " and ")
    x = F.regexp_replace(x, r"\p{M}+", "")
    x = F.regexp_replace(x, r"['’`´]", "")
    x = F.trim(F.regexp_replace(x, r"[^\p{L}\p{N}]+", " "))
    x = F.regexp_replace(x, r"(?<=.) page \d+$", "")
    return F.regexp_replace(F.concat(F.lit(" "), x, F.lit(" ")), r"^ (the )?|( and(?= ))| $", "")


def _dropped(key: Column) -> Column:
    """The key itself and every key with one character left out."""
    n = F.length(key)
    each = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(key, F.lit(1), i - 1), F.substring(key, i + 1, n)))
    return F.when(n >= 4, F.array_distinct(F.concat(F.array(key), each))).otherwise(F.array(key))


def _one_edit(a: Column, b: Column) -> Column:
    """True where a and b differ by at most one insertion, deletion, replacement or swap of neighbours."""
    near = F.levenshtein(a, b)
    same = F.sort_array(F.split(a, "")) == F.sort_array(F.split(b, ""))
    return (near <= 1) | ((near == 2) & (F.length(a) == F.length(b)) & same)


def podcast_names(series: DataFrame) -> DataFrame:
    """(key, podcast): every key that names a podcast by its title or slug. A key of two podcasts names none."""
    named = series.where(F.col("slug").isNotNull()).select(F.col("slug").alias("podcast"), F.explode(F.array(name_key(F.col("title")), name_key(F.col("slug")))).alias("key"))
    named = named.where(F.length("key") > 0)
    return named.groupBy("key").agg(F.min("podcast").alias("podcast"), F.max("podcast").alias("_other")).where(F.col("podcast") == F.col("_other")).drop("_other")


def resolve_names(titles: DataFrame, series: DataFrame) -> DataFrame:
    """(title, podcast) for each distinct ``title`` that names a podcast, exactly or with one typing error.

    Titles are made distinct first, so the work follows the number of spellings, not of rows. One-edit
    matches come from an equi-join on keys with one character dropped (no cross join); the match counts
    only if a single podcast is that near and no key is equal; letters dropped or swapped come before letters added or replaced.
    """
    names = podcast_names(series)
    keyed = titles.where(F.col("title").isNotNull()).select("title").distinct().withColumn("key", name_key(F.col("title"))).where(F.length("key") > 0)
    equal = keyed.join(names, "key", "left")
    exact = equal.where("podcast is not null").select("title", "podcast")
    open_ = equal.where("podcast is null").select("title", "key").withColumn("part", F.explode(_dropped(F.col("key"))))
    near = names.withColumnRenamed("key", "known").withColumn("part", F.explode(_dropped(F.col("known"))))
    edits = open_.join(near, "part").where(_one_edit(F.col("key"), F.col("known")))
    # Letters dropped or swapped are likelier than letters added or replaced.
    same = F.sort_array(F.split("key", "")) == F.sort_array(F.split("known", ""))
    edits = edits.withColumn("_added", F.when(same | (F.length("key") < F.length("known")), 0).otherwise(1))
    best = edits.groupBy("title").agg(F.min("_added").alias("_best"))
    edits = edits.join(best, "title").where("_added = _best").groupBy("title").agg(F.min("podcast").alias("podcast"), F.max("podcast").alias("_other")).where(F.col("podcast") == F.col("_other")).drop("_other")
    return exact.unionByName(edits)


def with_podcast(docs: DataFrame, series: DataFrame, title: str = "podcast_title", slug: Column | None = None) -> DataFrame:
    """Add ``podcast`` (a slug, null = unknown) to source documents.

    The podcast is the one that the title names however it is written, else the one of the slug, else
    unknown; a slug that no podcast has is unknown. Null and blank titles name none.
    """
    slug = F.col("metadata.podcast_slug") if slug is None else slug
    found = resolve_names(docs.select(F.col(title).alias("title")), series).select(F.col("title").alias("_title"), F.col("podcast").alias("_named"))
    slugs = series.where("slug is not null").select(F.col("slug").alias("_known")).distinct()
    out = docs.withColumn("_slug", slug).join(found, F.col(title) == F.col("_title"), "left").join(slugs, F.col("_slug") == F.col("_known"), "left")
    return out.withColumn("podcast", F.coalesce("_named", "_known")).drop("_slug", "_title", "_named", "_known")


def page_key(url: Column) -> Column:
    """The page an address leads to: its path and its ``episode`` parameter. Null for null and blank addresses."""
    x = F.regexp_replace(F.trim(url), r"#.*$", "")
    query = F.regexp_extract(x, r"\?(.*)$", 1)
    path = F.regexp_replace(x, r"\?.*$", "")
    path = F.regexp_replace(path, r"^(?i:(?:[a-z][a-z0-9+.-]*:)?//[^/]*|[a-z0-9-]+(?:\.[a-z0-9-]+)+(?::\d+)?(?=/|$))", "")
    path = F.regexp_replace(F.regexp_replace(path, r"/{2,}", "/"), r"/+$", "")
    episode = F.regexp_extract(query, r"(?:^|[&;])episode=([^&;]+)", 1)
    return F.when(F.trim(url) != "", F.concat_ws("?", path, F.when(episode != "", episode)))
