"""From a catalogue or a podcast's address to new source documents. Every page is a row, fetched once and stored: what cannot be fetched is counted, not fatal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import adapters
from quern.functions import html as H
from quern.functions import text as T
from quern.operators import scrape
from quern.sources import sinks
from quern.storage import stored


def _fetch_once(links: DataFrame, fetch: Callable[[], adapters.Fetcher] | DataFrame, kind: str, slug: Column, raw: str | None, tasks: int) -> DataFrame:
    """``links`` with ``html`` and ``error``, stored: whatever reads them later, no page is requested again. ``raw``: a folder that keeps the pages as they came."""
    got = stored(adapters.fetched(links if isinstance(fetch, DataFrame) else links.coalesce(tasks), fetch), "pages")
    if raw is not None:
        sinks.keep_pages(got.select(F.lit(kind).alias("kind"), slug.alias("slug"), "url", "html"), raw)
    return got


def _all_pages(first: DataFrame, fetch: Callable[[], adapters.Fetcher] | DataFrame, host: str, most: int | None, tasks: int, kind: str, raw: str | None, first_url: Column | None = None) -> DataFrame:
    """(root, url, page, html) of all pages of listings. ``first``: (root); the first page of each tells how many there are."""
    page = lambda n: T.page_url(F.col("root"), n, host)
    slug = T.slug_from_url(F.col("root"))
    one = _fetch_once(first.select("root", F.lit(1).alias("page"), (page(F.lit(1)) if first_url is None else first_url).alias("url")), fetch, kind, slug, raw, tasks)
    known = one.withColumn("n", H.total_pages_udf("html"))
    last = F.col("n") if most is None else F.least("n", F.lit(most))
    more = known.where("html is not null").select("root", F.explode(F.sequence(F.lit(1), last.cast("int"))).alias("page")).where("page > 1").withColumn("url", page(F.col("page")))
    rest = _fetch_once(more.select("root", "page", "url"), fetch, kind, slug, raw, tasks)
    return one.unionByName(rest).where("html is not null")


def podcasts(spark: SparkSession, catalog_url: str, fetch: Callable[[], adapters.Fetcher], host: str, max_pages: int | None = None, max_podcasts: int | None = None, tasks: int = 1, raw: str | None = None) -> DataFrame:
    """The podcasts of a catalogue, each address once."""
    root = spark.createDataFrame([(catalog_url,)], "root string")
    return scrape.catalog(_all_pages(root, fetch, host, max_pages, tasks, "catalog_page", raw), "page", most=max_podcasts)


def new_documents(series: DataFrame, existing: DataFrame, fetch: Callable[[], adapters.Fetcher], host: str, site: str, retrieved_at: str, max_pages: int | None = None, keep_timestamps: bool = True, tasks: int = 1, max_episodes: int | None = None, raw: str | None = None, list_url: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, summary) of the episodes of podcasts (slug, url, title) whose address no row of ``existing`` (url) has.

    ``tasks`` is the number of requests at once: each task fetches one page after another, with the fetcher's pauses. ``max_episodes``: the first
    so many links of each podcast are looked at, those that exist included. ``list_url``: the address of a podcast's first
    page (a column over ``root``), by default its own without query. ``summary``: (slug, written, skipped, failed).
    """
    pages = _all_pages(series.select(F.col("url").alias("root")).distinct(), fetch, host, max_pages, tasks, "podcast_list_page", raw, list_url)
    roots = series.select(F.col("url").alias("root"), F.col("slug"), F.col("title").alias("podcast_title")).dropDuplicates(["root"])
    owners = pages.select(F.col("url").alias("list_page_url"), "root", "page").join(roots, "root").drop("root").dropDuplicates(["list_page_url"])
    links = scrape.placed_listing(pages.withColumn("at", F.struct("root", "page")), "at").join(owners, "list_page_url", "left")
    if max_episodes is not None:
        links = scrape.first_per(links, ["slug"], ["page", "place"], max_episodes)
    links = stored(links.drop("place", "page"), "links")
    todo = scrape.unseen(links, existing)
    got = _fetch_once(todo, fetch, "episode_page", F.col("slug"), raw, tasks)
    docs = scrape.documents(got.where("html is not null"), retrieved_at, site, F.col("podcast_title"), F.col("slug"), keep_timestamps)
    return docs, adapters.fetch_summary(got, links, "slug")
