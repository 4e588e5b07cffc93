"""From fetched pages to source documents: cards, listings, transcript segments, resume. Fetching itself is an adapter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import html as H
from quern.functions import text as T

# Lines that end a transcript, that are labels within it, and that a page without times has around its text.
STOPS = ("about us", "contact us", "privacy", "terms")
LABELS = ("copy link to transcript", "audio transcription by", "transcribed from audio to text by")
SKIPPED = ("home", "podcasts", "youtube channels", "about us", "request podcast", "copy link to transcript", "audio transcription by", "privacy", "terms")


def catalog(pages: DataFrame, order: str, html: str = "html", url: str = "url", most: int | None = None) -> DataFrame:
    """Podcasts of catalogue pages, each address once (where it comes first), at most ``most`` in the order of pages and cards."""
    cards = pages.select(F.col(order).alias("_page"), F.posexplode(H.podcast_cards_udf(F.col(html), F.col(url))).alias("_at", "card")).select("_page", "_at", "card.*")
    return _first_of(cards, "url", most)


def listing(pages: DataFrame, order: str, html: str = "html", url: str = "url", most: int | None = None) -> DataFrame:
    """Episodes of listing pages, each address once (where it comes first)."""
    cards = pages.select(F.col(order).alias("_page"), F.posexplode(H.episode_cards_udf(F.col(html), F.col(url))).alias("_at", "card")).select("_page", "_at", "card.*")
    return _first_of(cards, "url", most)


def placed_listing(pages: DataFrame, order: str, html: str = "html", url: str = "url") -> DataFrame:
    """``listing`` with ``place``, the card's number on its page."""
    cards = pages.select(F.col(order).alias("_page"), F.posexplode(H.episode_cards_udf(F.col(html), F.col(url))).alias("_at", "card")).select("_page", "_at", F.col("_at").alias("place"), "card.*")
    return _first_of(cards, "url", None)


def first_per(links: DataFrame, keys: list[str], order: list[str], most: int) -> DataFrame:
    """The first ``most`` links of each group. A bounded rank: Spark keeps no more than ``most`` rows of a group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return links.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")


def _first_of(cards: DataFrame, key: str, most: int | None) -> DataFrame:
    others = [c for c in cards.columns if c != key]
    first = cards.groupBy(key).agg(F.min_by(F.struct(*others), F.struct("_page", "_at")).alias("_c")).select(key, "_c.*")
    ordered = first if most is None else first.orderBy("_page", "_at").limit(most)
    return ordered.drop("_page", "_at").select(*[c for c in cards.columns if c not in ("_page", "_at")])


def unseen(links: DataFrame, existing: DataFrame, key: str = "url") -> DataFrame:
    """Links whose address no document has yet (resume)."""
    return links.join(existing.select(key).where(f"{key} is not null").distinct(), key, "left_anti")


def is_time(line: Column) -> Column:
    return line.rlike(r"^\d{1,2}:\d{2}:\d{2}$")


def segments(lines: Column) -> Column:
    """array<struct(timestamp, text)> of a page's visible lines: from each time line to the next; nothing before the first, nothing from a closing line on, labels left out."""
    low = F.transform(lines, F.lower)
    begins = F.array_position(F.transform(lines, lambda s: is_time(s).cast("int")), 1)
    stops = F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: (i > begins) & (F.element_at(low, i.cast("int")).isin(*STOPS) | F.startswith(F.element_at(low, i.cast("int")), F.lit("description of "))))
    end = F.when(F.size(stops) > 0, stops[0]).otherwise(F.size(lines) + 1)
    body = F.when((F.size(lines) > 0) & (begins > 0), F.filter(F.slice(lines, begins.cast("int"), (end - begins).cast("int")), lambda s: ~F.lower(s).isin(*LABELS))).otherwise(F.array().cast("array<string>"))
    start = F.struct(F.lit(None).cast("string").alias("ts"), F.array().cast("array<string>").alias("held"), F.array().cast("array<struct<timestamp:string,text:string>>").alias("done"))

    def flushed(acc: Column) -> Column:
        one = F.struct(acc["ts"].alias("timestamp"), T.collapse(F.array_join(acc["held"], " ")).alias("text"))
        return F.when(F.size(acc["held"]) > 0, F.concat(acc["done"], F.array(one))).otherwise(acc["done"])

    def step(acc: Column, s: Column) -> Column:
        new = F.struct(s.alias("ts"), F.array().cast("array<string>").alias("held"), flushed(acc).alias("done"))
        more = F.struct(acc["ts"].alias("ts"), F.concat(acc["held"], F.array(s)).alias("held"), acc["done"].alias("done"))
        return F.when(is_time(s), new).otherwise(more)

    return F.aggregate(body, start, step, flushed)


def fallback(lines: Column) -> Column:
    """Text of a page without times: its lines but for menu words and "Transcript of ..."."""
    return F.array_join(F.filter(lines, lambda s: ~F.lower(s).isin(*SKIPPED) & ~F.startswith(s, F.lit("Transcript of "))), "\n")


def documents(episodes: DataFrame, retrieved_at: str, site: str, podcast_title: Column, podcast_slug: Column, keep_timestamps: bool = True, html: str = "html") -> DataFrame:
    """Source documents of fetched episode pages (episode columns and html). A page that cannot be read gives an empty text, never a failed job."""
    lined = episodes.withColumn("_lines", H.visible_lines_udf(F.col(html))).withColumn("_page_title", H.episode_title_udf(F.col(html)))
    parsed = lined.withColumn("_segments", segments(F.col("_lines")))
    timed = F.array_join(F.transform("_segments", lambda s: F.concat(F.lit("["), s["timestamp"], F.lit("] "), s["text"]) if keep_timestamps else s["text"]), "\n\n")
    body = T.clean_lines(F.when(F.size("_segments") > 0, timed).otherwise(fallback(F.col("_lines"))))
    text = parsed.withColumn("clean_text", body)
    return text.select(
        T.id_from_url(F.col("url"), site).alias("doc_id"), F.lit(site).alias("source_site"), F.lit("podcast_transcript").alias("source_type"), podcast_title.alias("podcast_title"),
        F.coalesce(F.nullif("title", F.lit("")), "_page_title").alias("title"), "url", "list_page_url", F.lit(retrieved_at).alias("retrieved_at"), F.lit("en").alias("language"), "clean_text",
        T.sha256(F.col("clean_text")).alias("content_hash"), F.lit(f"{site}_adapter_v2").alias("extraction_method"), "duration", F.lit(None).cast("string").alias("published_date"), "published_text", "description",
        F.struct(F.size("_segments").cast("bigint").alias("segment_count"), F.length("clean_text").cast("bigint").alias("text_char_count"), podcast_slug.alias("podcast_slug"),
                 F.concat(F.lit("/"), F.array_join(T.path_parts(F.col("list_page_url")), "/")).alias("podcast_path")).alias("metadata"),
    )


def segment_blocks(lines: DataFrame, doc: str, order: str, text: str) -> DataFrame:
    """The same segmentation in row form, by a running count of time lines: (doc, block, timestamp, text)."""
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = lines.withColumn("block", F.sum(is_time(F.col(text)).cast("int")).over(w)).where("block > 0")
    rest = F.sort_array(F.collect_list(F.when(~is_time(F.col(text)), F.struct(order, text))))
    return numbered.groupBy(doc, "block").agg(F.max(F.when(is_time(F.col(text)), F.col(text))).alias("timestamp"), rest.alias("_r")).select(doc, "block", "timestamp", T.collapse(F.array_join(F.transform("_r", lambda r: r[text]), " ")).alias("text")).where("text <> ''")
