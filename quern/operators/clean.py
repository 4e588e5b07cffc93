"""Cleaning of transcripts: score-based line filter, inline phrases, consecutive and exact duplicates.

Lines stay in an array of their document, so per-line work and the drop of consecutive duplicates need no
shuffle; only exact duplicates (by hash) and the reports do.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.config import CleanConfig
from quern.functions import text as T
from quern.operators import audit
from quern.storage import stored

# Phrases that speak for an advertisement, a promotion, a podcast's footer or (weakly) a brand, and labels that stand alone.
AD_START = "this episode is brought to you by|this podcast is brought to you by|support for .* comes from|sponsored by|paid for by|presented by|brought to you by"
PROMO = (
    r"promo code|use code|coupon code|free shipping|percent off|% off|\d+ percent off|terms apply|member fdic|get your quote|download .* app|"
    "go to .* dot com|visit .* dot com|available wherever books are sold|now streaming|premieres tonight|premieres .* on"
)
FOOTER = (
    "for more podcasts from|wherever you get your podcasts|wherever else you listen|apple podcasts or wherever|iheartradio app|i heart radio app|"
    "subscribe to (our|the) show|you can find us on social media|write to us at"
)
BRAND = (
    "capital one|geico|progressive|clorox|madison reed|lord jones|general motors|best fiends|best beans|abc|hulu|audible|ibm|gm dot com|dunkin|"
    "state farm|allstate|stitcher premium"
)
NOISE = "copy link to transcript|audio transcription by|transcribed from audio to text by|about us|contact us|privacy|terms|request podcast"
INLINE = (r"\s*Episode description\s+.*$", r"\s*Learn more about your ad[- ]choices? at\s+\S+", r"\s*Learn more about your ad choices at\s+\S+")

#: (name, points, phrases) in the order in which reasons are named.
RULES = (("ad_start_phrase", 3, AD_START), ("promo_phrase", 2, PROMO), ("podcast_footer", 2, FOOTER), ("weak_brand", 1, BRAND))
URL_POINTS, REMOVE, LONG, CERTAIN = 2, 3, 2500, 5


def without_timestamp(line: Column) -> Column:
    return T.strip(F.regexp_replace(line, r"(?U)^\[\d{1,2}:\d{2}:\d{2}\]\s*", ""))


def without_inline(line: Column, pattern: str) -> Column:
    """A stripped line without what an inline pattern matches. Few lines hold the words that every match begins with."""
    words = re.match(r"\\s\*([A-Za-z ]+)", pattern)[1].strip().lower()
    return F.when(F.lower(line).contains(words), T.strip(F.regexp_replace(line, f"(?isU){pattern}", ""))).otherwise(line)


def _inline_step(pattern: str):
    return lambda line: without_inline(line, pattern)


def _anchors(phrases: str) -> list[str]:
    """For each of the phrases the longest piece of it that stands in every text it matches."""
    parts = re.split(r"\|(?![^(]*\))", phrases)
    return sorted({max((p.strip() for p in re.split(r"\.\*|\\d\+|\(.*?\)", part)), key=len) for part in parts})


def _speaks(low: Column, phrases: str) -> Column:
    """Whether a lower-cased line holds one of the phrases as words. Plain searches come first: nearly all lines hold none of the anchors."""
    some = functools.reduce(lambda a, b: a | b, [low.contains(k) for k in _anchors(phrases)])
    return F.when(some, low.rlike(rf"\b({phrases})\b")).otherwise(False)


def signs(bare: Column) -> Column:
    """What a line without its timestamp shows: a struct of one flag for each rule, so that each pattern is tried once."""
    low = F.lower(bare)
    rules = [_speaks(low, phrases).alias(name) for name, _, phrases in RULES]
    urls = F.when(low.contains("http"), F.regexp_count(low, F.lit(r"https?://\S+")) >= 2).otherwise(False).alias("url_heavy")
    return F.struct((bare == "").alias("empty"), low.rlike(f"^({NOISE})$").alias("noise"), *rules, urls, F.length(bare).alias("length"))


def score_of(s: Column) -> Column:
    points = [F.when(s[name], p).otherwise(0) for name, p, _ in RULES] + [F.when(s["url_heavy"], URL_POINTS).otherwise(0)]
    return sum(points[1:], points[0])


def reason_of(s: Column) -> Column:
    """Why a line with these signs is removed, null if it stays."""
    names = F.concat_ws("+", *[F.when(s[name], F.lit(name)) for name, _, _ in RULES], F.when(s["url_heavy"], F.lit("url_heavy")))
    remove = ((score_of(s) >= REMOVE) & (s["length"] <= LONG)) | (score_of(s) >= CERTAIN)
    return F.when(s["empty"], F.lit("empty_block")).when(s["noise"], F.lit("standalone_noise")).when(remove, names)


def cleaned(docs: DataFrame, text: str = "clean_text", config: CleanConfig = CleanConfig()) -> DataFrame:
    """``docs`` with ``cleaned_text`` and ``cleaning``, the statistics of each document. Null text counts as empty; repeated rows and other columns pass through.

    removed_chars here is normalized minus cleaned characters; consecutive duplicates are counted on their own and are no removed blocks.
    """
    # Each step is an array of its own: nothing is computed twice.
    step = docs.withColumn("_l0", T.normalized_lines(F.col(text)))
    for i, pattern in enumerate(INLINE):
        step = step.withColumn(f"_l{i + 1}", F.transform(f"_l{i}", _inline_step(pattern)))
    last = f"_l{len(INLINE)}"
    step = step.withColumn("_bare", F.transform(last, without_timestamp)).withColumn("_signs", F.transform("_bare", signs))
    step = step.withColumn("_reasons", F.transform("_signs", lambda s, i: F.when(F.get(last, i) == "", F.lit("empty_after_inline_clean")).otherwise(reason_of(s))))
    rows = F.transform(last, lambda x, i: F.struct(x.alias("text"), T.collapse(F.lower(F.get("_bare", i))).alias("key"), F.get("_reasons", i).alias("reason")))
    kept = step.withColumn("_rows", rows).withColumn("_kept", F.filter("_rows", lambda x: x["reason"].isNull()))
    # Equal keys in a row share one key, so looking at the line before is looking at the last one kept.
    alone = kept.withColumn("_alone", F.filter("_kept", lambda x, i: (i == 0) | (x["key"] != F.get("_kept", i - 1)["key"])))
    out = alone.withColumn("cleaned_text", T.strip(F.array_join(F.transform("_alone", lambda x: x["text"]), "\n")))
    out = out.withColumn("_fired", F.filter("_reasons", lambda r: r.isNotNull())).withColumn("_chars", F.length(F.array_join("_l0", "\n")))
    histogram = F.map_from_entries(F.transform(F.array_sort(F.array_distinct("_fired")), lambda r: F.struct(r, F.size(F.filter("_fired", lambda s: s == r)).cast("bigint"))))
    changed = [F.size(F.filter(F.zip_with(f"_l{i}", f"_l{i + 1}", lambda x, y: x != y), lambda c: c)) for i in range(len(INLINE))]
    stats = F.struct(
        F.lit(config.version).alias("cleaning_version"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("bigint").alias("original_chars"),
        F.col("_chars").cast("bigint").alias("normalized_chars"),
        F.length("cleaned_text").cast("bigint").alias("cleaned_chars"),
        F.greatest(F.lit(0), F.col("_chars") - F.length("cleaned_text")).cast("bigint").alias("removed_chars"),
        F.size("_fired").cast("bigint").alias("removed_blocks"),
        sum(changed[1:], changed[0]).cast("bigint").alias("removed_inline_phrases"),
        (F.size("_kept") - F.size("_alone")).cast("bigint").alias("removed_consecutive_duplicate_blocks"),
        histogram.alias("remove_reasons"),
    )
    # A generator, since filters on the result would otherwise be pushed below and repeat all the work inside themselves.
    out = out.withColumn("_stats", stats).withColumnRenamed("cleaned_text", "_text")
    out = out.select("*", F.inline(F.array(F.struct(F.col("_text").alias("cleaned_text"), F.col("_stats").alias("cleaning"))))).drop("_text", "_stats")
    return out.drop(*[f"_l{i}" for i in range(len(INLINE) + 1)], "_bare", "_signs", "_reasons", "_rows", "_kept", "_alone", "_fired", "_chars")


def decided(docs: DataFrame, order: list[str], config: CleanConfig = CleanConfig()) -> DataFrame:
    """Cleaned documents with ``content_hash_clean`` and ``skip_reason`` (null: written): too short first, then all but the first, in ``order``, of equal texts.

    What was cleaned is stored once; firsts are found on the stored keys and hashes by an aggregate (partial before the shuffle), and told apart by
    their keys in ``order``, which no two rows should share: so neither a text that many documents share nor all the short ones meet in one task.
    """
    hashed = docs.withColumn("content_hash_clean", T.sha256(F.col("cleaned_text")))
    short = F.when(F.length("cleaned_text") < config.min_chars, F.lit("too_short_after_cleaning"))
    if not config.dedupe:
        return hashed.withColumn("skip_reason", short)
    hashed = stored(hashed.withColumn("_short", short), "cleaned")
    firsts = hashed.where("_short is null").groupBy("content_hash_clean").agg(F.min(F.struct(*order)).alias("_first")).select(*[F.col(f"_first.`{c}`").alias(f"_o{i}") for i, c in enumerate(order)], F.lit(True).alias("_is_first"))
    same = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_o{i}")) for i, c in enumerate(order)])
    joined = hashed.join(firsts, same, "left").withColumn("skip_reason", F.coalesce("_short", F.when(F.col("_is_first").isNull(), F.lit("duplicate_clean_content_hash"))))
    return joined.drop("_short", "_is_first", *[f"_o{i}" for i in range(len(order))])


def rewritten(docs: DataFrame, text: str = "clean_text") -> DataFrame:
    """Written documents in the shape of the input: text and hash replaced, the old hash (if any) and the statistics kept in metadata; unknown columns pass through."""
    old = F.when(F.coalesce(F.col("content_hash"), F.lit("")) != "", F.col("content_hash"))
    out = docs.where("skip_reason is null").withColumn("metadata", F.col("metadata").withField("source_content_hash", old).withField("cleaning", F.col("cleaning")))
    out = out.withColumn(text, F.col("cleaned_text")).withColumn("content_hash", F.col("content_hash_clean")).withColumn("cleaning_method", F.col("cleaning.cleaning_version"))
    return out.drop("cleaned_text", "cleaning", "content_hash_clean", "skip_reason")


def report(docs: DataFrame) -> DataFrame:
    """Report rows: characters before and after, the hash of the cleaned text; removed_chars here is original minus cleaned."""
    c = F.col("cleaning")
    return docs.withColumn("cleaned_hash", F.col("content_hash_clean")).withColumn("removed_chars", F.greatest(F.lit(0), c["original_chars"] - c["cleaned_chars"])).withColumn("original_chars", c["original_chars"]).withColumn("cleaned_chars", c["cleaned_chars"])


def _written(rows: DataFrame) -> DataFrame:
    """Rows of documents that were written; rows that do not tell are all taken."""
    return rows.where("skip_reason is null") if "skip_reason" in rows.columns else rows


def largest_reductions(rows: DataFrame, order: list[str], n: int = 200) -> DataFrame:
    """The n written rows that lost most characters; ties earliest first. Skipped documents are in no ranking."""
    return _written(rows).orderBy(F.desc("removed_chars"), *order).limit(n)


def shortest_written(rows: DataFrame, order: list[str], n: int = 200) -> DataFrame:
    """The n written rows with the fewest characters left; ties earliest first."""
    return _written(rows).orderBy("cleaned_chars", *order).limit(n)


def written_by(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """(key, documents_written), most first; equal counts in the order in which the keys first come."""
    return audit.counts_by(rows.where("skip_reason is null").withColumn("_order", order), key, "_order").withColumnRenamed("n", "documents_written")


def reason_histogram(docs: DataFrame) -> DataFrame:
    """(reason, n) over all documents, skipped ones included."""
    return docs.select(F.explode("cleaning.remove_reasons").alias("reason", "n")).groupBy("reason").agg(F.sum("n").alias("n"))


def summary(docs: DataFrame) -> DataFrame:
    """One row: documents seen, written, skipped, mean characters over all seen, totals of removals. Null means of an empty table."""
    c = F.col("cleaning")
    return docs.agg(
        F.count("*").alias("docs_seen"), F.count_if(F.col("skip_reason").isNull()).alias("docs_written"), F.count_if(F.col("skip_reason").isNotNull()).alias("docs_skipped"),
        F.count_if(F.col("skip_reason") == "too_short_after_cleaning").alias("too_short"), F.count_if(F.col("skip_reason") == "duplicate_clean_content_hash").alias("duplicates"),
        F.avg(c["original_chars"]).alias("avg_original_chars"), F.avg(c["cleaned_chars"]).alias("avg_cleaned_chars"),
        F.coalesce(F.sum(c["removed_blocks"]), F.lit(0)).alias("removed_blocks"), F.coalesce(F.sum(c["removed_inline_phrases"]), F.lit(0)).alias("removed_inline_phrases"),
    )


def rounded(report: DataFrame, digits: int = 1) -> DataFrame:
    """A report with its means rounded half to even, as reports are written; comparisons should use the unrounded ones."""
    return report.select(*[F.bround(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in report.dtypes])


def consecutive_duplicates(lines: DataFrame, keys: list[str], order: str, key: str) -> DataFrame:
    """The same drop in row form: lines whose key equals that of the line before in their document."""
    return lines.withColumn("_before", F.lag(key).over(Window.partitionBy(*keys).orderBy(order))).where(F.col(key) == F.col("_before")).drop("_before")
