from pyspark.sql import functions as F

from quern.config import CleanConfig
from quern.operators import clean


def reason(spark, *lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, l string")
    rows = df.select("i", clean.signs(clean.without_timestamp(F.col("l"))).alias("s")).select("i", clean.reason_of(F.col("s")).alias("r"), clean.score_of(F.col("s")).alias("n")).orderBy("i").collect()
    return [(r.r, r.n) for r in rows]


def test_line_filter(spark):
    got = reason(
        spark,
        "[00:00:01] This episode is brought to you by Acme.",
        "I love Hulu and you can find us on social media",
        "use code SAVE today",
        "20% off, wherever you get your podcasts",
        "20 % off, wherever you get your podcasts",
        "Visit http://a.co and http://b.co",
        "Hulu: http://a.co and http://b.co",
        "[00:00:09]",
        "Privacy",
        "use code X " + "a" * 2489 + " hulu",
        "brought to you by X, use code Y " + "b" * 3000,
    )
    assert [r for r, _ in got] == [
        "ad_start_phrase", "podcast_footer+weak_brand", None, "promo_phrase+podcast_footer", None, None, "weak_brand+url_heavy", "empty_block", "standalone_noise", None, "ad_start_phrase+promo_phrase",
    ]
    assert got[0][1] == 3 and got[2][1] == 2


def cleaned(spark, *texts):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, clean_text string")
    return clean.cleaned(df).orderBy("i").collect()


def test_document(spark):
    text = "[00:00:01] Hello  there\r\n\n[00:00:05] brought to you by Acme\n[00:00:09] hello there\n[00:00:10] Learn more about your ad-choices at x.com\nＦｕｌｌ line two"
    row, empty, null = cleaned(spark, text, "", None)
    assert row.cleaned_text == "[00:00:01] Hello there\nFull line two"
    c = row.cleaning
    assert (c.removed_blocks, c.removed_inline_phrases, c.removed_consecutive_duplicate_blocks) == (2, 1, 1)
    assert c.remove_reasons == {"ad_start_phrase": 1, "empty_block": 1}
    assert c.original_chars == len(text) and c.removed_chars == c.normalized_chars - c.cleaned_chars
    assert empty.cleaned_text == null.cleaned_text == "" and null.cleaning.remove_reasons == {}


def test_inline_only_line(spark):
    (row,) = cleaned(spark, "Learn more about your ad choices at x.com\nEpisode description and all the rest")
    assert row.cleaned_text == "" and row.cleaning.remove_reasons == {"empty_after_inline_clean": 2} and row.cleaning.removed_inline_phrases == 2


def test_unicode_spaces_and_line_ends(spark):
    (row,) = cleaned(spark, "a\x0bb\x0cc\x1cd\x85e f　\n  g\t\th ")
    assert row.cleaned_text.split("\n") == ["a", "b", "c", "d", "e", "f", "g h"]


def test_dedupe_after_length(spark):
    df = spark.createDataFrame([(3, "x" * 5), (1, "x" * 5), (2, "x"), (4, "x"), (5, "y" * 6)], "i int, cleaned_text string")
    got = {r.i: r.skip_reason for r in clean.decided(df, ["i"], CleanConfig(min_chars=3)).collect()}
    assert got == {1: None, 3: "duplicate_clean_content_hash", 2: "too_short_after_cleaning", 4: "too_short_after_cleaning", 5: None}
    off = clean.decided(df, ["i"], CleanConfig(min_chars=3, dedupe=False))
    assert off.where("skip_reason is null").count() == 3


def test_rewrite_keeps_unknown_columns(spark):
    df = spark.sql("select 1 as i, 'old' as content_hash, 'keep' as other, 'a b' as clean_text, named_struct('podcast_slug', 's') as metadata")
    row = clean.rewritten(clean.decided(clean.cleaned(df), ["i"], CleanConfig(min_chars=1))).first()
    assert row.other == "keep" and row.metadata.source_content_hash == "old" and row.metadata.cleaning.cleaned_chars == 3 and row.metadata.podcast_slug == "s"
    assert row.content_hash != "old"


def test_empty_table(spark):
    df = spark.createDataFrame([], "i int, clean_text string")
    out = clean.decided(clean.cleaned(df), ["i"])
    assert out.count() == 0 and clean.summary(out).first().docs_seen == 0


def test_tie_orders(spark):
    from quern.operators import audit

    df = spark.createDataFrame([(1, 5), (2, 5), (3, 7)], "i int, chars int")
    assert [r.i for r in audit.shortest(df, "chars", ["i"], 2).collect()] == [1, 2]
    assert [r.i for r in audit.longest(df, "chars", ["i"], 2).collect()] == [3, 2]
    assert [r.i for r in clean.largest_reductions(df.withColumnRenamed("chars", "removed_chars"), ["i"], 2).collect()] == [3, 1]
