"""Generation around a language model: rounds, source budget, prompt, appendix, output."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.config import GenerateConfig
from quern.functions import text as T


def budgeted(sources: Column, config: GenerateConfig = GenerateConfig()) -> Column:
    """The nearest ``max_sources`` sources with their texts cut to what the budget still allows; blank texts are left out.

    A text may take ``max_chars_per_source`` and the rest of ``max_source_chars``; what it takes is counted without white space at its end,
    and the headers are not counted. Sources without a distance come last; ties stay in the order given.
    """
    numbered = F.transform(sources, lambda s, i: F.struct(F.coalesce(s["distance"], F.lit(999.0)).alias("d"), i.alias("i"), s.alias("s")))
    nearest = F.slice(F.array_sort(numbered), 1, config.max_sources)
    start = F.struct(F.array().cast("array<struct<rank:int,title:string,distance:double,text:string>>").alias("out"), F.lit(0).alias("used"))

    def take(acc: Column, x: Column) -> Column:
        s = x["s"]
        room = F.lit(config.max_source_chars) - acc["used"]
        text = T.collapse(F.coalesce(s["text"], F.lit("")))
        cut = T.rstrip(F.substring(text, F.lit(1), F.least(F.lit(config.max_chars_per_source), room)))
        entry = F.struct(s["rank"].cast("int").alias("rank"), s["title"].alias("title"), s["distance"].cast("double").alias("distance"), cut.alias("text"))
        taken = F.struct(F.concat(acc["out"], F.array(entry)).alias("out"), (acc["used"] + F.length(cut)).alias("used"))
        return F.when((text == "") | (room <= 0), acc).otherwise(taken)

    return F.aggregate(nearest, start, take, lambda acc: acc["out"])


def source_block(sources: Column, config: GenerateConfig = GenerateConfig()) -> Column:
    """The sources as text for a prompt."""
    taken = budgeted(sources, config)
    each = F.transform(taken, lambda s: F.concat(F.lit("[S"), s["rank"].cast("string"), F.lit("]\ntitle: "), F.coalesce(s["title"], F.lit("")), F.lit("\ndistance: "), F.coalesce(s["distance"].cast("string"), F.lit("")), F.lit("\ntext: "), s["text"]))
    return F.when(F.size(sources) == 0, F.lit("There are no sources.")).otherwise(F.array_join(each, "\n\n"))


def messages(query: Column, rounds: Column, language: Column, coverage: Column, rewrite: Column, sources: Column, extra: Column | None = None, config: GenerateConfig = GenerateConfig()) -> Column:
    """Messages that ask a model for a dialogue of two speakers grounded in the sources."""
    system = "You write dialogues of two speakers, A and B, who discuss a question. Say nothing about facts that the numbered sources do not hold, and mark what rests on them as [S1], [S2] and so on. Do not list sources at the end."
    user = F.concat(
        F.lit("Question: "), query, F.lit("\nLanguage: "), language, F.lit("\nRounds: "), rounds.cast("string"), F.lit(" (one line of A and one of B each, "), (rounds * 2).cast("string"), F.lit(" lines in all)\nCoverage: "),
        F.to_json(coverage), F.lit("\nSearch terms: "), F.to_json(rewrite), F.lit("\nIf the coverage is weak or none, let the speakers say so.\n"), F.coalesce(extra, F.lit("")) if extra is not None else F.lit(""), F.lit("\nSources:\n"), source_block(sources, config),
    )
    return F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content")))


def as_json(message: Column) -> Column:
    """Messages as JSON text over several lines, non-ASCII kept."""
    return F.to_json(message, {"pretty": "true"})


def prompt_chars(message: Column) -> Column:
    return F.aggregate(message, F.lit(0), lambda n, m: n + F.length(m["content"]))


# The labels of the appendix's entries.
def appendix(sources: Column, excerpt: int = GenerateConfig.appendix_excerpt_chars) -> Column:
    """All sources of a pack in its order, as Markdown made from the pack and not by a model."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))

    def entry(s: Column) -> Column:
        lines = [
            F.concat(F.lit("### S"), text(s["rank"]), F.lit(". "), text(s["title"])), F.lit(""), F.concat(F.lit("- Podcast: `"), text(s["podcast_slug"]), F.lit("`")),
            F.concat(F.lit("- URL: "), F.when(text(s["url"]) != "", s["url"]).otherwise("N/A")), F.concat(F.lit("- Timestamp: "), text(s["start_timestamp"]), F.lit(" - "), text(s["end_timestamp"])),
            F.concat(F.lit("- Chunk ID: `"), text(s["chunk_id"]), F.lit("`")), F.concat(F.lit("- Doc ID: `"), text(s["doc_id"]), F.lit("`")), F.concat(F.lit("- Chunk index: `"), text(s["chunk_index"]), F.lit("`")),
            F.concat(F.lit("- Retrieval distance: `"), text(s["distance"]), F.lit("`")),
        ]
        matched = F.when(F.size(s["matched_queries"]) > 0, F.concat(F.array(F.lit("- Matched queries:")), F.transform(s["matched_queries"], lambda q: F.concat(F.lit("  - "), q)))).otherwise(F.array().cast("array<string>"))
        ends = F.array(F.lit(""), F.lit("Retrieved excerpt:"), F.lit(""), F.concat(F.lit("> "), T.preview(F.coalesce(s["text"], F.lit("")), excerpt)), F.lit(""))
        return F.array_join(F.concat(F.array(*lines), matched, ends), "\n")

    head = "\n\n## Source Appendix\n"
    some = F.concat(F.lit(head + "\nMade from the retrieved sources, not by the language model.\n\n"), F.array_join(F.transform(sources, entry), "\n"))
    return F.when(F.size(sources) == 0, F.lit(head + "\nNo sources were retrieved.\n")).otherwise(some)


def document(dialogue: Column, sources: Column, excerpt: int = GenerateConfig.appendix_excerpt_chars) -> Column:
    """A model's dialogue without source notes of its own, and the appendix."""
    return F.concat(T.without_source_notes(dialogue), appendix(sources, excerpt))
