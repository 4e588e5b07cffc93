"""Problem 10: pages made of repeated keywords, links or product and tag lists instead of sentences.

Method: an n-gram model over function words and word classes, trained on prose. A text becomes a sequence of
function words (words that stand in many texts of a language), classes of other words (how they are written, whether
they came before in the text, how long the run without a function word is), links, tags, numbers and
punctuation. The model is a smoothed trigram model of texts that read as prose; a text whose windows have, at
the median (by characters), a perplexity far above or far below that of prose is flagged, so a sentence in front does not save it.

Function words are counted over all distinct texts; trigrams are counted over all texts that read as prose, and the bounds of prose are taken from
them all. Tasks add up their own counts, and only sums of class trigrams reach the driver. Every text is counted and scored whole.

A language with fewer than ``OF_LANGUAGE`` distinct texts in the whole collection shows no function words. Its texts are judged by a second model of the
same kind that knows no language: all words are classes, by writing and repetition, and marks that stand for one another are one. A text whose
language is not told must be abnormal by both. So an honest text is not flagged because its language is rare; of spam in rare
languages only what shows in any language is found: links, tags, repeated words, lists full of marks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import stored

WINDOW, LEAST, SMOOTH = 20, 12, 20.0
#: A word of this share of a language's distinct texts is a function word; languages with fewer texts show none.
COMMON, OF_LANGUAGE = 0.25, 15
#: The texts whose perplexity makes the bounds: these quantiles of all prose.
LOWEST, HIGHEST = 0.001, 0.999
#: Most repeated texts that are broadcast.
BROADCAST = 1_000_000
#: Prose: least share of function words among words, most of repeated other words and of links among tokens.
FUNCTION, REPEATED, LINKED = 0.29, 0.15, 0.03
#: A text is abnormal this many nats a token above the top, or at this part of the bottom, of prose.
ABOVE, BELOW = 1.3, 1 / 3

_TOKEN = regex.compile(r"https?://\S+|www\.\S+|#[\p{L}\p{N}_]+|\p{Hiragana}|\p{Han}|\p{Katakana}+|[\p{L}\p{M}]+(?:['’]\p{L}+)*|\p{N}+(?:[:.,]\p{N}+)*|\n+|\t|\S")
_IDEOGRAPH = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_LINKS = ("U", "U1", "U3", "#", "#1", "#3")


#: Marks that stand for one another where no language is known.
_ALIKE = {**dict.fromkeys(".!?…。！？", "."), **dict.fromkeys(",;、，；", ","), **dict.fromkeys("\"“”„«»「」『』'’‘", '"')}


def tokens(text: str) -> list[str]:
    """Words, single ideographs, numbers, links, tags and marks of a text."""
    return _TOKEN.findall(text)


def _base(token: str, function: frozenset[str] | None) -> tuple[int, str, str]:
    """(kind, class, key): 0 a function word, 1 another word, 2 a link or tag, 3 anything else; key counts repetitions. ``function`` None: no language is known."""
    first = token[0]
    if first.isalpha() and not token.startswith(("http://", "https://", "www.")):
        word = token.lower()
        if function is None:
            ideograph = _IDEOGRAPH.match(first) is not None
            return 4, "\x00C" if first.isupper() and not ideograph else "\x00w", "" if ideograph else word
        if word in function:
            return 0, word, word
        return 1, "\x00K" if _IDEOGRAPH.match(first) else "\x00C" if first.isupper() else "\x00w", word
    if first.isalpha() or (first == "#" and len(token) > 1):
        return (2, "#", "#") if first == "#" else (2, "U", "U")
    if function is None and first in _ALIKE:
        return 3, _ALIKE[first], ""
    return 3, "9" if first.isdigit() else first, ""


_RUN = ("", "", "", "", "", "+", "+", "+")
_AGAIN = ("", "1", "1")
_OFTEN = ("", "1", "1", *"3" * 3, *"6" * 6, *"c" * 8, "k")
_GAP = ("0", "1", "2", "3", "+")


def classes(found_tokens: list[str], function: frozenset[str] | None, known: dict[str, tuple[int, str, str]] | None = None) -> list[str]:
    """The function words and classes of a text's tokens. ``known`` keeps what was found out about tokens."""
    known = {} if known is None else known
    if len(known) > 500_000:
        known.clear()
    out, seen, run = [], {}, 0
    for token in found_tokens:
        found = known.get(token)
        if found is None:
            found = known[token] = _base(token, function)
        kind, cls, key = found
        if kind == 0:
            run = 0
            out.append(cls)
        elif kind == 3:
            # Without a language, marks tell how many words stand before them: lists have one or two.
            out.append(cls if function is not None or cls not in ".,|" else cls + _GAP[min(run, 4)])
            run = run if function is not None else 0
        else:
            k = seen.get(key, 0)
            seen[key] = k + 1
            if kind == 1:
                run += 1
                out.append(cls + (_RUN[run] if run < 8 else "=") + (_AGAIN[k] if k < 3 else "3"))
            elif kind == 4:  # short words come again in all prose
                run += 1
                out.append(cls if len(key) < 4 else cls + _OFTEN[min(k, 20)])
            else:
                out.append(cls + (_AGAIN[k] if k < 3 else "3"))
    return out


def is_prose(sequence: list[str], function: frozenset[str]) -> bool:
    """Whether a class sequence reads as prose, by shares alone: the texts the model is trained on."""
    if len(sequence) < 20:
        return False
    own = [c for c in sequence if c[0] == "\x00"]
    spoken = sum(c in function for c in sequence)
    return spoken >= FUNCTION * (spoken + len(own)) and sum(c[-1] in "13" for c in own) <= REPEATED * len(sequence) and sum(c in _LINKS for c in sequence) <= LINKED * len(sequence)


class Prose:
    """A trigram model, each order smoothed by the one below."""

    def __init__(self, function: frozenset[str] | None, trigrams: dict[tuple[str, str, str], int]):
        self.function = function
        self.counts = [Counter(), Counter(), Counter()]
        for (a, b, c), n in trigrams.items():  # a text begins after two marks, so each token ends one trigram
            self.counts[0][c] += n
            self.counts[1][b, c] += n
            self.counts[2][a, b, c] = n
        self.before = [Counter(), Counter()]
        for (a, _), n in self.counts[1].items():
            self.before[0][a] += n
        for (a, b, _), n in self.counts[2].items():
            self.before[1][a, b] += n
        self.total = sum(self.counts[0].values())
        self.kinds = len(self.counts[0]) + 50
        self.memo: dict[tuple[str, str, str], float] = {}
        self.known: dict[str, tuple[int, str, str]] = {}

    def cost(self, a: str, b: str, c: str) -> float:
        """Nats of token c after a and b."""
        key = (a, b, c)
        if key not in self.memo:
            p = (self.counts[0][c] + 0.5) / (self.total + 0.5 * self.kinds)
            p = (self.counts[1][b, c] + SMOOTH * p) / (self.before[0][b] + SMOOTH)
            p = (self.counts[2][key] + SMOOTH * p) / (self.before[1][a, b] + SMOOTH)
            if len(self.memo) > 1_000_000:
                self.memo.clear()
            self.memo[key] = -math.log(p)
        return self.memo[key]

    def level(self, sequence: list[str], sizes: list[int]) -> float | None:
        """The median over windows, weighted by their characters, of the mean cost; None for under LEAST tokens."""
        if len(sequence) < LEAST:
            return None
        s = ["^", "^", *sequence]
        memo, cost = self.memo, self.cost
        costs = np.array([memo[t] if t in memo else cost(*t) for t in zip(s, s[1:], s[2:])])
        starts = np.arange(0, max(1, len(costs) - WINDOW // 2), WINDOW)
        means = np.add.reduceat(costs, starts) / np.diff([*starts, len(costs)])
        weights = np.add.reduceat(np.array(sizes), starts)
        order = np.argsort(means)
        upto = np.cumsum(weights[order])
        return float(means[order][np.searchsorted(upto, upto[-1] / 2)])


@dataclass(frozen=True)
class Languages:
    """What all texts show of languages: the function words of each that has texts enough."""

    function: dict[str, frozenset[str]]

    @property
    def all(self) -> frozenset[str]:
        return frozenset().union(*self.function.values())


def languages(docs: DataFrame, text: str, lang: str) -> Languages:
    """Function words of every language, by document frequencies over all distinct texts: counts are added up in the tasks, and a text that stands in many rows counts once in all.

    At most the distinct words of four mean texts of each language reach the driver.
    """
    rows = docs.where(F.length(text) > 0).select(F.xxhash64(text).alias("h"), F.col(text).alias("t"), F.lower(F.substring(F.trim(lang), 1, 2)).alias("l"))
    copies = stored(rows.groupBy("h").agg(F.count("*").alias("c")).where("c > 1"), "copies")
    copies = F.broadcast(copies) if copies.count() <= BROADCAST else copies
    weighed = rows.join(copies, "h", "left").withColumn("w", 1 / F.coalesce("c", F.lit(1)))
    bare = F.regexp_replace("t", r"https?://\S+|www\.\S+|#[\p{L}\p{N}_]+", " ")
    found = F.array_distinct(F.transform(F.regexp_extract_all(bare, F.lit(r"(\p{IsHiragana}|\p{IsHan}|\p{IsKatakana}+|[\p{L}\p{M}]+(?:['’]\p{L}+)*)"), F.lit(1)), F.lower))
    each = weighed.select("l", "w", F.explode(F.array_append(found, F.lit(""))).alias("word"))  # '' stands in every text: their number
    counts = each.groupBy("l", "word").agg(F.sum("w").alias("n"))
    texts = counts.where("word = ''").where(F.col("n") >= OF_LANGUAGE - 1e-6).select(F.col("l").alias("_l"), F.col("n").alias("_texts"))
    common = counts.where("word <> ''").join(F.broadcast(texts), F.col("l").eqNullSafe(F.col("_l"))).where(F.col("n") >= COMMON * F.col("_texts") - 1e-6)
    function: dict[str, set[str]] = {r._l: set() for r in texts.collect()}
    for r in common.select("l", "word").collect():
        function[r.l].add(r.word)
    return Languages({k: frozenset(v) for k, v in function.items()})


def trigrams(docs: DataFrame, text: str, function: frozenset[str]) -> DataFrame:
    """(free, a, b, c, n): how often each trigram of classes stands in the texts that read as prose, with function words and (``free``) without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[dict, dict] = ({}, {})
        counts = Counter(), Counter()

        def emit() -> Iterator[pa.RecordBatch]:
            for free, count in enumerate(counts):
                keys = list(count)
                for at in range(0, len(keys), 50_000):
                    some = keys[at : at + 50_000]
                    columns = [pa.array(x, pa.string()) for x in zip(*some)]
                    yield pa.RecordBatch.from_arrays([pa.array([bool(free)] * len(some)), *columns, pa.array([count[k] for k in some], pa.int64())], ["free", "a", "b", "c", "n"])
                count.clear()

        for batch in batches:
            for t in batch.column(0).to_pylist():
                found = tokens(t) if t else []
                sequence = classes(found, function, known[0])
                if is_prose(sequence, function):
                    for count, s in zip(counts, (sequence, classes(found, None, known[1]))):
                        s = ["^", "^", *s]
                        count.update(zip(s, s[1:], s[2:]))
            if sum(map(len, counts)) > 1_000_000:
                yield from emit()
        yield from emit()

    made = docs.select(F.col(text).alias("text")).mapInArrow(run, "free boolean, a string, b string, c string, n bigint")
    return made.groupBy("free", "a", "b", "c").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str, lang: str) -> tuple[Prose, Prose, frozenset[str]]:
    """The model of the collection's prose, the one without languages, and the languages that have function words. Of a table without prose the models know nothing."""
    known = languages(docs, text, lang)
    counts: tuple[dict, dict] = ({}, {})
    for r in trigrams(docs, text, known.all).toLocalIterator():
        counts[r.free][r.a, r.b, r.c] = r.n
    return Prose(known.all, counts[0]), Prose(None, counts[1]), frozenset(k for k in known.function if k)


def levels(docs: DataFrame, ident: str, text: str, lang: str) -> DataFrame:
    """(id, told, prose, level, free): of every text with LEAST tokens its level under both models (``free``: without languages; only where it is asked for, and for prose), and whether its language has function words (null: not told)."""
    model, free, known = fit(docs, text, lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, l in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                told = None if not l else l in known
                found = tokens(t) if t else []
                sequence, sizes = classes(found, model.function, model.known), [len(x) for x in found]
                level = model.level(sequence, sizes)
                prose = level is not None and is_prose(sequence, model.function)
                out.append((told, prose, level, free.level(classes(found, None, free.known), sizes) if level is not None and (prose or not told) else None))
            told, prose, level, other = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(told, pa.bool_()), pa.array(prose, pa.bool_()), pa.array(level, pa.float64()), pa.array(other, pa.float64())], ["id", "told", "prose", "level", "free"])

    kind = docs.schema[ident].dataType.simpleString()
    rows = docs.select(F.col(ident).alias("id"), F.col(text).alias("text"), F.lower(F.substring(F.trim(lang), 1, 2)).alias("lang"))
    return rows.mapInArrow(run, f"id {kind}, told boolean, prose boolean, level double, free double").where("level is not null")


def flag(docs: DataFrame, ident: str, text: str, lang: str) -> DataFrame:
    """(ident): the documents whose text is keyword, link, product or tag spam; repeated rows each.

    Null, empty and blank texts and those of under LEAST tokens are not. ``lang`` (null and any case allowed) tells
    whose function words a text may have. Other columns are ignored. A collection without any prose has no bounds: nothing is flagged.
    """
    scored = stored(levels(docs, ident, text, lang), "levels")
    prose = scored.where("prose")
    bound = lambda c: [F.percentile_approx(c, q, 100_000) for q in (LOWEST, HIGHEST)]
    low, high, free_low, free_high = prose.agg(*[b.alias(f"b{i}") for i, b in enumerate(bound("level") + bound("free"))]).first()
    if low is None:
        return scored.limit(0).select(F.col("id").alias(ident))
    abnormal = ~F.col("level").between(low * BELOW, high + ABOVE)
    outside = lambda above, below: F.coalesce(~F.col("free").between(free_low * below, free_high + above), F.lit(False))
    abnormal_free = outside(ABOVE, BELOW)
    # Where both must say so, a smaller margin is enough for the second.
    spam = F.when(F.col("told").isNull(), abnormal & outside(ABOVE / 4, (1 + 2 * BELOW) / 3)).when(F.col("told"), abnormal).otherwise(abnormal_free)
    return scored.where(spam).select(F.col("id").alias(ident))
