"""Problem 5: the main body of a page's text, without the menus, notices and side lists around it.

Method: tree scoring. Lines are the paragraphs of a tree: neighbouring lines of like link density form a container, the containers
of a text its body. A line's points, for its length and its commas, go to its container in full and to the body by half, and every node's points are
discounted by its link density. The container with the most points is the best; it and its siblings are kept that score well for their
size or are prose by their density, and a kept container keeps its lines but those that are clearly links.

Flattened text has no link tags, so a line's link density is estimated, and no list of phrases is used for it. A transcript tells
what belongs to it: its lines carry times, while nearly all that the page adds carries none. So the words of lines without times in
transcripts that have times tell how page text reads, wherever else such words stand. Counts of words and pairs of words with and without times, and
what a line looks like (its end, separators, addresses, length, capitals), go into a logistic regression that is trained on that label
and corrected for its errors: the shares of spoken lines without, and of page lines with a time. Its estimate, with the line's own time where the text has times, is the density.

The estimate is fitted on ``sample`` texts of at most LONGEST characters by hash of their ids (a bounded sample, labelled by their times); every text is judged whole. A collection without times
gives no such labels: then only how lines look counts.
"""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import sampled

#: Texts the estimate is fitted on, and the characters of the longest of them.
SAMPLE, LONGEST = 4_000, 20_000
#: A text has times if this share of its lines has one.
TIMED = 0.5
#: Least count of a word or pair, and the weight of the mean in its share.
SEEN, SMOOTH = 3, 2.0
#: Densities from which a line of a kept container is dropped, up to which a line of another one is kept, and the share of the best container's points a line that a good sibling has.
LINKED, PROSE, SIBLING = 0.5, 0.2, 0.2
#: Points that a container's density has in that of each of its lines.
SHARED = 1.0
#: Neighbouring lines whose densities differ by more are of two containers.
STEP = 0.6

_L = r"[^\W\d_]"
_TIME = re.compile(r"^\s*[\[(<]?\s*\d{1,3}:\d{2}(?::\d{2})?(?:[.,]\d+)?\s*(?:-->\s*\d{1,3}:\d{2}(?::\d{2})?(?:[.,]\d+)?\s*)?[\])>]?(?!\s*/)(?=\s|$|[-–:])\s*[-–]?\s*")
_URL = re.compile(r"(?:https?://|www\.)\S+|\b[\w-]+\.(?:com|org|net|example)(?:/\S*)?")
_MENU = re.compile(r"\S\s*[|•·›»‹«]\s*\S|^\s*[‹«›»|•·]|[‹«›»|•·]\s*$|\S\s{2,}\S.*\S\s{2,}\S|\s/\s")
_DURATION = re.compile(r"(?:\(\d{1,3}:\d{2}(?::\d{2})?\)|\b\d{1,3} min)\s*$|^\d{1,2}:\d{2}\s*/\s*\d")
_NOTE = re.compile(r"[\[(<{][^\])>}]{0,60}[\])>}]|\*[^*]{1,60}\*|♪[^♪]{0,60}♪")
_LABEL = re.compile(rf"^[\s>*-]*[\[(<*]{{0,2}}{_L}[\w.'’-]*(?:,?\s+{_L}[\w.'’-]*){{0,3}}(?:\s*\((?:{_L}|-)+\))?[\])>]?\s?(?:[:：]|\s[-–—](?=\s|$)|(?<=[\])>]))\*{{0,2}}")
_WORD = re.compile(rf"{_L}+")


_ENDS = frozenset(".!?…。！？—–:：-")
_SIGN = re.compile(r"[:：\-–—\])>]")
_GATE = re.compile(r"[|•·›»‹«]|\s\s|\s/\s")
_OPENS = re.compile(r"[\[(<{*♪]")
LOOKS = 13


def ends(line: str) -> bool:
    """Whether a line ends as a sentence or a label does."""
    return line.rstrip(" \t\r\n\u00a0\"'”’)]*")[-1:] in _ENDS if line[-1:] not in _ENDS else True


def is_mark(line: str) -> bool:
    """Whether a line is nothing but notes in brackets, or marks without any word."""
    if _OPENS.search(line) is None:
        return not any(c.isalnum() for c in line)
    return not any(c.isalpha() for c in _NOTE.sub("", line)) and (not any(c.isdigit() for c in line) or _NOTE.search(line) is not None)


def looks(line: str, found: list[str]) -> tuple[list[float], bool]:
    """What a line looks like, without regard to its words (``found``, as they are written), and whether it is a phrase as lists and menus have them."""
    n = len(found)
    stops = ends(line)
    marks = (n < 4 or line[0] in "[(<{*♪>-") and is_mark(line)
    label = not marks and _SIGN.search(line, 0, 64) is not None and _LABEL.match(line) is not None
    phrase = not (stops or label or marks)
    bare = phrase and 0 < n <= 8
    urls = sum(len(_WORD.findall(m)) for m in _URL.findall(line)) if "://" in line or "www." in line or ".com" in line or ".org" in line or ".net" in line or ".example" in line else 0
    duration = (line[-1:] == ")" or "/" in line or line.rstrip().endswith("min")) and _DURATION.search(line) is not None
    size = math.log1p(n)
    return [
        float(stops), float(_GATE.search(line) is not None and _MENU.search(line) is not None), min(urls / n, 1.0) if n else 0.0, float(duration), float(label), size, float(marks and n > 0),
        float(bare), float(n == 0 and any(c.isdigit() for c in line)), (line.count(",") + line.count("，") + line.count("、")) / (n + 1), sum([w[0].isupper() for w in found]) / n if n else 0.0, bare * size, float(phrase),
    ], phrase


def grams(found: list[str]) -> set:
    """The words and pairs of words of a line, its ends included."""
    return {*found, *zip(["", *found], [*found, ""])}


class Lines:
    """What tells page lines from spoken ones: shares of words and pairs, weights, and how often spoken lines lack, and page lines have a time."""

    def __init__(self, shares: dict, mean: float, weights: np.ndarray, lacks: float, untimed: float):
        self.shares, self.mean, self.weights, self.lacks, self.untimed = shares, mean, weights, lacks, untimed
        self.flat = weights.tolist()
        self.memo: dict[str, tuple[float, bool, float]] = {}

    @staticmethod
    def plain() -> "Lines":
        """What is known without any labels: how menus, addresses and bare phrases look."""
        weights = np.zeros(1 + 4 + LOOKS)
        weights[0] = -1.0
        weights[5:] = -1.5, 3.0, 4.0, 2.5, -2.0, -0.4, -2.0, 2.0, 3.0, -1.0, 1.0, 0.0, 0.0
        return Lines({}, 0.2, weights, 0.0, 1.0)

    @staticmethod
    def features(line: str, shares: dict, mean: float, own: tuple[bool, dict] | None = None) -> tuple[list[float], bool]:
        """Of a line: the mean, highest and lowest shares of its words and pairs, whether any is known, and its looks; and whether it is a phrase. ``own``: its label and all counts, which then do not count the line itself."""
        written = _WORD.findall(line)
        found = [w.lower() for w in written]
        if own is None:
            get = shares.get
            known = [x for x in map(get, found) if x is not None] + [x for x in map(get, zip(["", *found], [*found, ""])) if x is not None]
        else:
            label, counts = own
            known = [(u - label + SMOOTH * mean) / (u + t - 1 + SMOOTH) for u, t in map(counts.__getitem__, [*found, *zip(["", *found], [*found, ""])]) if u + t > SEEN]
        looked, phrase = looks(line, written) if line else ([0.0] * LOOKS, False)
        if known:
            known.sort()
            high, low = known[-3:], known[:3]
            return [1.0, sum(known) / len(known), sum(high) / len(high), sum(low) / len(low), 1.0, *looked], phrase
        return [1.0, mean, mean, mean, 0.0, *looked], phrase

    @staticmethod
    def fit(texts: list[str]) -> "Lines":
        lines: list[tuple[str, bool]] = []
        for text in texts:
            some = split(text)[1:]
            if len(some[0]) >= 5 and np.mean(some[1]) >= TIMED:
                lines += zip(some[0], (not t for t in some[1]))
        labels = np.array([u for _, u in lines], float)
        if len(lines) < 200 or not 0.01 < labels.mean() < 0.9:
            return Lines.plain()
        without, with_ = Counter(), Counter()
        for line, label in lines:
            (without if label else with_).update(grams([w.lower() for w in _WORD.findall(line)]))
        mean = float(labels.mean())
        counts = {g: (without[g], with_[g]) for g in without.keys() | with_.keys()}
        x = np.array([Lines.features(line, {}, mean, (bool(label), counts))[0] for line, label in lines])
        weights = _logistic(x, labels)
        q = 1 / (1 + np.exp(-x @ weights))
        order = np.argsort(q)
        lacks, untimed = labels[order[: len(q) // 2]].mean(), labels[order[-max(len(q) // 20, 1) :]].mean()
        shares = {g: (u + SMOOTH * mean) / (u + t + SMOOTH) for g, (u, t) in counts.items() if u + t >= SEEN}
        return Lines(shares, mean, weights, float(np.clip(lacks, 0.001, 0.4)), float(np.clip(untimed, 0.6, 0.999)))

    def judged(self, line: str) -> tuple[float, bool, float]:
        """Of a line without its time: the chance, by its words and looks, that it is of the page; whether it is a phrase; and its points."""
        found = self.memo.get(line)
        if found is None:
            if len(self.memo) > 100_000:
                self.memo.clear()
            values, phrase = self.features(line, self.shares, self.mean)
            q = 1 / (1 + math.exp(-max(min(sum(map(operator.mul, values, self.flat)), 30.0), -30.0)))
            share = min(max((q - self.lacks) / (self.untimed - self.lacks), 0.002), 0.998)
            # Words that nearly always, or nearly never, lack a time are surer signs than one line's chance.
            found = self.memo[line] = (share**2 / (share**2 + (1 - share) ** 2), phrase, points(line))
        return found

    def densities(self, p: np.ndarray, timed: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The estimated link density of every line: its chance ``p``, with its own time where its text (``doc``) has times."""
        if not self.shares or not len(p):
            return p
        lines = np.bincount(doc)
        has = (np.bincount(doc, timed) >= TIMED * lines) & (lines >= 5)
        odds = p / (1 - p) * np.where(timed, (1 - self.untimed) / (1 - self.lacks), self.untimed / self.lacks)
        return np.where(has[doc], odds / (1 + odds), p)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 12, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - ridge * w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
    return w


def split(text: str) -> tuple[list[int], list[str], list[bool]]:
    """(places, lines without their times, whether they have one) of the lines that are not blank."""
    full, bare, timed = [], [], []
    for i, line in enumerate(text.split("\n")):
        if line.strip():
            m = _TIME.match(line)
            full.append(i)
            timed.append(m is not None)
            bare.append(" ".join((line[m.end() :] if m else line).split(" ")).strip())
    return full, bare, timed


def points(line: str) -> float:
    """Points of a paragraph: one, one for each comma, one for each 100 characters up to three, one for a sentence's end."""
    return 1 + line.count(",") + line.count("，") + line.count("、") + min(len(line) / 100, 3) + (1 if ends(line) else 0)


def kept_lines(density: np.ndarray, point: np.ndarray, phrase: np.ndarray, size: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which lines the trees of their texts (``doc``, ascending) keep."""
    if not len(density):
        return np.zeros(0, bool)
    # Neighbouring lines of one shape are a container: sentences and what labels them, or phrases without an end as lists and menus have them.
    other = (phrase[1:] != phrase[:-1]) | (np.abs(np.diff(density)) > STEP) & ~(phrase[1:] & phrase[:-1])
    container = np.concatenate([[0], np.cumsum(other | (doc[1:] != doc[:-1]))])
    first = np.flatnonzero(np.diff(container, prepend=-1))
    of = doc[first]
    lines = np.bincount(container)
    links = np.bincount(container, point * density) / np.bincount(container, point)
    score = np.bincount(container, point * (1 - density)) * (1 - links)
    # The body gets half of all points, discounted by its own density: what a line of it is worth.
    n = np.maximum(np.bincount(doc), 1)
    body = 0.5 * np.bincount(doc, point * (1 - density)) * (1 - np.bincount(doc, size * density) / np.maximum(np.bincount(doc, size), 1)) / n
    order = np.lexsort((-score, of))
    best = order[np.flatnonzero(np.diff(of[order], prepend=-1))]
    worth = np.zeros(len(n))
    worth[of[best]] = score[best] / lines[best]
    good = (score / lines >= SIBLING * np.maximum(worth, body)[of]) & (links < LINKED) | (links < PROSE)
    good[best] = True
    # A line of few points shares its container's density.
    alone = point / (point + SHARED * (lines[container] > 1))
    joint = alone * density + (1 - alone) * links[container]
    return np.where(good[container], joint < LINKED, joint < PROSE)


def outside(texts: list[str], model: Lines) -> list[list[int]]:
    """Numbers (from 1) of the lines of each text that are not of its main body; blank lines are of neither kind."""
    places, timed, judged, size, counts = [], [], [], [], []
    for text in texts:
        full, bare, own = split(text)
        places += full
        timed += own
        judged += map(model.judged, bare)
        size += map(len, bare)
        counts.append(len(full))
    doc = np.repeat(np.arange(len(texts)), counts)
    p, phrase, point = (np.array(x) for x in zip(*judged)) if judged else (np.zeros(0), np.zeros(0, bool), np.zeros(0))
    size = np.array(size, float)
    gone = ~kept_lines(model.densities(p, np.array(timed, bool), doc), point, phrase, np.maximum(size, 1), doc) & (size > 0)
    out = (np.array(places, np.int64) + 1)[gone]
    return [x.tolist() for x in np.split(out, np.searchsorted(doc[gone], np.arange(1, len(texts))))] if texts else []


def _kernel(model: Lines, rows: int = 1_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows)):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(outside(batch.column(1).to_pylist(), model), pa.list_(pa.int64()))], ["id", "lines"])

    return run


def page_lines(docs: DataFrame, ident: str, text: str, least_words: int = 40, sample: int = SAMPLE) -> DataFrame:
    r"""(ident, line_no): the lines of each text that belong to the page around its main body.

    Lines are the pieces between ``\n``, numbered from 1. Null and empty texts and those of under ``least_words`` words
    have none. Each text is judged by itself, with a model fitted on ``sample`` texts: one pass, no shuffle. A repeated row comes out as often as it goes in.
    """
    rows = docs.select(F.col(ident).cast("bigint").alias("id"), F.col(text).alias("text"))
    model = Lines.fit(sampled(rows, sample, 200, LONGEST))
    long = rows.where(F.regexp_count("text", F.lit(r"\p{L}+")) >= least_words)
    return long.mapInArrow(_kernel(model), "id bigint, lines array<bigint>").select(F.col("id").alias(ident), F.explode("lines").alias("line_no"))
