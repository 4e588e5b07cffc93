"""Problem 2: raw transcript segments to ordered, clean speaker turns.

Method: the tokens of each segment are tagged speaker, timestamp, annotation, filler or speech by a hidden
Markov model, decoded by Viterbi, and turns are assembled from the tags. What is observed of a token is ambiguous: its shape
(word, number, hesitation, colon, dash, bracket, star, sentence end), whether it could be a part of a name or a role of the podcast's people, whether
something begins there, whether it stands in what is shaped like a label, and whether in a bracket. A bracketed word may be a
speaker or a note, a name may be spoken of, words before a colon may be no label: the states, which know how a label, a note and a
sentence go on, decide. A state emits each feature by a table of its own; the tables start from a prior and are re-estimated by Viterbi
training on a bounded sample. Speakers' labels are the stretches tagged so, and only then is it looked up whose label it is.

Tagging is per segment. Order-dependent steps (times taken from the row before, the speaker that holds, turn
numbers) are blocked scans: windows within (document, block), a scan over the few block summaries, and a join
back, so that no document, however long, is one task.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import stored

TAGS = ("speaker", "timestamp", "annotation", "filler", "speech")
#: States, and the tag of each: a label is what opens it, its first word, what follows and what closes it; a note opens, goes on and closes.
STATES = ("lead", "name", "more", "sign", "time", "open", "note", "close", "filler", "comma", "word", "mark")
TAG_OF = (0, 0, 0, 0, 1, 2, 2, 2, 3, 3, 4, 4)
LEAD, NAME, MORE, SIGN, TIME, OPEN, NOTE, CLOSE, FILL, COMMA, WORD, MARK = range(12)
#: Features of a token and their values.
KINDS = "WDTF:-.,OC*#>QP"
FEATURES = (len(KINDS), 2, 2, 2, 3, 2)  # kind, may name one of the people, begins something, shaped as a label, in a bracket (no, yes, its mark), glued to what stands before
SAMPLE = 2_000
# Hesitations, and the roles that people have.
FILLER = regex.compile(r"(?i)(?:u+h+m*|u+m+|e+rm*|h+m+|m+h+m+|a+h+)")
ROLES = ("host", "co-host", "producer", "guest")

_TOKEN = regex.compile(r"\d+(?:[:.,]\d+)+|[\p{L}\p{N}]+(?:['’-][\p{L}\p{N}]+)*|\S")
_TIME = regex.compile(r"\d{1,2}(?::\d{2}){1,2}(?:[.,]\d+)?")
_BRACKET = regex.compile(r"\(\([^()]{1,60}\)\)|\[[^\[\]]{1,60}\]|\([^()]{1,60}\)|\{[^{}]{1,60}\}|<[^<>]{1,60}>|(?<![\p{L}*])\*[^*]{1,60}\*(?!\*)|♪[^♪]{0,60}♪")
_WORDS = r"\p{L}[\p{L}.'’-]*(?:,?\s+\p{L}[\p{L}.'’-]*){0,3}?(?:\s*\([\p{L}-]{1,12}\))?"
_LEADS = r"(?:>{1,3}\s*|[-–—]\s+)?"
#: What has the shape of a label: up to four words in stars or brackets, or before a colon or a dash.
_SHAPE = regex.compile(rf"{_LEADS}(?:\*\*{_WORDS}\s*[:：]?\s*\*\*\s*[:：]?|[\[(<]\s*{_WORDS}\s*[\])>]\s*[:：]?|{_WORDS}\s*[:：](?=\s|$|\p{{P}})|{_WORDS}\s+[-–—](?=\s|$))")
_BEGIN = regex.compile(r"(?:^\s*|(?<=[.!?…—–\])}>*♪\"”'’])\s*)(?=\S)")
_SIGN = regex.compile(r"[:：\-–—\])>*]")
_KIND = {":": ":", "：": ":", "-": "-", "–": "-", "—": "-", ".": ".", "!": ".", "?": ".", "…": ".", "。": ".", "！": ".", "？": ".", ",": ",", "(": "O", "[": "O", "{": "O", "<": "O", ")": "C", "]": "C", "}": "C", ">": ">", "*": "*", "♪": "#", '"': "Q", "“": "Q", "”": "Q", "'": "Q", "’": "Q"}


def _near(a: str, b: str) -> bool:
    """At most one insertion, deletion, replacement or swap of neighbours apart."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (x[:2] == y[:2][::-1] and x[2:] == y[2:])


class People:
    """The labels of one podcast's people: names, parts of names, initials, roles that one person holds; one typing error is forgiven in names."""

    def __init__(self, people: list[tuple[int, str, str]]):
        found: dict[str, set[int]] = {}

        def add(label: str, who: int) -> None:
            found.setdefault(label, set()).add(who)

        self.long: dict[str, set[int]] = {}
        for who, name, role in people:
            parts = [p for p in regex.split(r"\s+", (name or "").strip().lower()) if p]
            if parts:
                first, last = parts[0], parts[-1]
                forms = {" ".join(parts), first, last, f"{last}, {first}", f"{first[0]}. {last}", f"{first[0]} {last}", f"{first} {last[0]}."}
                for form in forms:
                    add(form, who)
                    self.long.setdefault(form, set()).add(who)
                initials = "".join(p[0] for p in parts)
                for form in (initials, ".".join(initials), ".".join(initials) + "."):
                    add(form, who)
            if role:
                add(role.strip().lower(), who)
        self.exact = {k: next(iter(v)) for k, v in found.items() if len(v) == 1}
        self.memo: dict[str, int | None] = {}
        #: Words that may stand in a label, and whether a word may: a name spelled with an error too.
        self.words = {w for form in found for w in regex.findall(r"[\p{L}\p{N}]+(?:['’-][\p{L}\p{N}]+)*", form)} | set(ROLES)
        self.seen: dict[str, bool] = {}

    def may_be(self, word: str) -> bool:
        key = word.lower()
        if key not in self.seen:
            hit = key in self.words or len(key) >= 4 and any(abs(len(w) - len(key)) <= 1 and len(w) >= 4 and _near(key, w) for w in self.words)
            if len(self.seen) < 20_000:
                self.seen[key] = hit
            return hit
        return self.seen[key]

    def who(self, label: str) -> int | None:
        key = regex.sub(r"\s+", " ", label.strip().lower()).replace("’", "'")
        if key not in self.memo:
            hit = self.exact.get(key)
            if hit is None and len(key) >= 4 and key not in ROLES:
                near = set().union(*(v for k, v in self.long.items() if len(k) >= 4 and _near(key, k)), set())
                hit = next(iter(near)) if len(near) == 1 else None
            if len(self.memo) < 10_000:
                self.memo[key] = hit
            return hit
        return self.memo[key]


SYMBOLS = int(np.prod(FEATURES))
#: The feature values of every symbol.
_VALUES = np.stack(np.unravel_index(np.arange(SYMBOLS), FEATURES), axis=1)


@functools.lru_cache(maxsize=100_000)
def _kind(word: str) -> int:
    """What a token looks like, as its place in KINDS."""
    if word[0].isalnum():
        return KINDS.index("T" if _TIME.fullmatch(word) else "F" if FILLER.fullmatch(word) else "D" if word[0].isdigit() else "W")
    return KINDS.index(_KIND.get(word, "P"))


_LEADING = frozenset(KINDS.index(k) for k in "O*>-")
_STAR = KINDS.index("*")


def observe(text: str, people: People) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Tokens (start, end) of a segment and the symbol of each."""
    begins = {m.end() for m in _BEGIN.finditer(text)}
    shaped: list[tuple[int, int]] = []
    for s in sorted(begins):
        if _SIGN.search(text, s, s + 64) and (m := _SHAPE.match(text, s)):
            shaped.append(m.span())
    inside = [m.span() for m in _BRACKET.finditer(text)]
    tokens, symbols, last, begun, i, j, reach = [], [], -1, False, 0, 0, 0
    for m in _TOKEN.finditer(text):
        s, e = m.span()
        word = m.group()
        kind = _kind(word)
        while i < len(inside) and inside[i][1] <= s:
            i += 1
        within = 0 if i == len(inside) or s < inside[i][0] else 2 if s == inside[i][0] or e == inside[i][1] else 1
        # What opens a label begins nothing of its own.
        begun = s in begins and not (kind == _STAR and last == s) or begun and kind in _LEADING
        while j < len(shaped) and shaped[j][0] <= s:
            reach = max(reach, shaped[j][1])
            j += 1
        # The features' values as one number, in the order of FEATURES.
        symbols.append(((((kind * 2 + (kind == 0 and people.may_be(word))) * 2 + begun) * 2 + (s < reach)) * 3 + within) * 2 + (last == s))
        begun = begun and kind in _LEADING
        tokens.append((s, e))
        last = e
    return tokens, np.array(symbols, np.int64)


class Model:
    """A hidden Markov model over STATES in log space; a symbol's cost in a state is the sum over its features' tables."""

    def __init__(self, start: np.ndarray, move: np.ndarray, tables: list[np.ndarray], end: np.ndarray):
        self.start, self.move, self.tables, self.end = start, move, tables, end
        self.emit = sum(t[:, _VALUES[:, f]] for f, t in enumerate(tables))

    @staticmethod
    def prior() -> "Model":
        """What is known before: how labels, notes, hesitations and sentences are built, roughly."""
        n = len(STATES)
        kinds = np.full((n, len(KINDS)), 0.001)

        def emits(state: int, **shares: float) -> None:
            names = {"colon": ":", "dash": "-", "stop": ".", "comma": ",", "open": "O", "close": "C", "star": "*", "music": "#", "angle": ">", "quote": "Q", "other": "P"}
            for k, share in shares.items():
                kinds[state, KINDS.index(names.get(k, k))] = share

        emits(LEAD, open=0.4, star=0.2, angle=0.25, dash=0.15)
        emits(NAME, W=1.0)
        emits(MORE, W=0.7, stop=0.1, comma=0.1, open=0.05, close=0.05)
        emits(SIGN, colon=0.5, dash=0.1, close=0.2, star=0.1, angle=0.1)
        emits(TIME, T=1.0)
        emits(OPEN, open=0.8, star=0.15, music=0.05)
        emits(NOTE, W=0.85, D=0.03, F=0.02, stop=0.03, comma=0.02, other=0.05, open=0.02, close=0.02, quote=0.01, T=0.01, dash=0.02, music=0.01)
        emits(CLOSE, close=0.7, angle=0.1, star=0.15, music=0.05)
        emits(FILL, F=1.0)
        emits(COMMA, comma=0.6, stop=0.3, dash=0.1)
        emits(WORD, W=0.95, D=0.05)
        emits(MARK, stop=0.5, comma=0.3, dash=0.03, colon=0.02, quote=0.08, other=0.05, open=0.005, close=0.005, angle=0.005, star=0.005, music=0.005)
        yes = lambda **p: np.array([[1 - x, x] for x in (p.get(s, p["rest"]) for s in STATES)])
        known = yes(name=0.97, more=0.6, word=0.03, note=0.003, rest=0.01)
        begins = yes(lead=0.98, name=0.999, open=0.3, filler=0.3, word=0.08, more=0.1, sign=0.02, rest=0.05)
        shaped = yes(lead=0.97, name=0.98, more=0.98, sign=0.97, open=0.3, note=0.3, close=0.3, word=0.01, mark=0.01, rest=0.02)
        inside = np.full((n, 3), [0.9, 0.05, 0.05])
        inside[[OPEN, CLOSE]] = 0.01, 0.02, 0.97
        inside[NOTE] = 0.01, 0.97, 0.02
        inside[[LEAD, SIGN]] = 0.5, 0.05, 0.45
        inside[[NAME, MORE]] = 0.5, 0.48, 0.02
        inside[[WORD, MARK]] = 0.98, 0.01, 0.01
        glued = yes(comma=0.97, sign=0.9, close=0.9, mark=0.9, more=0.3, note=0.1, name=0.2, word=0.02, rest=0.05)
        move = np.full((n, n), 1e-6)

        def goes(state: int, to: dict[int, float]) -> None:
            for t, share in to.items():
                move[state, t] = share

        anything = {LEAD: 0.04, NAME: 0.03, TIME: 0.01, OPEN: 0.05, FILL: 0.05, WORD: 0.72, MARK: 0.1}
        goes(LEAD, {LEAD: 0.2, NAME: 0.8})
        goes(NAME, {MORE: 0.5, SIGN: 0.5})
        goes(MORE, {MORE: 0.5, SIGN: 0.5})
        goes(SIGN, {SIGN: 0.3} | {k: 0.7 * v for k, v in anything.items()})
        goes(OPEN, {OPEN: 0.05, NOTE: 0.94, CLOSE: 0.01})
        goes(NOTE, {NOTE: 0.6, CLOSE: 0.4})
        goes(CLOSE, {CLOSE: 0.05} | {k: 0.95 * v for k, v in anything.items()})
        goes(FILL, {COMMA: 0.6} | {k: 0.4 * v for k, v in anything.items()})
        goes(COMMA, {COMMA: 0.2} | {k: 0.8 * v for k, v in anything.items()})
        for state in (TIME, WORD, MARK):
            goes(state, anything)
        start = np.full(n, 1e-6)
        start[[LEAD, NAME, TIME, OPEN, FILL, WORD, MARK]] = 0.2, 0.25, 0.02, 0.08, 0.05, 0.39, 0.01
        end = np.zeros(n)
        end[[LEAD, NAME, MORE, OPEN, NOTE]] = -12.0  # what is begun is closed
        log = lambda x: np.log(x / x.sum(-1, keepdims=True))
        return Model(log(start), log(move), [log(t) for t in (kinds, known, begins, shaped, inside, glued)], end)

    def decode(self, sequences: list[np.ndarray], cells: int = 200_000) -> list[np.ndarray]:
        """The best state of every token of each sequence, by Viterbi over many sequences of like length at once, of ``cells`` tokens together (or a single longer one)."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sequences)
        order = sorted((i for i, s in enumerate(sequences) if len(s)), key=lambda i: len(sequences[i]))
        start, move, emit = self.start.astype(np.float32), self.move.astype(np.float32), self.emit.T.astype(np.float32)
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(sequences[order[end]]) <= cells:
                end += 1
            some = order[at:end]
            at = end
            sizes = np.array([len(sequences[i]) for i in some])
            long = int(sizes[-1])
            see = np.zeros((len(some), long), np.int64)
            for k, i in enumerate(some):
                see[k, : sizes[k]] = sequences[i]
            best, back = start + emit[see[:, 0]], np.zeros((long, len(some), len(STATES)), np.int8)
            last = np.where((sizes == 1)[:, None], best, 0)
            for t in range(1, long):
                live = np.searchsorted(sizes, t, "right")  # sequences of a like length stand in order of it
                all_ = best[live:, :, None] + move
                came = all_.argmax(1)
                back[t, live:] = came
                best[live:] = np.take_along_axis(all_, came[:, None, :], 1)[:, 0] + emit[see[live:, t]]
                last[sizes == t + 1] = best[sizes == t + 1]
            path = np.zeros((long, len(some)), np.int64)
            state, rows = (last + self.end).argmax(1), np.arange(len(some))
            for t in range(long - 1, -1, -1):
                path[t] = state
                inside = t < sizes
                state = np.where(inside & (t > 0), back[t][rows, state], state)
            for k, i in enumerate(some):
                out[i] = path[: sizes[k], k]
        return out

    def fitted(self, sequences: list[np.ndarray], rounds: int = 2, weight: float = 400.0) -> "Model":
        """Viterbi training: the tables re-estimated from the best paths, with the prior counting as ``weight`` observations of each state."""
        model = self
        for _ in range(rounds):
            start, move, tables = np.exp(self.start) * weight, np.exp(self.move) * weight, [np.exp(t) * weight for t in self.tables]
            for seq, path in zip(sequences, model.decode(sequences)):
                if len(seq):
                    start[path[0]] += 1
                    np.add.at(move, (path[:-1], path[1:]), 1)
                    for f, table in enumerate(tables):
                        np.add.at(table, (path, _VALUES[seq, f]), 1)
            model = Model(*(np.log(x / x.sum(-1, keepdims=True)) for x in (start, move)), [np.log(t / t.sum(-1, keepdims=True)) for t in tables], self.end)
        return model


def labels(text: str, tokens: list[tuple[int, int]], path: np.ndarray, people: People) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The labels (first token, token behind it, speaker) of a tagged segment, and of the stretches tagged as labels that are nobody's the first token, the token behind its first word, and the token behind it."""
    found, nobody, k = [], [], 0
    while k < len(path):
        if path[k] > SIGN:
            k += 1
            continue
        first, names = k, []
        while k < len(path) and path[k] == LEAD:
            k += 1
        while k < len(path) and (path[k] == NAME and not names or path[k] == MORE):
            names.append(k)
            k += 1
        while k < len(path) and path[k] == SIGN:
            k += 1
        k = max(k, first + 1)
        who = None
        if names:
            name = text[tokens[names[0]][0] : tokens[names[-1]][1]]
            who = people.who(regex.sub(r"\s*\([^()]*\)?$", "", name))
        if who is not None:
            found.append((first, k, who))
        else:
            nobody.append((first, names[0] + 1 if names else k, k))  # a name may still begin within it
    return found, nobody


def _withdrawn(symbols: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """The symbols without the evidence of a label in these stretches."""
    values = _VALUES[symbols].copy()
    for a, b, _ in spans:
        values[a:b, [1, 3]] = 0
    return np.ravel_multi_index(values.T, FEATURES)


def stretches(text: str, tokens: list[tuple[int, int]], found: list[tuple[int, int, int]], path: np.ndarray) -> list[tuple[int | None, str]]:
    """(speaker or None where no label came yet in this segment, clean speech) of a segment, in order; speech may be empty."""
    out: list[tuple[int | None, list[str]]] = [(None, [])]
    pending = list(found)
    last_end = None
    for k, (s, e) in enumerate(tokens):
        if pending and k == pending[0][0]:
            out.append((pending.pop(0)[2], []))
            last_end = None
        if TAG_OF[path[k]] == 4:
            glue = "" if last_end == s or not out[-1][1] else " "
            out[-1][1].append(glue + text[s:e])
            last_end = e
    clean = lambda parts: (lambda t: t if regex.search(r"[\p{L}\p{N}]", t) else "")("".join(parts).strip())
    return [(who, clean(parts)) for who, parts in out]


def parts_of(texts: list[str], people: list[People], model: Model, rounds: int = 12) -> list[list[tuple[int | None, str]]]:
    """The stretches of each segment. Where a stretch tagged as a label is nobody's, its evidence is withdrawn and the segment decoded again."""
    seen = [observe(t, p) for t, p in zip(texts, people)]
    symbols = [x for _, x in seen]
    done: list[list[tuple[int | None, str]]] = [[] for _ in texts]
    left = list(range(len(texts)))
    for turn in range(rounds):
        again = []
        for i, path in zip(left, model.decode([symbols[i] for i in left])):
            found, nobody = labels(texts[i], seen[i][0], path, people[i])
            if nobody and turn < rounds - 1:
                # First of a stretch's first word, so that a name within it may be found; at last of all of it.
                symbols[i] = _withdrawn(symbols[i], nobody if turn < rounds // 2 else [(a, b, b) for a, _, b in nobody])
                again.append(i)
                continue
            for a, _, b in nobody:
                path[a:b] = WORD
            done[i] = stretches(texts[i], seen[i][0], found, path)
        left = again
    return done


def seconds(time: Column) -> Column:
    """Whole seconds of the first time in a string (H:MM:SS, MM:SS, with or without fractions and brackets); null where none is readable."""
    part = lambda i: F.regexp_extract(time, r"^\s*[\[(<]?\s*(?:(\d{1,3}):)?(\d{1,2}):(\d{2})(?:[.,]\d+)?(?!\d)", i)
    h, m, s = (F.when(part(i) != "", part(i)).cast("bigint") for i in (1, 2, 3))
    return F.coalesce(h, F.lit(0)) * 3600 + m * 60 + s


def _tagger(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, People] = {}
        for batch in batches:
            mine = []
            for people in batch.column("people").to_pylist():
                key = people or "[]"
                if key not in known:
                    if len(known) > 500:
                        known.clear()
                    known[key] = People([(p["speaker_id"], p.get("full_name"), p.get("speaker_role")) for p in json.loads(key)])
                mine.append(known[key])
            out = [[{"speaker": who, "speech": speech} for who, speech in parts] for parts in parts_of([t or "" for t in batch.column("text").to_pylist()], mine, model)]
            kind = pa.list_(pa.struct([("speaker", pa.int64()), ("speech", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("seg"), batch.column("time"), batch.column("base"), pa.array(out, kind)], ["doc", "seg", "time", "base", "parts"])

    return run


def _carried(df: DataFrame, keys: list[str], block: str, order: list[str], value: Column, name: str, inclusive: bool) -> DataFrame:
    """Add ``name``: the last non-null ``value`` (a struct) at or before each row (before it, if not inclusive), by a blocked scan."""
    w = Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    here = df.withColumn("_v", value)
    ends = here.where("_v is not null").groupBy(*keys, block).agg(F.max_by("_v", F.struct(*order)).alias("_end"))
    blocks = here.select(*keys, block).distinct().join(ends, [*keys, block], "left")
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select(*keys, block, F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    return here.withColumn("_l", F.last("_v", ignorenulls=True).over(w)).join(carry, [*keys, block]).withColumn(name, F.coalesce("_l", "_carry")).drop("_v", "_l", "_carry")


def speech(segments: DataFrame, speakers: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc, time, base, seg, part, block, speaker, speech): the stretches of speech of every document with their speakers, in order of (time, base, seg, part)."""
    rows = segments.select(F.col("doc_id").alias("doc"), F.col("podcast_slug").alias("slug"), F.col("segment_no").cast("bigint").alias("seg"), seconds(F.col("timestamp")).alias("at"), "text")
    rows = rows.where("doc is not null")
    one = rows.groupBy("doc", "seg").agg(F.min(F.struct(F.col("at").isNull().alias("_"), "at", "text", "slug")).alias("r")).select("doc", "seg", "r.at", "r.text", "r.slug")
    one = one.withColumn("block", F.floor(F.coalesce("seg", F.lit(0)) / 1000))
    timed = _carried(one, ["doc"], "block", ["seg"], F.when(F.col("at").isNotNull(), F.struct("at", "seg")), "b", True)
    timed = timed.select("doc", "seg", "text", "slug", F.col("b.at").alias("time"), F.coalesce("b.seg", F.lit(-(2**62))).alias("base"))
    first = timed.groupBy("doc", "time", "text").agg(F.min(F.struct("base", "seg")).alias("o"), F.min("slug").alias("slug")).select("doc", "time", "text", "o.base", "o.seg", "slug")
    people = speakers.where("podcast_slug is not null").groupBy(F.col("podcast_slug").alias("slug")).agg(F.to_json(F.sort_array(F.collect_set(F.struct("speaker_id", "full_name", "speaker_role")))).alias("people"))

    some = segments.where("text is not null").select("podcast_slug", "text", F.xxhash64("doc_id", "segment_no", "text").alias("h")).orderBy("h").limit(sample).join(people, F.col("podcast_slug") == F.col("slug"), "left").select("text", "people").collect()
    known = functools.lru_cache(maxsize=1000)(lambda people: People([(p["speaker_id"], p.get("full_name"), p.get("speaker_role")) for p in json.loads(people)]))
    model = Model.prior().fitted([observe(r.text, known(r.people or "[]"))[1] for r in some])

    tagged = first.join(people, "slug", "left").select("doc", "seg", "time", "base", "text", "people")
    parts = tagged.mapInArrow(_tagger(model), "doc string, seg bigint, time bigint, base bigint, parts array<struct<speaker:bigint,speech:string>>")
    each = parts.select("doc", "time", "base", "seg", F.posexplode("parts").alias("part", "p")).select("doc", "time", "base", "seg", "part", "p.speaker", "p.speech")
    each = each.where("speech <> '' or speaker is not null").withColumn("block", F.coalesce(F.floor(F.col("time") / 600), F.floor(F.col("seg") / 1000) - F.lit(10**12)))
    each = stored(each, "stretches")
    held = _carried(each, ["doc"], "block", ["time", "base", "seg", "part"], F.when(F.col("speaker").isNotNull(), F.struct("speaker")), "h", True)
    return held.where("speech <> ''").select("doc", "time", "base", "seg", "part", "block", F.col("h.speaker").alias("speaker"), "speech")


def turns(segments: DataFrame, speakers: DataFrame, sample: int = SAMPLE, with_text: bool = True) -> DataFrame:
    """(doc_id, turn_no, speaker_id, start_seconds[, text]): the turns of each document, numbered from 1.

    ``segments``: doc_id, podcast_slug, segment_no, timestamp, text; ``speakers``: podcast_slug, speaker_id,
    full_name, speaker_role. Rows of one document with equal segment_no are one segment (of differing rows the
    one with a readable time, then the smallest); equal texts at the same second count once. Segments stand in
    order of time, those without a readable time behind the row before them; before any readable time the
    start is null and stands first. Speech before any label has a null speaker. Null and empty texts say nothing;
    rows without doc_id are left out; an empty table gives none. ``sample``: segments the model is trained on.
    """
    said = stored(speech(segments, speakers, sample), "speech")
    order = ["time", "base", "seg", "part"]
    before = _carried(said, ["doc"], "block", order, F.struct("speaker"), "prev", False)
    starts = before.withColumn("new", (F.col("prev").isNull() | ~F.col("prev.speaker").eqNullSafe(F.col("speaker"))).cast("bigint"))
    per_block = starts.groupBy("doc", "block").agg(F.sum("new").alias("_n"))
    upto = per_block.select("doc", "block", F.coalesce(F.sum("_n").over(Window.partitionBy("doc").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = F.sum("new").over(Window.partitionBy("doc", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    numbered = starts.withColumn("_in", within).join(upto, ["doc", "block"]).withColumn("turn_no", F.col("_before") + F.col("_in"))
    if not with_text:
        return numbered.where("new = 1").select(F.col("doc").alias("doc_id"), "turn_no", F.col("speaker").alias("speaker_id"), F.col("time").alias("start_seconds"))
    whole = numbered.groupBy("doc", "turn_no").agg(F.min(F.struct(*order, "speaker")).alias("f"), F.sort_array(F.collect_list(F.struct(*order, "speech"))).alias("s"))
    return whole.select(F.col("doc").alias("doc_id"), "turn_no", F.col("f.speaker").alias("speaker_id"), F.col("f.time").alias("start_seconds"), F.array_join(F.transform("s", lambda x: x["speech"]), " ").alias("text"))
