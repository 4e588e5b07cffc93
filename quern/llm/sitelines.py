"""Problem 6: lines, or any stretches, that return in too many documents of one source.

Method: content-defined chunking. A rolling hash over the last words decides where a chunk of a document's word stream
ends, so a chunk is found again wherever it stands, whatever the line breaks. Distinct documents are counted
per source and chunk, and chunks that return too often are cut (``cut_chunks``).

For whole lines (``repeated_lines``) the same counts decide which lines can return often: a line that stands in n documents
has, in all of them, the same chunks wherever both ends of a chunk are decided by words of the line alone, so each of these returns in at least n documents. A
line with a chunk that does not is out. Short lines may hold no such chunk; they and the lines left go to an exact count of lines, so none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import stored, words
from quern.llm.grams import R, as_int64, mix, offsets, spans, word_hashes

WINDOW, MEAN = 3, 8
#: The same for whole lines: finer, so that most lines hold chunks of their own.
LINE_WINDOW, LINE_MEAN = 2, 4
#: Most chunks that are broadcast.
BROADCAST = 1_000_000
_WORD = regex.compile(r"\p{L}+")


def boundaries(h: np.ndarray, stops: np.ndarray, window: int, mean: int) -> np.ndarray:
    """Places in a word stream where a chunk ends by content: behind a word where the hash of the last ``window`` words is 0 modulo ``mean``. ``stops``: ends of the documents; no window goes across one."""
    if not len(h):
        return np.zeros(0, np.int64)
    roll = np.zeros(len(h), np.uint64)
    for j in range(window):
        roll[window - 1 :] = roll[window - 1 :] * R + h[j : len(h) - window + 1 + j]
    is_end = mix(roll) % np.uint64(mean) == 0
    is_end[: window - 1] = False
    for j in range(window - 1):
        is_end[stops[stops + j < len(h)] + j] = False
    return np.flatnonzero(is_end) + 1


def chunk_ends(h: np.ndarray, window: int = WINDOW, mean: int = MEAN, least: int = 1) -> np.ndarray:
    """Ends of the chunks of one document, its own end included; boundaries within ``least`` words of the one before do not count, and a shorter rest belongs to the last chunk."""
    out, last = [], 0
    for e in boundaries(h, np.array([len(h)]), window, mean).tolist():
        if e - last >= least:
            out.append(e)
            last = e
    if len(h) and last < len(h):
        if out and len(h) - last < least:
            out.pop()
        out.append(len(h))
    return np.array(out, np.int64)


def _flat_lists(first: np.ndarray, counts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    """Lists values[first[i] : first[i] + counts[i]]."""
    off = np.concatenate([[0], np.cumsum(counts)])
    take = np.repeat(first - off[:-1], counts) + np.arange(off[-1])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), as_int64(values[take]))


def _document_chunks(least: int, window: int = LINE_WINDOW, mean: int = LINE_MEAN):
    """(id, source, lines: list of lists of words) -> id, source, chunks (all whole chunks of the document, distinct), lines (line_no, line, chunks: those that the line alone decides)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = batch.column(2)
            of_doc = offsets(lines)
            flat = lines.flatten()
            at = offsets(flat)
            h = word_hashes(flat.flatten())
            word_of_doc = at[of_doc]
            ends = boundaries(h, word_of_doc[1:], window, mean)
            starts, stops = ends[:-1], ends[1:]
            # Within one document, and not begun by the end of the one before.
            same = (np.searchsorted(word_of_doc, starts, "right") == np.searchsorted(word_of_doc, stops, "left")) & ~np.isin(starts, word_of_doc)
            starts, stops = starts[same], stops[same]
            chunk = spans(h, starts, stops)
            doc = np.searchsorted(word_of_doc, starts, "right") - 1
            key = np.unique(np.stack([doc.astype(np.uint64), chunk]), axis=1) if len(chunk) else np.zeros((2, 0), np.uint64)
            n = len(lines)
            first_of_doc = np.searchsorted(key[0], np.arange(n, dtype=np.uint64))
            chunks = _flat_lists(first_of_doc, np.append(first_of_doc[1:], key.shape[1]) - first_of_doc, key[1])

            keep = np.flatnonzero(np.diff(at) >= least)
            first = np.searchsorted(starts, at[keep] + window)
            counts = np.maximum(np.searchsorted(stops, at[keep + 1], "right") - first, 0)
            owner = np.searchsorted(of_doc, keep, "right") - 1
            rows = pa.StructArray.from_arrays([pa.array(keep - of_doc[owner] + 1, pa.int64()), as_int64(spans(h, at[keep], at[keep + 1])), _flat_lists(first, counts, chunk)], ["line_no", "line", "chunks"])
            found = pa.ListArray.from_arrays(pa.array(np.searchsorted(keep, of_doc), pa.int32()), rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), chunks, found], ["id", "source", "chunks", "lines"])

    return run


def _often(counts: DataFrame, sizes: DataFrame, least_docs: int, least_percent: int) -> DataFrame:
    """Counts (source, ..., n) that reach both bounds; ``sizes`` has all documents of each source."""
    return counts.where(F.col("n") >= least_docs).join(sizes, "source").where(F.col("n") * 100 >= F.col("size") * least_percent).drop("size", "n")


def repeated_lines(docs: DataFrame, ident: str, source: str, text: str, least_words: int = 4, least_docs: int = 5, least_percent: int = 10) -> DataFrame:
    r"""(ident, line_no): the lines whose word sequence stands as a whole line in too many documents of a source.

    Too many: at least ``least_docs`` and at least ``least_percent`` % of all its documents. Lines are the pieces
    between ``\n``, from 1, blank ones too; those of under ``least_words`` words never count. Documents of a null source are left
    out; null and empty texts count as documents of their source. A line twice in one document counts once
    and both come out; a repeated row is one more document only if its ``ident`` (a bigint) differs. An empty table gives none.
    """
    known = docs.where(F.col(source).isNotNull()).select(F.col(ident).cast("bigint").alias("id"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))
    sizes = known.select("id", "source").distinct().groupBy("source").agg(F.count("*").alias("size"))
    split = known.where("text is not null").select("id", "source", F.transform(F.split("text", "\n", -1), words).alias("lines"))
    schema = "id bigint, source string, chunks array<bigint>, lines array<struct<line_no:bigint,line:bigint,chunks:array<bigint>>>"
    docs_ = stored(split.mapInArrow(_document_chunks(least_words), schema), "site-chunks")
    often = stored(_often(_documents_with(docs_), sizes, least_docs, least_percent), "site-often")
    often = F.broadcast(often) if often.count() <= BROADCAST else often
    lines = docs_.select("id", "source", F.inline("lines"))
    each = lines.where(F.size("chunks") > 0).withColumn("need", F.size(F.array_distinct("chunks"))).select("id", "source", "line_no", "line", "need", F.explode(F.array_distinct("chunks")).alias("chunk"))
    # In a repeated row a chunk counts more than once; the exact count below decides.
    whole = each.join(often, ["source", "chunk"]).groupBy("id", "source", "line_no", "line", "need").agg(F.count("*").alias("n")).where("n >= need")
    hits = stored(whole.select("id", "source", "line_no", "line").unionByName(lines.where(F.size("chunks") == 0).select("id", "source", "line_no", "line")), "site-hits")
    exact = _often(hits.select("id", "source", "line").distinct().groupBy("source", "line").agg(F.count("*").alias("n")), sizes, least_docs, least_percent)
    return hits.join(exact, ["source", "line"]).select(F.col("id").alias(ident), "line_no").distinct()


def _documents_with(rows: DataFrame) -> DataFrame:
    """(source, chunk, n): in how many distinct documents (ids) a chunk stands. ``rows``: id, source, chunks (distinct in each row). Counts are added up before the shuffle unless an id stands in several rows."""
    each = rows.select("id", "source", F.explode("chunks").alias("chunk"))
    if not rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        each = each.distinct()
    return each.groupBy("source", "chunk").agg(F.count("*").alias("n"))


def remove_lines(docs: DataFrame, found: DataFrame, ident: str, text: str) -> DataFrame:
    r"""``docs`` with the found (ident, line_no) taken out of ``text``; all other columns stay. Lines are joined by ``\n`` again."""
    gone = found.groupBy(F.col(ident).alias("__id")).agg(F.collect_set("line_no").alias("__gone"))
    rest = F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains("__gone", F.coalesce(i.cast("bigint"), F.lit(0)) + 1))
    out = docs.join(gone, F.col(ident) == F.col("__id"), "left")
    return out.withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(rest, "\n"))).drop("__id", "__gone")


def _text_chunks(value: str, window: int, mean: int, least: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Chunks of a whole text and their stretches of characters."""
    found = [(m.start(), m.end(), m.group().lower()) for m in _WORD.finditer(value)]
    h = word_hashes(pa.array([w for _, _, w in found], pa.string()))
    ends = chunk_ends(h, window, mean, least)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    return spans(h, starts, ends), [(found[s][0], found[e - 1][1]) for s, e in zip(starts, ends)]


def cut_chunks(docs: DataFrame, ident: str, source: str, text: str, least_docs: int = 5, least_percent: int = 10, least_words: int = 4, window: int = WINDOW, mean: int = MEAN) -> DataFrame:
    """(ident, text, cut bigint): each text without the chunks that return in too many documents of its source, and how many were cut.

    Chunks have ``least_words`` words or more (a shorter text is one chunk). Documents are counted by ``ident``, so a repeated row is no
    further document. Documents of a null source come out unchanged, null texts as null. Of a repeated stretch the chunks
    at its two ends, which hold words around it too, stay: about one chunk at each end.
    """
    rows = docs.select(F.col(ident).cast("bigint").alias("id"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.unique(_text_chunks(value or "", window, mean, least_words)[0].view(np.int64)).tolist() for value in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))], ["id", "source", "chunks"])

    known = rows.where("source is not null")
    sizes = known.select("id", "source").distinct().groupBy("source").agg(F.count("*").alias("size"))
    found = stored(known.mapInArrow(fingerprints, "id bigint, source string, chunks array<bigint>"), "chunks")
    often = _often(_documents_with(found), sizes, least_docs, least_percent)
    gone = found.select("id", "source", F.explode("chunks").alias("chunk")).join(often, ["source", "chunk"]).groupBy("id").agg(F.collect_set("chunk").alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cuts = [], []
            for value, gone_ in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                n = 0
                if value and gone_:
                    chunk, where = _text_chunks(value, window, mean, least_words)
                    gone_ = set(gone_)
                    for (a, b), c in reversed(list(zip(where, chunk.view(np.int64).tolist()))):
                        if c in gone_:
                            value, n = value[:a] + value[b:], n + 1
                texts.append(value)
                cuts.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(cuts, pa.int64())], ["id", "text", "cut"])

    return rows.select("id", "text").join(gone, "id", "left").mapInArrow(cut, "id bigint, text string, cut bigint").select(F.col("id").alias(ident), F.col("text").alias(text), "cut")
