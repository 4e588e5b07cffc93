"""Problem 8: encode a whole corpus with a public tokenizer, and decode it again.

Method: a distinct-word table. The text is split into words in the JVM by the tokenizer's own split
pattern; blocks of documents are dictionary-encoded (Arrow kernels), so that only each block's distinct
words are shuffled; each distinct word of the corpus is encoded once; its ids come back to the block by
position, and the block's documents are put together by one gather. Decoding joins ids to pieces.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import stored

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
# Fixed value: the split pattern of byte-level BPE; (?U) gives \s its Unicode meaning in Java.
SPLIT = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_DOCS, BLOCK_WORDS = 2_000, 500_000
#: Bytes of a row group of stored blocks.
GROUP = 16_777_216
BLOCK = "block bigint, ids array<bigint>, lengths array<int>, at array<int>, dictionary array<{}>"


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    t.no_padding()
    t.no_truncation()
    return t


def pieces_of(text):
    """The words of a text, null and empty texts giving none.

    A text with characters that this JVM's Unicode tables do not know is kept whole, as a single word: the
    tokenizer then splits it by its own tables, and the ids are those of the unsplit text in any case.
    """
    split = F.when(text.rlike(r"\p{Cn}"), F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(SPLIT), F.lit(0)))
    return F.when(F.length(text) > 0, split).otherwise(F.array().cast("array<string>"))


def block_number(count: int) -> int:
    """A block's own number: its partition and its place in it. Blocks are stored before anything is joined to them."""
    return (TaskContext.get().partitionId() << 32) | count


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow kernel (id, lists) -> blocks: the ids, the lengths of their lists, and the lists' values as places in a dictionary."""
    count = 0
    one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)

    def emit(ids: pa.Array, lists: pa.Array) -> pa.RecordBatch:
        nonlocal count
        coded = lists.flatten().dictionary_encode()
        lengths = pc.fill_null(pc.list_value_length(lists), 0).cast(pa.int32())
        count += 1
        return pa.RecordBatch.from_arrays([pa.array([block_number(count)]), one(ids), one(lengths), one(coded.indices), one(coded.dictionary)], ["block", "ids", "lengths", "at", "dictionary"])

    for batch in batches:
        ids, lists = batch.column(0), batch.column(1)
        if pa.types.is_large_list(lists.type) or pa.types.is_large_string(lists.type.value_type):
            lists = lists.cast(pa.list_(pa.string()))
        start, held = 0, 0
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_pylist()
        for i, n in enumerate(sizes):
            if i > start and (i - start >= BLOCK_DOCS or held + n > BLOCK_WORDS):
                yield emit(ids.slice(start, i - start), lists.slice(start, i - start))
                start, held = i, 0
            held += n
        if len(sizes) > start:
            yield emit(ids.slice(start), lists.slice(start))


def _encoder(path: str, batch_words: int = 20_000):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, batch_words):
                piece = batch.column(0).slice(at, batch_words)
                ids = [e.ids for e in t.encode_batch(piece.to_pylist(), add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([piece, pa.array(ids, pa.list_(pa.int32()))], ["piece", "piece_ids"])

    return encode


def _gather(block: pa.Table, found: pa.Table) -> pa.Table:
    """One block and (i, piece_ids) of its dictionary -> (id, ids)."""
    ids, lengths, at = (block.column(c).combine_chunks()[0].values for c in ("ids", "lengths", "at"))
    table = found.sort_by("i").column("piece_ids").combine_chunks() if found.num_rows else pa.array([], pa.list_(pa.int32()))
    each = table.take(at) if len(at) else table.slice(0, 0)
    ends = pc.cumulative_sum(lengths.cast(pa.int64()))
    # Token offsets of the words, then of the documents.
    tokens = pc.cumulative_sum(pc.list_value_length(each).cast(pa.int64()))
    tokens = pa.concat_arrays([pa.array([0], pa.int64()), tokens.combine_chunks() if isinstance(tokens, pa.ChunkedArray) else tokens])
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), tokens.take(ends)]).cast(pa.int32())
    return pa.Table.from_arrays([ids, pa.ListArray.from_arrays(offsets, each.flatten())], ["id", "ids"])


def _met(blocks: DataFrame, found: DataFrame, kernel, schema: str) -> DataFrame:
    """Each block with what was found for its dictionary, a block at a time: found rows are sorted, never collected in a row, so no task holds more than a block of them."""
    return blocks.groupBy("block").cogroup(found.withColumnRenamed("block", "_b").groupBy("_b")).applyInArrow(kernel, schema)


def _blocked(rows: DataFrame, kind: str, name: str) -> DataFrame:
    """The blocks of rows (id, list), stored. A row is a whole block, so sizes are looked at after each, and few blocks are read at once."""
    return stored(rows.mapInArrow(_blocks, BLOCK.format(kind)), name, **{"parquet.block.size": GROUP, "parquet.page.size.row.check.min": 1})


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(id_col, ids array<int>): the ids of each document's text, without special tokens.

    Null and empty texts give an empty list; strings that look like special tokens are ordinary text; a
    repeated row comes out as often as it goes in; other columns are ignored whatever their names.
    ``id_col`` is a bigint and need not be unique. ``tokenizer`` is a file that every executor can read.
    """
    split = docs.select(F.col(id_col).cast("bigint").alias("id"), pieces_of(F.col(text_col)).alias("words"))
    blocks = _blocked(split, "string", "token-blocks")
    entries = blocks.select("block", F.posexplode("dictionary").alias("i", "piece"))
    table = entries.select("piece").distinct().mapInArrow(_encoder(tokenizer), "piece string, piece_ids array<int>")
    found = entries.join(table, "piece").select("block", "i", "piece_ids")
    return _met(blocks.select("block", "ids", "lengths", "at"), found, _gather, "id bigint, ids array<int>").select(F.col("id").alias(id_col), "ids")


def pieces(spark, tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, piece binary): the bytes of every token of a byte-level BPE vocabulary file (a fixed 50,257 rows)."""
    with open(tokenizer, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(rest)}
    rows = [(i, bytearray(byte_of[c] for c in piece)) for piece, i in vocab.items() if all(c in byte_of for c in piece)]
    return spark.createDataFrame(rows, "id int, piece binary")


def _spell(block: pa.Table, found: pa.Table) -> pa.Table:
    """One block and (i, piece) of its distinct ids -> (id, text)."""
    ids, lengths, at = (block.column(c)[0].as_py() for c in ("ids", "lengths", "at"))
    table = dict(zip(found.column("i").to_pylist(), found.column("piece").to_pylist())) if found.num_rows else {}
    texts, start = [], 0
    for n in lengths:
        parts = [table.get(k) for k in at[start : start + n]]
        start += n
        texts.append(None if None in parts else b"".join(parts).decode("utf-8", "replace"))
    return pa.Table.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["id", "text"])


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", tokenizer: str = TOKENIZER) -> DataFrame:
    """(id_col, text): the text of each list of ids, through a join of ids to pieces.

    Only each block's distinct ids are joined and shuffled; texts are put together inside their blocks. An empty or null list gives
    '', an id without a piece (a null too) a null text, bytes that are no UTF-8 the replacement character; a repeated row comes out as often as it goes in.
    ``id_col`` is a bigint. The vocabulary has a fixed number of rows, so it may be broadcast.
    """
    table = F.broadcast(pieces(encoded.sparkSession, tokenizer).withColumnRenamed("id", "_token"))
    rows = encoded.select(F.col(id_col).cast("bigint").alias("id"), F.col(ids_col).cast("array<int>").alias("tokens"))
    blocks = _blocked(rows, "int", "id-blocks")
    entries = blocks.select("block", F.posexplode("dictionary").alias("i", "_token")).join(table, "_token", "left")
    return _met(blocks.select("block", "ids", "lengths", "at"), entries.select("block", "i", "piece"), _spell, "id bigint, text string").select(F.col("id").alias(id_col), "text")
