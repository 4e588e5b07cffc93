from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.config import ChunkConfig
from quern.functions.kernels import pack_blocks, split_long
from quern.operators import chunk


def test_split_long():
    assert split_long("aaaa. bbb. cc.", 10) == ["aaaa.", "bbb. cc."]
    assert split_long("abcdefghij", 4) == ["abcd", "efgh", "ij"]
    assert split_long("  short ", 10) == ["short"]


def blocks(*sizes):
    return [{"timestamp": None, "text": "x" * n} for n in sizes]


def sizes(chunks):
    return [(c["block_count"], c["char_count"]) for c in chunks]


def test_pack():
    assert sizes(pack_blocks(blocks(5, 5, 5), 10, 12, 1, 1)) == [(2, 12), (2, 12)]
    assert sizes(pack_blocks(blocks(5, 5, 3), 10, 12, 6, 0)) == [(2, 12)]
    assert sizes(pack_blocks(blocks(3), 10, 12, 6, 0)) == [(1, 3)]
    assert sizes(pack_blocks(blocks(8, 3), 8, 12, 6, 0)) == [(2, 13)]
    assert pack_blocks([], 10, 12, 6, 0) == []


def test_times_are_those_of_the_first_and_the_last_block():
    timed = [{"timestamp": None, "text": "intro"}, {"timestamp": "00:00:01", "text": "a" * 10}, {"timestamp": None, "text": "tail"}]
    (one,) = pack_blocks(timed, 100, 200, 5, 0)
    assert one["start_timestamp"] is None and one["end_timestamp"] is None
    first, second = pack_blocks(timed[:2], 5, 12, 1, 0)
    assert first["start_timestamp"] is None and second["start_timestamp"] == second["end_timestamp"] == "00:00:01"


@given(st.lists(st.integers(1, 40), max_size=20), st.integers(1, 3))
@settings(max_examples=100, deadline=None)
def test_pack_bounds(lengths, overlap):
    for c in pack_blocks(blocks(*lengths), 30, 40, 10, overlap):
        assert c["char_count"] <= 42 and c["block_count"] >= 1


def found(spark, text):
    b, aware = chunk.blocks(F.col("t"))
    row = spark.createDataFrame([(text,)], "t string").select(aware.alias("a"), b.alias("b")).first()
    return row.a, [(x.timestamp, x.text) for x in row.b]


def test_time_blocks(spark):
    assert found(spark, "[00:00:01] a\n[00:10:00] I am here\n[00:20:00] c") == (True, [("00:00:01", "a\n[00:10:00] I am here"), ("00:20:00", "c")])
    assert found(spark, "[00:00:01] a\nb") == (False, [(None, "[00:00:01] a\nb")])
    assert found(spark, "[00:00:01]\n[00:00:02]") == (True, [])
    assert found(spark, "intro\n1:02 x\n\ny\n1:03:04 z") == (True, [(None, "intro"), ("1:02", "x\n\ny"), ("1:03:04", "z")])
    assert found(spark, "one\n \ntwo") == (False, [(None, "one"), (None, "two")])


def test_documents(spark):
    rows = [("d", "p", "T", "u", "[00:00:01] " + "a" * 30 + "\n[00:00:02] " + "b" * 30), (None, None, None, None, "text"), ("e", None, None, None, " "), ("f", None, None, None, "[00:00:01]\n[00:00:02]"), ("g", None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id string, podcast_slug string, title string, url string, clean_text string")
    out = {r.doc_id: r for r in chunk.chunked(df, ChunkConfig(30, 40, 5, 0)).collect()}
    assert [c.chunk_id for c in out["d"].chunks] == ["d::chunk_0000", "d::chunk_0001"] and out["d"].chunks[1].start_timestamp == "00:00:02"
    assert out[None].chunks[0].doc_id.startswith("doc_") and out["e"].skip_reason == out["g"].skip_reason == "missing_text" and out["f"].skip_reason == "no_blocks_after_split"
    stats = chunk.statistics(chunk.chunked(df, ChunkConfig(30, 40, 5, 0))).first()
    assert (stats.documents_seen, stats.documents_skipped, stats.chunks_written, stats.chunks_per_doc_median) == (5, 3, 3, 1.5)


def test_wide_index(spark):
    assert spark.range(1).select(F.format_string("%s::chunk_%04d", F.lit("d"), F.lit(12345))).first()[0] == "d::chunk_12345"
