from pyspark.sql import functions as F

from quern.config import GenerateConfig, RetrieveConfig
from quern.functions import text as T
from quern.operators import generate, index, retrieve, rewrite


def test_capped_pick(spark):
    rows = [("q", f"c{i}", d, 0, i, doc, p, t, "") for i, d, doc, p, t in [(1, 0.10, "d1", "A", "t1"), (2, 0.11, "d1", "A", "t2"), (3, 0.12, "d2", "A", "t3"), (4, 0.13, "d3", "B", "t1"), (5, 0.14, "d4", "B", "t4"), (6, 0.15, "d5", "A", "t5"), (7, 0.16, "d6", "B", "t6")]]
    df = spark.createDataFrame(rows, "query_id string, chunk_id string, distance double, first_index int, first_rank int, doc_id string, podcast_slug string, title string, chunk_content_hash string")
    config = RetrieveConfig(final_top_k=4, max_chunks_per_podcast=2)
    got = retrieve.picked(df, config=config).orderBy("rank").collect()
    assert [r.chunk_id for r in got] == ["c1", "c3", "c5", "c7"]
    cover = retrieve.coverage(retrieve.picked(df, config=config), spark.createDataFrame([("q",), ("none",)], "query_id string")).collect()
    assert {r.query_id: (r.coverage_status, r.usable_source_count) for r in cover} == {"q": ("strong", 4), "none": ("none", 0)}


def test_equal_hashes_and_empty_keys(spark):
    rows = [("q", "a", 0.1, 0, 1, "", None, None, "h"), ("q", "b", 0.1, 0, 2, "", None, None, "h"), ("q", "c", 0.1, 0, 3, "", None, "三国", ""), ("q", "d", 0.1, 0, 4, "", None, "三国", "")]
    df = spark.createDataFrame(rows, "query_id string, chunk_id string, distance double, first_index int, first_rank int, doc_id string, podcast_slug string, title string, chunk_content_hash string")
    assert [r.chunk_id for r in retrieve.picked(df).orderBy("rank").collect()] == ["a", "c", "d"]


def test_merge(spark):
    rows = [("q", 0, 1, "q0", "x", 0.30), ("q", 0, 2, "q0", "y", 0.20), ("q", 1, 1, "q1", "x", 0.25), ("q", 1, 2, "q1", "y", 0.20)]
    df = spark.createDataFrame(rows, "query_id string, query_index int, rank int, matched_query string, chunk_id string, distance double")
    got = {r.chunk_id: (r.distance, r.matched_query, r.matched_queries) for r in retrieve.merged(df).collect()}
    assert got == {"x": (0.25, "q1", ["q0", "q1"]), "y": (0.20, "q0", ["q0", "q1"])}


def test_coverage_levels(spark):
    rows = [("w", 0.1), ("w", 0.2), ("s", 0.1), ("s", 0.2), ("s", 0.3), ("m", 0.1), ("m", 0.2), ("m", 0.41)]
    df = spark.createDataFrame(rows, "query_id string, distance double")
    got = {r.query_id: r.coverage_status for r in retrieve.coverage(df, spark.createDataFrame([("w",), ("s",), ("m",), ("n",)], "query_id string")).collect()}
    assert got == {"w": "weak", "s": "strong", "m": "medium", "n": "none"}


def test_nearest_in_blocks_is_the_same(spark):
    v = spark.range(60).select(F.col("id").cast("string").alias("chunk_id"), F.array(F.sin("id"), F.cos("id"), F.sin(F.col("id") * 3)).cast("array<float>").alias("embedding"))
    odd = spark.createDataFrame([("z", [0.0, 0.0, 0.0]), ("s", [1.0]), ("n", None), ("nan", [float("nan"), 1.0, 1.0])], "chunk_id string, embedding array<float>")
    q = v.where("cast(chunk_id as int) % 10 = 0").select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("q_embedding"))
    one = index.nearest(q, v.unionByName(odd), 3, ["query_id"], "chunk_id").collect()
    many = index.nearest(q, v.unionByName(odd), 3, ["query_id"], "chunk_id", block=2).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) and len(one) == 18
    assert all(r.query_id == r.chunk_id for r in one if r["rank"] == 1)


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_strings(spark):
    assert one(spark, T.title_key(F.lit("Best Of (2021) – Part 2!"))) == "best of part 2"
    assert one(spark, T.title_key(F.lit("Class of 2024"))) == "class of"
    assert one(spark, T.title_key(F.lit("三国"))) == ""
    assert one(spark, T.distinct_ignoring_case(F.array(F.lit(" A  b"), F.lit("a B"), F.lit(""), F.lit("C")))) == ["A b", "C"]
    assert one(spark, T.id_from_url(F.lit("https://h/a/b/c"), "x")) == "x__b__c"
    assert one(spark, T.page_url(F.lit("https://h/p?page=3"), F.lit(1), "h")) == "https://h/p"
    assert one(spark, T.page_url(F.lit("https://h/p/?page=3"), F.lit(2), "h")) == "https://h/p?page=2"
    assert one(spark, T.resolve(F.lit("https://h/a/b"), F.lit("../c?x=1"))) == "https://h/c?x=1"
    assert one(spark, T.preview(F.lit("ab  cd ef"), 6)) == "ab cd..."


def test_rounds(spark):
    cases = {"写30轮对话": 30, "7回合": 7, "30 turns": 15, "31 turns": 16, "200 rounds": 80, "0 rounds": 1, "20 turns, 5 rounds": 5, "2 rounds 7轮": 7, "1.5 rounds": 5, "３０轮": 30, "no number": 30}
    df = spark.createDataFrame(list(cases.items()), "q string, n int")
    assert all(r.got == r.n for r in df.select("n", T.rounds(F.col("q"), 30).alias("got")).collect())


def test_rewrite(spark):
    answers = [
        ("q", 'Sure: {"canonical_terms": ["A b", "a B"], "core_query": " ", "retrieval_queries": ["Q", "x", 3]} done'),
        ("q", '{"retrieval_queries": "no"}'),
        ("q", "{'retrieval_queries': []}"),
        ("q", "[1]"),
        ("q", '{"a": 1} and {"b": 2}'),
        ("q", None),
        ("q", '{"core_query": "c"}'),
    ]
    df = spark.createDataFrame([(i, *a) for i, a in enumerate(answers)], "i int, query string, answer string")
    got = [r.result for r in rewrite.parsed(df).orderBy("i").collect()]
    assert got[0].retrieval_queries == ["q", "A b", "x", "3"] and got[0].rewrite_used and got[0].canonical_terms == ["A b", "a B"]
    assert [g.rewrite_used for g in got] == [True, False, False, False, False, False, True]
    assert got[1].retrieval_queries == ["q"] and "not a list" in got[1].fallback_reason and got[6].retrieval_queries == ["q", "c"]


def test_cache(spark):
    requests = spark.createDataFrame([("q",), ("r",)], "query string").withColumn("cache_key", rewrite.cache_key(F.col("query"), "p", "u", "m"))
    cache = requests.where("query = 'q'").select("cache_key", F.lit("first").alias("result"), F.lit(1).alias("n")).unionByName(requests.where("query = 'q'").select("cache_key", F.lit("second").alias("result"), F.lit(2).alias("n")))
    assert {r.query: r.result for r in rewrite.cached(requests, cache, "n").collect()} == {"q": "first", "r": None}


def test_source_budget(spark):
    df = spark.sql("select array(named_struct('rank', 1, 'title', 't', 'distance', 0.3d, 'text', 'abcdefgh'), named_struct('rank', 2, 'title', 't', 'distance', 0.1d, 'text', 'ijklmnop'), named_struct('rank', 3, 'title', 't', 'distance', cast(null as double), 'text', 'qrstuvwx')) as s")
    got = df.select(generate.budgeted(F.col("s"), GenerateConfig(max_source_chars=10, max_chars_per_source=6)).alias("b")).first().b
    assert [(x["rank"], x.text) for x in got] == [(2, "ijklmn"), (1, "abcd")]


def test_appendix_and_notes(spark):
    text = "A: x\n\n## Source Notes\nmade up"
    df = spark.sql("select array(named_struct('rank', 1, 'distance', 0.5d, 'chunk_id', 'c', 'doc_id', 'd', 'title', 'T', 'podcast_slug', 'p', 'url', '', 'start_timestamp', '1', 'end_timestamp', '2', 'chunk_index', 0L, 'char_count', 3L, 'matched_queries', array('q'), 'text', 'a  b')) as s")
    got = df.select(generate.document(F.lit(text), F.col("s")).alias("d")).first().d
    assert got.startswith("A: x\n\n## Source Appendix") and "- URL: N/A" in got and "  - q" in got and "> a b" in got and "made up" not in got


def test_flattened_results(spark):
    df = spark.sql("select 'q' as query_id, array(array('a', 'b'), array()) as ids, array(array(0.1d, 0.2d)) as distances, array(array('x', 'y')) as documents")
    got = [(r.query_index, r["rank"], r.chunk_id, r.distance, r.document) for r in retrieve.flattened(df).collect()]
    assert got == [(0, 1, "a", 0.1, "x"), (0, 2, "b", 0.2, "y")]


def test_usable_variants(spark):
    df = spark.createDataFrame([("q", ["a", " "]), ("q", ["", "  "])], "q string, v array<string>")
    assert [r[0] for r in df.select(retrieve.usable_variants(F.col("v"), F.col("q"))).collect()] == [["a"], ["q"]]
