import json

from pyspark.sql import functions as F

from quern import adapters
from quern.config import ChunkConfig, CleanConfig, load_yaml, merged
from quern.operators import scrape
from quern.sources import jsonl, sinks
from quern.streaming import ingest

CATALOG = """<html><body><div class="podcast-page-info">Page 1 of 3</div>
<a class="podcast-card" href="/shows/a"><span class="podcast-card-title"> A  show </span><span class="tag">12 episodes</span><span class="tag">3 views</span></a>
<a class="podcast-card" href="/shows/b" aria-label="Visit B show"></a><a class="podcast-card" href="/shows/a"><b class="podcast-card-title">again</b></a><a class="podcast-card">no</a></body>"""
LISTING = """<a class="podcast-episode-card" href="/e/1" aria-label="Read One"><h3 class="podcast-episode-title">Shown</h3><p class="podcast-episode-description">About</p><span class="tag">61:02</span><span class="tag">Published today</span></a>
<a class="podcast-episode-card" href="/e/2"></a>"""
EPISODE = """<html><body><header><h1>Transcript of One</h1></header><main><p>intro<p>00:00:01<p>Hello <b>there</b><script>x</script><p>Copy link to transcript<p>00:00:05<p>00:00:09<p>Bye<p>About us<p>00:00:10<p>no</main></body>"""


def test_catalog_and_listing(spark):
    pages = spark.createDataFrame([(1, "https://h/c", CATALOG)], "n int, url string, html string")
    got = {r.slug: r for r in scrape.catalog(pages, "n").collect()}
    assert set(got) == {"a", "b"} and got["a"].title == "A show" and got["a"].episode_count == 12 and got["a"].views_text == "3 views" and got["b"].title == "B show"
    assert [r.slug for r in scrape.catalog(pages, "n", most=1).collect()] == ["a"]
    (e,) = scrape.listing(spark.createDataFrame([(1, "https://h/l", LISTING)], "n int, url string, html string"), "n").collect()
    assert (e.title, e.url, e.duration, e.published_text, e.description) == ("One", "https://h/e/1", "61:02", "Published today", "About")


def test_episode(spark):
    df = spark.createDataFrame([("", "https://h/e/1", "https://h/shows/a", EPISODE), ("T", "https://h/e/2", "https://h/shows/a", "<p>Home<p>Transcript of x<p>words"), ("N", "https://h/x", None, None)], "title string, url string, list_page_url string, html string")
    df = df.withColumn("description", F.lit("d")).withColumn("duration", F.lit("1:00")).withColumn("published_text", F.lit("p"))
    got = {r.url: r for r in scrape.documents(df, "2024-01-01T00:00:00+00:00", "site", F.lit("A"), F.lit("a")).collect()}
    one = got["https://h/e/1"]
    assert one.title == "One" and one.clean_text == "[00:00:01] Hello there\n[00:00:09] Bye" and one.metadata.segment_count == 2 and one.doc_id == "site__e__1" and one.metadata.podcast_path == "/shows/a"
    assert got["https://h/e/2"].clean_text == "words" and got["https://h/x"].clean_text == ""


def test_segments_in_rows_equal_those_in_arrays(spark):
    lines = ["00:00:01", "a", "b", "00:00:05", "00:00:09", "c"]
    rows = spark.createDataFrame([("d", i, x) for i, x in enumerate(lines)], "doc string, at int, line string")
    by_row = [(r.timestamp, r.text) for r in scrape.segment_blocks(rows, "doc", "at", "line").orderBy("block").collect()]
    by_array = spark.createDataFrame([(lines,)], "l array<string>").select(scrape.segments(F.col("l"))).first()[0]
    assert by_row == [(s.timestamp, s.text) for s in by_array] == [("00:00:01", "a b"), ("00:00:09", "c")]


def test_scans(spark, tmp_path):
    for slug, body in {"a": '{"url": "1"}\n\n{broken\n{"url": "2"}\n', "catalog": '{"url": "9"}\n', "b": ""}.items():
        (tmp_path / slug).mkdir()
        (tmp_path / slug / "source_documents.jsonl").write_text(body)
    path = str(tmp_path / "a")
    good, bad = jsonl.lenient(spark, path, "url string")
    assert good.count() == 2 and [r.line for r in bad.collect()] == ["{broken"]
    assert jsonl.dropping(spark, path, "url string").count() == 2
    try:
        jsonl.strict(spark, path, "url string").collect()
        raise AssertionError("a broken line must fail")
    except AssertionError:
        raise
    except Exception as e:
        assert "broken" in str(e) or "MALFORMED" in str(e).upper()
    assert [(r.line_no, r.url) for r in jsonl.numbered(spark, path, "url string").orderBy("line_no").collect()] == [(1, "1"), (3, None), (4, "2")]
    assert [r.line_no for r in jsonl.numbered(spark, path, "url string").where("broken").collect()] == [3]
    assert {r.podcast_slug for r in jsonl.partitioned(spark, str(tmp_path), "url string").collect()} == {"a"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", "é")], "k string, v string")
    assert sinks.write_jsonl(df, str(tmp_path / "j")) == 2
    assert '"v":null' in "".join(p.read_text() for p in (tmp_path / "j").glob("*.json"))
    assert sinks.append_new(df, str(tmp_path / "t"), "k").count() == 2
    assert sinks.append_new(spark.createDataFrame([("b", "x"), ("c", "y"), ("c", "y")], "k string, v string"), str(tmp_path / "t"), "k").count() == 3
    ordered = spark.createDataFrame([("d", "second", 2), ("d", "first", 1), ("a", "late", 0)], "k string, v string, n int").drop("n").withColumn("n", F.when(F.col("v") == "first", 1).otherwise(2))
    sinks.append_new(ordered.select("k", "v"), str(tmp_path / "t"), "k", [F.col("v")])
    assert {(r.k, r.v) for r in spark.read.parquet(str(tmp_path / "t")).where("k in ('a', 'd')").collect()} == {("a", None), ("d", "first")}
    runs = spark.createDataFrame([(1, "a"), (2, "b")], "run_ts int, x string")
    assert [r.x for r in sinks.latest(runs).collect()] == ["b"]


def test_partitions_that_lost_all_rows_are_emptied(spark, tmp_path):
    at, rows = str(tmp_path / "p"), spark.createDataFrame([("a b/c", 1), ("b", 2), ("c", 3)], "podcast_slug string, v int")
    sinks.write_partitions(rows, at)
    sinks.write_partitions(rows.where("v = 2").withColumn("v", F.lit(9)), at, expected=rows.where("v < 3"))
    read = lambda: {(r.podcast_slug, r.v) for r in spark.read.schema("v int, podcast_slug string").json(at).collect()}
    assert read() == {("b", 9), ("c", 3)}
    sinks.write_partitions(rows.where("v > 9"), at, expected=rows)
    assert read() == set() and len([p for p in (tmp_path / "p").iterdir() if p.is_dir()]) == 3


def test_texts_and_tables(spark, tmp_path):
    rows = spark.createDataFrame([("x", "é", None), ("y", "b", "{}")], "name string, md string, meta_json string")
    assert sinks.write_texts(rows, str(tmp_path / "o"), "name", "md", "meta_json") == 3
    assert (tmp_path / "o" / "x.md").read_text() == "é" and (tmp_path / "o" / "y.meta.json").read_text() == "{}" and not (tmp_path / "o" / "x.meta.json").exists()
    assert sinks.open_table(spark, str(tmp_path / "v"), "id string")[1] == 0 and sinks.open_table(spark, str(tmp_path / "v"), "id string")[1] == 0
    try:
        sinks.open_table(spark, str(tmp_path / "v"), "id string", metric="l2")
        raise AssertionError("another metric must fail")
    except ValueError:
        pass


def test_line_numbers_over_several_splits(spark, tmp_path):
    (tmp_path / "f.jsonl").write_text("".join(f'{{"n": {i}}}\n' + "\n" * (i % 3) for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = {r.n: r.line_no for r in jsonl.numbered(spark, str(tmp_path / "f.jsonl"), "n int").collect()}
        assert spark.read.text(str(tmp_path / "f.jsonl")).rdd.getNumPartitions() > 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want, line = {}, 1
    for i in range(3000):
        want[i], line = line, line + 1 + i % 3
    assert got == want


def test_stream(spark, tmp_path):
    (tmp_path / "in" / "a").mkdir(parents=True)
    line = lambda u, t: json.dumps({"url": u, "clean_text": t}) + "\n"
    (tmp_path / "in/a/1.json").write_text(line("u1", "x" * 20) + line("u1", "y" * 20) + line("u2", "z"))
    run = lambda: ingest.ingest(ingest.arriving(spark, str(tmp_path / "in"), "url string, clean_text string"), str(tmp_path / "out"), str(tmp_path / "cp"), config=CleanConfig(min_chars=5)).awaitTermination()
    run()
    (tmp_path / "in/a/2.json").write_text(line("u1", "w" * 20) + line("u3", "v" * 20))
    run()
    assert {r.url: r.clean_text[0] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"u1": "x", "u3": "v"}  # the first of the file's rows


def test_adapters(spark):
    df = spark.createDataFrame([("u1",), ("u2",)], "url string")
    got = {r.url: (r.html, r.error is None) for r in adapters.fetched(df, lambda: adapters.TableFetcher({"u1": "x"})).collect()}
    assert got == {"u1": ("x", True), "u2": (None, False)}
    e = adapters.embedded(spark.createDataFrame([("a b",), (None,)], "text string"), "text", lambda: adapters.HashEmbedder(8)).collect()
    assert len(e[0].embedding) == 8 and e[1].embedding == [0.0] * 8


def test_config(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text("chunk:\n  target_chars: 100 # x\n  max_chars: 200\nname: 'q'\n")
    assert load_yaml(str(p))["chunk"] == {"target_chars": 100, "max_chars": 200} and load_yaml(str(tmp_path / "none")) == {}
    assert merged(ChunkConfig(), {"target_chars": 100}, max_chars=0).max_chars == 3600


def test_acquire(spark):
    from quern.plans import acquire

    pages = {
        "https://h/c": CATALOG, "https://h/c?page=2": '<a class="podcast-card" href="/shows/z"></a>', "https://h/shows/a": LISTING + '<a class="podcast-episode-card" href="/e/old" aria-label="Read Old"></a><a class="podcast-episode-card" href="/e/gone" aria-label="Read Gone"></a>',
        "https://h/e/1": EPISODE,
    }
    fetch = lambda: adapters.TableFetcher(pages)
    series = acquire.podcasts(spark, "https://h/c", fetch, "h").collect()
    assert {r.slug for r in series} == {"a", "b", "z"}
    existing = spark.createDataFrame([("https://h/e/old",), (None,)], "url string")
    docs, failed = acquire.new_documents(spark.createDataFrame(series), existing, fetch, "h", "site", "2024-01-01T00:00:00+00:00")
    assert [(d.url, d.podcast_title, d.metadata.podcast_slug) for d in docs.collect()] == [("https://h/e/1", "A show", "a")]
    assert {(r.slug, r.written, r.skipped, r.failed) for r in failed.collect()} == {("a", 1, 1, 1)}
    few, _ = acquire.new_documents(spark.createDataFrame(series), existing, fetch, "h", "site", "2024-01-01T00:00:00+00:00", max_episodes=1)
    assert [d.url for d in few.collect()] == ["https://h/e/1"]


def test_every_page_is_requested_once_and_kept(spark, tmp_path):
    from quern.plans import acquire

    log = str(tmp_path / "requests")

    class Counting:  # within the test, so that it travels to the workers by value
        def fetch(self, url):
            with open(log, "a") as f:
                f.write(url + "\n")
            return {"https://h/shows/a": LISTING + "<div class='podcast-page-info'>Page 1 of 2</div>", "https://h/shows/a?page=2": LISTING, "https://h/e/1": EPISODE}[url]

    series = spark.createDataFrame([("https://h/shows/a", "a", "A")], "url string, slug string, title string")
    docs, summary = acquire.new_documents(series, spark.createDataFrame([], "url string"), Counting, "h", "site", "now", raw=str(tmp_path / "raw"))
    assert docs.count() == 1 and docs.count() == 1 and summary.first().written == 1
    assert sorted(open(log).read().split()) == ["https://h/e/1", "https://h/shows/a", "https://h/shows/a?page=2"]
    kept = {r.path for r in spark.read.parquet(str(tmp_path / "raw")).collect()}
    assert kept == {"a/list_pages/page_001.html", "a/list_pages/page_002.html", "a/episode_pages/1.html"}
    again = acquire.new_documents(series, spark.createDataFrame([], "url string"), lambda: adapters.StoredFetcher(str(tmp_path / "raw")), "h", "site", "now")[0]
    assert [d.url for d in again.collect()] == ["https://h/e/1"]


def test_page_numbers(spark):
    from quern.functions import text as T

    rows = spark.createDataFrame([("https://h/p?x=1&page=12",), ("https://h/p",), (None,)], "u string")
    assert [r[0] for r in rows.select(T.page_number(F.col("u"))).collect()] == [12, None, None]
