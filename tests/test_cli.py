import json

from pyspark.sql import functions as F

from quern import adapters, cli
from quern.plans import pipeline
from quern.schemas import REWRITE


def test_from_interim_to_dialogue(spark, tmp_path):
    docs = {"a": [("d1", "About rivers", "the river bends near the old mill and the bridge. " * 60), ("d2", "Same", "the river bends near the old mill and the bridge. " * 60)], "b": [("d3", "About bread", "flour water salt and a warm oven make good bread. " * 60), ("d4", "Short", "x")], "catalog": [("d5", "No", "y" * 2000)]}
    for slug, rows in docs.items():
        (tmp_path / "in" / slug).mkdir(parents=True)
        lines = [json.dumps({"doc_id": i, "title": t, "url": f"https://h/{i}", "clean_text": x, "content_hash": "h", "metadata": {"podcast_slug": slug}}) for i, t, x in rows]
        (tmp_path / "in" / slug / cli.FILE).write_text("\n".join(lines[:1] + ["{broken"] + lines[1:]) + "\n")
    at = lambda name: str(tmp_path / name)
    cli.main(["audit", "--input", at("in"), "--report", at("audit")])
    assert spark.read.json(at("audit/summary")).first().documents == 4 and sorted(r.line_no for r in spark.read.json(at("audit/broken_lines")).collect()) == [2, 2]
    cli.main(["validate", "--input", at("in"), "--report", at("validation")])
    v = spark.read.json(at("validation")).first()
    assert (v.podcast_files, v.nonempty_podcast_files, v.documents) == (2, 2, 4)
    cli.main(["clean", "--input", at("in"), "--output", at("clean"), "--report", at("reports")])
    s = spark.read.json(at("reports/summary")).first()
    assert (s.docs_seen, s.docs_written, s.duplicates, s.too_short) == (4, 2, 1, 1)
    assert {r.title for r in spark.read.json(at("reports/largest_reductions")).collect()} == {"About rivers", "About bread"} and spark.read.json(at("reports/shortest_cleaned")).count() == 2
    assert len(spark.read.json(at("reports/skipped")).first().cleaned_hash) == 64 and spark.read.json(at("reports/podcast_counts")).count() == 2
    cli.main(["chunk", "--input", at("clean"), "--output", at("chunks"), "--summary", at("stats")])
    n = spark.read.json(at("chunks")).count()
    assert n >= 2 and {r.podcast_slug for r in spark.read.json(at("chunks")).collect()} == {"a", "b"}
    cli.main(["index", "--chunks", at("chunks"), "--table", at("table")])
    cli.main(["index", "--chunks", at("chunks"), "--table", at("table")])
    assert spark.read.parquet(at("table")).count() == n
    cli.main(["retrieve", "--table", at("table"), "--output", at("packs"), "--query", "warm oven bread", "--max-distance", "1.0"])
    pack = spark.read.json(at("packs")).first()
    assert pack.sources[0].podcast_slug == "b" and pack.user_query == "warm oven bread" and pack.query_rewrite.fallback_reason == "rewrite_disabled"
    ask = ["--table", at("table"), "--query", "warm oven, 4 rounds", "--query", "river", "--max-distance", "1.0", "--rewriter", "quern.adapters:WordRewriter", "--cache", at("cache")]
    cli.main(["pipeline", *ask, "--output", at("all"), "--save-prompt", "--model", "echo"])
    packs = {r.query_id: r for r in spark.read.json(at("all/source_packs")).collect()}
    assert packs[0].query_rewrite.rewrite_used and packs[0].query_rewrite.core_query == "warm oven, 4" and packs[1].query_rewrite.retrieval_queries == ["river"]
    files = sorted(p.name.split("_", 3)[-1] for p in (tmp_path / "all").glob("dialogue_*"))
    assert files == ["0.md", "0.meta.json", "0.prompt.json", "1.md", "1.meta.json", "1.prompt.json"]
    text, meta = (tmp_path / "all" / "latest_0.md").read_text(), json.loads((tmp_path / "all" / "latest_0.meta.json").read_text())
    assert text.startswith("A: ") and "## Source Appendix" in text and meta["rounds"] == 4 and meta["total_dialogue_lines"] == 8 and meta["model"] == "echo"
    prompt = json.loads(next((tmp_path / "all").glob("dialogue_*_0.prompt.json")).read_text())
    assert '"core_query":"warm oven, 4"' in prompt[1]["content"]
    assert spark.read.parquet(at("cache")).count() == 2
    cli.main(["rewrite", *ask[2:-6], "--query", "river", "--rewriter", "quern.adapters:EchoGenerator", "--cache", at("cache"), "--output", at("rewritten")])
    assert spark.read.parquet(at("cache")).count() == 2  # nothing new
    cli.main(["dialogue", *ask, "--output", at("dry"), "--dry-run"])
    assert {p.suffix for p in (tmp_path / "dry").iterdir() if not p.name.startswith(".")} == {".json"}


def test_a_folder_that_loses_all_its_documents_is_emptied(spark, tmp_path):
    (tmp_path / "in" / "a").mkdir(parents=True)
    write = lambda text: (tmp_path / "in" / "a" / cli.FILE).write_text(json.dumps({"doc_id": "d", "clean_text": text, "metadata": {}}) + "\n")
    at = lambda name: str(tmp_path / name)
    for text, n in (("long words here " * 100, 1), ("short", 0)):
        write(text)
        cli.main(["clean", "--input", at("in"), "--output", at("out"), "--report", at("rep")])
        assert spark.read.schema("doc_id string, podcast_slug string").json(at("out")).count() == n


def test_chat_generator_talks_to_an_endpoint():
    import http.server
    import threading

    class Handler(http.server.BaseHTTPRequestHandler):
        def _send(self, body):
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def do_GET(self):
            self._send({"data": [{"id": "m"}]})

        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            self._send({"choices": [{"message": {"content": f"{asked['model']}: {asked['messages'][0]['content']}" if asked["messages"][0]["content"] else ""}}]})

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    model = adapters.ChatGenerator(f"http://127.0.0.1:{server.server_port}/v1/", "m", timeout=10)
    adapters.assert_model(model, "m")
    assert model.complete([{"role": "user", "content": "hi"}]) == "m: hi"
    try:
        model.complete([{"role": "user", "content": ""}])
        raise AssertionError("an empty answer must fail")
    except ValueError:
        server.shutdown()


def test_rewrites_and_cache(spark):
    # Within the test, so that it travels to the workers by value.
    class Rewriter:
        def models(self):
            return ["m"]

        def complete(self, messages):
            if "bad" in messages[-1]["content"]:
                raise ValueError("down")
            return '{"core_query": "core", "retrieval_queries": ["one"]}'

    kind = "struct<" + ", ".join(f"{a}:{b}" for a, b in (x.split(" ") for x in REWRITE.split(", "))) + ">"
    empty = spark.createDataFrame([], f"cache_key string, result {kind}, at int")
    requests = spark.createDataFrame([("good",), ("bad",)], "query string")
    done, new = pipeline.rewrite_batch(requests, empty, Rewriter, "p", "u", "m")
    got = {r.query: r.result for r in done.collect()}
    assert got["good"].retrieval_queries == ["good", "core", "one"] and not got["bad"].rewrite_used and got["bad"].retrieval_queries == ["bad"]
    cache = new.withColumn("at", F.lit(1)).cache()
    assert cache.count() == 1
    again, more = pipeline.rewrite_batch(requests.where("query = 'good'"), cache, adapters.EchoGenerator, "p", "u", "m")
    assert again.first().result.core_query == "core" and more.count() == 0
