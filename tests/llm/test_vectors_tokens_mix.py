import math
import os
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quern.llm import hnsw, mix, tokens

VECTORS = "/root/testdata/sf0.1/vectors.parquet"
ODD = [
    None, "", " ", "  \n\n\t ", "a  b", "it's WE'LL they'd", "<|endoftext|> x<|endoftext|>", "日本語のテキスト、です。", "é́ ﬁ ½ ٣٤ ００", "👨‍👩‍👧🎙️ ok", "​﻿­", "x" * 5000, "\r\n \r\n", "a b\u0085c  d",
    "\U0001FAE8 \U00032000 new", "1234567890" * 3, "'s's 're", "퟿\U0010ffff", "!!! ... ?? --", "word " * 3000, "\x00\x1c\x1f",
]


def test_encode_is_the_tokenizer(spark, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_DOCS", 4)
    docs = spark.createDataFrame(list(enumerate(ODD)) + [(99, "a  b")], "doc_id bigint, text string").withColumn("ids", F.lit("clash")).withColumn("block", F.lit(1)).repartition(3)
    got = {r.doc_id: list(r.ids) for r in tokens.encode(docs).collect()}
    t = tokens._tokenizer(tokens.TOKENIZER)
    assert len(got) == len(ODD) + 1
    for i, text in enumerate(ODD):
        assert got[i] == (t.encode(text, add_special_tokens=False).ids if text else []), repr(text)
    back = {r.doc_id: r.text for r in tokens.decode(tokens.encode(docs)).collect()}
    assert all(back[i] == (text or "") for i, text in enumerate(ODD))
    assert tokens.encode(docs.where("doc_id < 0")).collect() == []


def test_no_row_gathers_what_many_blocks_hold(spark, monkeypatch):
    """Blocks are stored in small row groups, and what is found for a block is met as sorted rows, not collected into one."""
    docs = spark.range(6_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("one two "), "id").alias("text")).coalesce(1)  # three blocks
    for made in (tokens.encode(docs), tokens.decode(tokens.encode(docs))):
        assert "collect_list" not in made._jdf.queryExecution().toString() and made.count() == 6_000
    monkeypatch.setattr(tokens, "GROUP", 1_000)
    rows = docs.select(F.col("doc_id").alias("id"), F.split("text", " ").alias("words"))
    at = tokens._blocked(rows, "string", "blocks").inputFiles()[0].removeprefix("file://")
    assert pq.ParquetFile(at).num_row_groups > 1


def test_decode_of_unknown_ids(spark):
    df = spark.createDataFrame([(1, [0, 999_999]), (2, None), (3, [])], "doc_id bigint, ids array<int>")
    assert {r.doc_id: r.text for r in tokens.decode(df).collect()} == {1: None, 2: "", 3: ""}


def clustered(n, d=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d)) * 1.5
    return (centres[rng.integers(0, 12, n)] + rng.normal(size=(n, d))).astype(np.float32)


def exact(x, k=5):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -9)
    return np.argsort(-s, axis=1)[:, :k]


@pytest.mark.parametrize("options", [{}, {"shard_rows": 200, "probes": 3, "sample": 300}])
def test_recall(spark, options):
    x = clustered(1500)
    rows = [(f"v{i:05d}", v.tolist()) for i, v in enumerate(x)]
    odd = [("null", None), ("zero", [0.0] * 16), ("short", [1.0]), ("empty", []), ("nan", [float("nan")] * 16), ("inf", [float("inf")] + [1.0] * 15), (None, [1.0] * 16), rows[0], rows[1]]
    df = spark.createDataFrame(rows + odd, "k string, e array<float>").withColumn("id", F.lit("clash")).withColumn("other", F.lit(1))
    out = hnsw.neighbours(df, "k", "e", 16, k=5, **options)
    found = out.collect()
    assert len(found) == 1500 * 5 and {r["rank"] for r in found} == {1, 2, 3, 4, 5} and all(r.k != r.other for r in found)
    mine = {(r.k, r.other) for r in found}
    want = {(f"v{i:05d}", f"v{j:05d}") for i, row in enumerate(exact(x)) for j in row}
    assert len(mine & want) / len(want) > (0.9 if options else 0.98)
    pairs = [(r.a, r.b) for r in hnsw.pairs(out, "k").collect()]
    assert len(pairs) == len(set(pairs)) and all(a < b for a, b in pairs)


def test_a_search_merges_only_what_can_come_in(monkeypatch):
    """Nodes met that are worse than all that is held were carried along at every step; the nodes found are as many and as good."""
    x = clustered(1500)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    layers, merged, whole = hnsw.build(unit), [], np.argpartition
    def counted(a, *args, **options):
        merged.append(a.size)
        return whole(a, *args, **options)
    monkeypatch.setattr(np, "argpartition", counted)
    ids, sims = hnsw.search(unit, layers, unit, 6, 64)
    monkeypatch.undo()
    want = exact(x)
    assert np.mean([len({*row} & {*found}) / 5 for row, found in zip(want.tolist(), ids.tolist())]) > 0.98
    assert (ids[:, 0] == np.arange(1500)).all() and (np.diff(sims, axis=1) <= 0).all() and all(len({*row}) == 6 for row in ids.tolist())
    assert sum(merged) < 3_000 * 1500


def test_few_vectors(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.0, 1.0])], "k string, e array<float>")
    got = {(r.k, r["rank"]): r.other for r in hnsw.neighbours(df, "k", "e", 2).collect()}
    assert got == {("a", 1): "b", ("a", 2): "c", ("b", 1): "a", ("b", 2): "c", ("c", 1): "a", ("c", 2): "b"}
    assert hnsw.neighbours(df.where("k = 'a'"), "k", "e", 2).collect() == [] and hnsw.neighbours(df.where("k > 'x'"), "k", "e", 2).collect() == []


def leaf(name, lang, weight, room):
    return {"name": name, "path": ["d", lang], "weight": weight, "room": room}


def test_budgets_go_to_siblings_first():
    got = mix.budgets([leaf("a", "en", 0.25, 10), leaf("b", "en", 0.25, 1000), leaf("c", "de", 0.5, 1000)], 100)
    assert got == {"a": 10, "b": 40, "c": 50}
    got = mix.budgets([leaf("a", "en", 0.25, 10), leaf("b", "en", 0.25, 20), leaf("c", "de", 0.5, 1000)], 100)
    assert got == {"a": 10, "b": 20, "c": 70}
    free = mix.budgets([leaf("a", "en", 0.5, 30), leaf("b", "en", 0.3, 1000), leaf("none", "und", 0.2, 0)])
    assert math.isclose(free["a"] / sum(free.values()), 0.625) and free["none"] == 0
    assert mix.budgets([]) == {} and mix.budgets([leaf("x", "und", 1.0, 0)]) == {"x": 0.0}


def test_mix(spark):
    rnd = random.Random(4)
    docs = [(i, " ".join(["word"] * rnd.randint(5, 40)), rnd.choice(["en", "EN", None]), rnd.choice(["big-one", " Big_One ", "BIG ONE"])) for i in range(400)]
    docs += [(1000 + i, "some words here and there", "de", "small") for i in range(6)] + [(2000, None, "en", "small"), (2001, "", None, "small"), (2002, "x", "en", None), (2003, "x", "en", "unwanted")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string").withColumn("tokens", F.lit("clash")).withColumn("epoch", F.lit(1))
    targets = spark.createDataFrame([("big-one", 0.5, None), ("small", 0.3, 4), ("missing", 0.2, 3)], "source string, target_share double, max_repeats int")
    rows = mix.mix(df, targets).collect()
    uses = {}
    for r in rows:
        uses.setdefault(r.source, []).append((r.doc_id, r.epoch))
    assert all(len(set(u)) == len(u) for u in uses.values())
    times = [sum(d == 1000 + i for d, _ in uses["small"]) for i in range(6)]
    assert max(times) == 4 and min(times) == 4 and max(e for _, e in uses["big-one"]) == 0
    got = {r.source: r for r in mix.shares(mix.mix(df, targets), targets).collect()}
    assert abs(got["small"].share - 0.375) < 0.05 and got["missing"].uses == 0 and got["small"].total_tokens == sum(r.tokens for r in rows)
    assert sorted(map(tuple, mix.mix(df, targets).collect())) == sorted(map(tuple, rows))  # seeded
    fixed = mix.shares(mix.mix(df, targets, total=100_000), targets).collect()
    assert sum(r.tokens for r in fixed) <= 100_000  # every document as often as allowed, no more
    assert mix.mix(df.where("doc_id < 0"), targets).collect() == [] and mix.mix(df, targets.where("source = 'x'")).collect() == []


def test_a_repeated_row_that_begins_two_blocks_changes_no_other_ids(spark, monkeypatch):
    one = spark.createDataFrame([(1, "the first row"), (2, "something else, entirely")], "doc_id bigint, text string").coalesce(1)
    two = spark.createDataFrame([(1, "the first row"), (3, "yet another text of the corpus")], "doc_id bigint, text string").coalesce(1)
    both = one.union(two)
    tokenizer = tokens._tokenizer(tokens.TOKENIZER)
    want = sorted((r.doc_id, tokenizer.encode(r.text, add_special_tokens=False).ids) for r in both.collect())
    encoded = tokens.encode(both)
    assert sorted((r.doc_id, r.ids) for r in encoded.collect()) == want
    assert sorted((r.doc_id, r.text) for r in tokens.decode(encoded).collect()) == sorted((r.doc_id, r.text) for r in both.collect())
    odd = spark.createDataFrame([(1, [0, 60_000]), (2, None), (3, []), (4, [None]), (5, [72, 101])], "doc_id bigint, ids array<int>").withColumn("at", F.lit(1))
    got = {r.doc_id: r.text for r in tokens.decode(odd).collect()}
    assert got[1] is None and got[2] == got[3] == "" and got[4] is None and len(got[5]) == 2


@pytest.mark.skipif(not os.path.exists(VECTORS), reason="the test tables are not here")
def test_recall_with_far_more_clusters_than_probes(spark):
    v = spark.read.parquet(VECTORS).select("id", "embedding")
    found = hnsw.neighbours(v, "id", "embedding", 48, k=5, shard_rows=50)
    rows = hnsw.valid(v, "id", "embedding", 48).collect()
    ids, x = np.array([r.id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    assert len(ids) / 50 >= 70 > 3 * hnsw.probes_of(80)
    want = {(ids[i], ids[j]) for i, row in enumerate(exact(x)) for j in row}
    got = {(r.id, r.other) for r in found.collect()}
    recall = len(got & want) / len(want)
    assert recall >= 0.95, recall


def test_mix_that_runs_short(spark):
    """Shares are exact where nothing is short; where a source is, its siblings of the same domain and language take its share first, then the other domain."""
    def docs(at, n, source, lang):
        return [(at + i, "some words here and there", lang, source) for i in range(n)]
    df = spark.createDataFrame(docs(0, 40, "a1", "en") + docs(100, 200, "a2", "en") + docs(400, 60, "b1", "de"), "doc_id bigint, text string, lang string, source string")
    targets = spark.createDataFrame([("a1", 0.4, 2, "a"), ("a2", 0.2, 2, "a"), ("b1", 0.4, 3, "b")], "source string, target_share double, max_repeats int, domain string")
    each = 5
    got = {r.source: (r.uses, r.total_tokens) for r in mix.shares(mix.mix(df, targets, total=300 * each), targets).collect()}
    assert got["a1"][0] == 80 and got["a2"][0] == 100 and got["b1"][0] == 120  # a1 gives all it may, its sibling takes the rest, b1 has its own share
    rows = mix.mix(df, targets, of_room=0.9).collect()  # 594 of 660: b1 too is short
    uses = {s: sum(r.source == s for r in rows) for s in ("a1", "a2", "b1")}
    assert uses == {"a1": 80, "a2": 334, "b1": 180} and max(r.epoch for r in rows) == 2 and len({(r.doc_id, r.epoch) for r in rows}) == len(rows)


def test_router_finds_the_nearest_clusters():
    x = clustered(3000, d=12).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    router = hnsw.Router(x[:1000], 60)
    near = router.nearest(x, 5)
    sims = x @ router.lower.T
    best = np.argsort(-sims, axis=1)[:, :5]
    assert (near[:, 0] == best[:, 0]).mean() > 0.95 and np.mean([len(set(a) & set(b)) for a, b in zip(near, best)]) > 4.5
    assert hnsw.probes_of(1) == hnsw.probes_of(4) == 4 and hnsw.probes_of(10_000) == 150
    assert len(hnsw.Router(x[:1], 1)) == 1 and hnsw.Router(x[:3], 9).nearest(x[:2], 4).shape[0] == 2
