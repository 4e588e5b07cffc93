import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import cap, history
from quern.llm.common import name_key, page_key, with_podcast


def kept(spark, rows, limits, schema="c string, s double, i bigint"):
    out = cap.cap(spark.createDataFrame(rows, schema), ["c"], "s", "i", spark.createDataFrame(limits, "c string, cap int"))
    return sorted((r.c or "", r.i) for r in out.where("kept").collect())


def test_cap_equals_sorting(spark):
    rnd = random.Random(1)
    scores = [None, float("nan"), -0.0, 0.0, -1.5, 2.5, float("inf"), float("-inf"), 1e-310, 0.1, 0.1, 1e300]
    rows = [(rnd.choice("abc"), rnd.choice(scores), i - 20) for i in range(120)]
    caps = {"a": 1, "b": 7, "c": 0}
    rank = lambda s: (1, 0) if s is None or s != s else (0, -s)
    want = []
    for c, n in caps.items():
        want += [(c, i) for _, i in sorted((rank(s), i) for k, s, i in rows if k == c)[:n]]
    assert kept(spark, rows, list(caps.items())) == sorted(want)


def test_cap_edges(spark):
    rows = [(None, 1.0, 1), ("x", None, 2), ("x", None, 1), ("y", 1.0, 5), ("z", 1.0, 6), ("z", 1.0, 6), ("z", 0.5, 7)]
    assert kept(spark, rows, [("x", 1), ("y", None), ("z", 1)]) == [("", 1), ("x", 1), ("y", 5), ("z", 6), ("z", 6)]
    assert kept(spark, [], [("x", 1)]) == [] and kept(spark, rows[:2], []) == [("", 1), ("x", 2)]
    clash = spark.createDataFrame([("x", 1.0, 1, "k", "g"), ("x", 2.0, 2, "k", "g")], "c string, s double, i bigint, _k string, _g0 string")
    out = cap.cap(clash, ["c"], "s", "i", spark.createDataFrame([("x", 1)], "c string, cap int")).where("kept").collect()
    assert [(r.i, r._k, r._g0) for r in out] == [(2, "k", "g")]


def test_names(spark):
    series = spark.createDataFrame([("The Copper Mill", "the-copper-mill"), ("Café & Tide", "cafe-tide"), ("Wild Vault", "wild-vault"), ("Wild Vaults", "wild-vaults"), (None, "bare"), ("x", None)], "title string, slug string")
    titles = ["tHE cOPPER mILL", "Copper Mill", "Ｔｈｅ Ｃｏｐｐｅｒ Ｍｉｌｌ", "CAFÉ AND TIDE - Page 3", "Cofpe", "Coper Mill", "Copepr Mill", "wild-vault", "Wild Vaul", "Wild Vaulst", "", None, "  ", "nothing like it"]
    docs = spark.createDataFrame([(i, t, "bare" if i == 10 else "none" if i == 13 else None) for i, t in enumerate(titles)], "i int, podcast_title string, s string")
    got = {r.i: r.podcast for r in with_podcast(docs, series, slug=F.col("s")).collect()}
    mill = "the-copper-mill"
    assert got == {0: mill, 1: mill, 2: mill, 3: "cafe-tide", 4: None, 5: mill, 6: mill, 7: "wild-vault", 8: "wild-vault", 9: "wild-vaults", 10: "bare", 11: None, 12: None, 13: None}
    assert spark.range(1).select(name_key(F.lit("The  Furnace’s Candle!"))).first()[0] == "furnaces candle"


def test_pages(spark):
    same = ["https://h.example/e/a-1", "http://www.h.example:443/e/a-1/", " https://H.EXAMPLE/e/a-1?utm_source=x#t=1", "//h.example/e/a-1", "h.example/e//a-1"]
    other = ["https://h.example/e/A-1", "https://h.example/listen?episode=1", "https://h.example/listen?x=2&episode=1", None, " "]
    rows = spark.createDataFrame([(u,) for u in same + other], "u string").select(page_key(F.col("u"))).collect()
    keys = [r[0] for r in rows]
    assert set(keys[:5]) == {"/e/a-1"} and keys[5] == "/e/A-1" and keys[6] == keys[7] == "/listen?1" and keys[8:] == [None, None]


def text(seed, n=80):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghijklm") for _ in range(5)) for _ in range(n))


def edited(t, every=20):
    return " ".join("edit" if i % every == every - 1 else w for i, w in enumerate(t.split()))


def test_history(spark):
    rows = [
        (1, 0, "https://h/e/1", text(1)), (2, 0, None, text(2)), (3, 0, None, None), (4, 0, None, ""), (5, 0, None, text(1)),
        (6, 1, "http://www.h/e/1/", "short"), (7, 1, None, edited(text(2))), (8, 1, None, edited(text(2), 6)), (9, 1, None, text(3)), (10, 1, None, text(3)), (11, 1, "", ""),
        (12, 2, None, text(3).upper()), (13, 2, "https://h/e/2", None), (14, None, "https://h/e/1", text(1)), (12, 2, None, text(3).upper()),
        (15, 2, None, text(2) + " " + " ".join(text(50 + i, 400) for i in range(5))),
    ]
    docs = spark.createDataFrame(rows, "r bigint, b int, u string, t string").withColumn("id", F.lit("clash")).withColumn("fp", F.lit(1))
    got = [r.r for r in history.repeats(docs, "r", "b", "t", "u", shingle=3, similarity=0.6).collect()]
    assert sorted(got) == [6, 7, 12]
    assert history.repeats(docs.where("b > 5"), "r", "b", "t", "u").collect() == []


def test_prints_of_many_histories_are_looked_up_when_needed(spark, monkeypatch):
    monkeypatch.setattr(history, "CARRIED", 0)
    rows = [(i, 0, None, edited(text(1), 20 + i)) for i in range(5)] + [(10, 1, None, edited(text(1))), (11, 1, None, text(9))]
    got = history.repeats(spark.createDataFrame(rows, "r bigint, b int, u string, t string"), "r", "b", "t", "u", shingle=3, similarity=0.6).collect()
    assert [r.r for r in got] == [10]


def shingled(t):
    w = t.lower().split()
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


@pytest.mark.parametrize("options", [{}, {"prints": None, "coverage": 0.0}])
def test_history_equals_brute_force(spark, options):
    """Variants of few texts with a notice that all of them hold, at the defaults and by the exact way."""
    rnd = random.Random(5)
    notice = text(99, 30)
    def variant(seed):
        w = text(seed, 90).split()
        for _ in range(rnd.randint(0, 9)):
            i = rnd.randrange(len(w))
            w[i : i + rnd.randint(0, 1)] = ["changed"] * rnd.randint(0, 2)
        return " ".join(w) + " " + notice
    rows = [(i, i // 40, None, variant(rnd.randrange(25))) for i in range(120)]
    sets = {i: (b, shingled(t)) for i, b, _, t in rows}
    want = {i for i, (b, s) in sets.items() if any(c < b and len(s & o) >= 0.6 * len(s | o) - 1e-9 for c, o in sets.values())}
    docs = spark.createDataFrame(rows, "r bigint, b int, u string, t string")
    assert {r.r for r in history.repeats(docs, "r", "b", "t", "u", shingle=3, similarity=0.6, **options).collect()} == want and 20 < len(want) < 80


def test_histories_without_a_common_run_are_found(spark):
    """Blocks of four words in another order: the same three-word sequences but for the ends, and no run of eight words in common."""
    name = lambda i: f"{'abcdefghij'[i // 10]}{'klmnopqrst'[i % 10]}"
    blocks = [f"hub {name(i)} {name(i + 40)} hub" for i in range(40)]
    rows = [(1, 0, None, " ".join(blocks)), (2, 0, None, text(4)), (3, 1, None, " ".join(blocks[::-1])), (4, 1, None, text(5)), (5, 2, None, " ".join(blocks[:20]))]
    got = history.repeats(spark.createDataFrame(rows, "r bigint, b int, u string, t string"), "r", "b", "t", "u", shingle=3, similarity=0.6).collect()
    assert [r.r for r in got] == [3]


def test_store_is_opened_again(spark, tmp_path):
    at, shape = str(tmp_path / "store"), "r bigint, u string, t string"
    def take(rows):
        store = history.Store(spark, at, shingle=3, similarity=0.6)
        return sorted(r.r for r in store.take(spark.createDataFrame(rows, shape), "r", "t", "u").collect())
    assert take([(1, "https://h/e/1", text(1)), (2, None, text(2))]) == []
    assert take([(3, "http://h/e/1/", "short"), (4, None, edited(text(2))), (5, None, text(3))]) == [3, 4]
    # A batch that was cut off before its end leaves tables but no commit: it counts for nothing and its number is used again.
    whole = history.Store(spark, at, shingle=3, similarity=0.6)
    cut = spark.createDataFrame([(6, None, text(4))], shape)
    whole.spark = Cut(spark)
    with pytest.raises(RuntimeError):
        whole.take(cut, "r", "t", "u")
    assert (tmp_path / "store" / "prints" / "batch=2").exists()
    assert take([(7, None, text(4)), (8, None, text(3).upper())]) == [8]
    assert take([(9, None, text(4))]) == [9]
    with pytest.raises(ValueError):
        history.Store(spark, at, shingle=5)
    import shutil
    shutil.rmtree(tmp_path / "store" / "filters" / "batch=0")
    with pytest.raises(Exception, match="cannot be seen"):
        take([(10, None, text(60))])


class Cut:
    """A session that fails at the commit of a batch."""

    def __init__(self, spark):
        self._spark = spark

    def __getattr__(self, name):
        return getattr(self._spark, name)

    def range(self, *args):
        if args == (1,):
            raise RuntimeError("cut off")
        return self._spark.range(*args)


def test_hot_prints_are_looked_up_whatever_else_a_text_holds(spark):
    """An edited copy of a text that over FREQUENT histories hold in variants, with over half of its prints its own; FREQUENT as it is."""
    base = text(1, 240).split()
    def copy(seed, places):
        return " ".join(f"edit{'abcdefghij'[seed % 10]}{'abcdefghij'[seed // 10 % 10]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i % 10]}" if i in places else w for i, w in enumerate(base))
    rows = [(i, 0, None, copy(i, {i * 3})) for i in range(60)] + [(100 + i, 0, None, text(2, 240)) for i in range(60)]
    rows += [(200 + i, 1, None, copy(60 + i, set(range(i, 240, 15)))) for i in range(10)] + [(300, 1, None, text(2, 240)), (301, 1, None, text(3)), (302, 2, None, text(2, 240).upper())]
    docs = spark.createDataFrame(rows, "r bigint, b int, u string, t string")
    got = sorted(r.r for r in history.repeats(docs, "r", "b", "t", "u", shingle=3, similarity=0.6).collect())
    assert got == [*range(200, 210), 300, 302]


def test_history_keeps_the_prints_of_equal_texts_once(spark, tmp_path):
    store = history.Store(spark, str(tmp_path / "h"), shingle=3, similarity=0.6)
    for n in range(3):
        got = store.take(spark.createDataFrame([(10 * n + i, None, text(1)) for i in range(4)], "r bigint, u string, t string"), "r", "t", "u")
        assert sorted(r.r for r in got.collect()) == ([10 * n + i for i in range(4)] if n else [])
    assert spark.read.schema("id bigint").option("recursiveFileLookup", "true").parquet(*store._at("sets")).distinct().count() == 1


def test_shared_counts():
    rnd = random.Random(3)
    rows = [({rnd.randrange(-9, 9) for _ in range(rnd.randint(0, 8))}, {rnd.randrange(-9, 9) for _ in range(rnd.randint(0, 8))}) for _ in range(200)]
    def laid(k):
        return np.array([x for r in rows for x in sorted(r[k])], np.int32), np.concatenate([[0], np.cumsum([len(r[k]) for r in rows])])
    assert history.shared_counts(*laid(0), *laid(1)).tolist() == [len(a & b) for a, b in rows]
    none = np.zeros(0, np.int32)
    assert history.shared_counts(none, np.array([0, 0]), none, np.array([0, 0])).tolist() == [0]


def test_buckets_follow_the_partitions_and_stay(spark, tmp_path):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        assert history.Store(spark, str(tmp_path / "s")).buckets == 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert history.Store(spark, str(tmp_path / "s")).buckets == 20
    with pytest.raises(ValueError):
        history.Store(spark, str(tmp_path / "s"), buckets=4)


def test_shuffled_files_of_the_last_write_are_let_go(spark, tmp_path):
    """The listeners' last event refers to the last write, whose files would stay until there is another."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: set(disk.getAllFiles().mkString("\n").split("\n"))
    history.let_go(spark)
    before = held()
    spark.range(10_000).repartition(3, "id").write.parquet(str(tmp_path / "t"))
    made = held() - before
    assert any("shuffle_" in f for f in made)
    history.let_go(spark)
    until = time.time() + 20
    while held() & made and time.time() < until:
        time.sleep(0.2)
    assert not held() & made
