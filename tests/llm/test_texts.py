import functools
import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import regex
from pyspark.sql import functions as F

from quern.llm import mainbody, signature, sitelines, spam, turns
from quern.llm.common import words
from quern.llm.grams import word_hashes
from quern.llm.signature import tree_join

DOCUMENTS = "/root/testdata/sf0.1/documents.parquet"
PEOPLE = [(1, "p", "Edda Calbry", "host"), (2, "p", "Greta Zelhurst", "producer"), (3, "p", "Linnea Holstedt", "guest"), (4, "p", "Orla Sanmoor", "guest")]


def said(spark, rows, text=True):
    seg = spark.createDataFrame(rows, "doc_id string, podcast_slug string, segment_no int, timestamp string, text string").withColumn("speaker", F.lit("clash"))
    people = spark.createDataFrame(PEOPLE, "speaker_id bigint, podcast_slug string, full_name string, speaker_role string")
    out = turns.turns(seg, people, with_text=text).orderBy("doc_id", "turn_no").collect()
    return [(r.doc_id, r.turn_no, r.speaker_id, r.start_seconds, *([r.text] if text else [])) for r in out]


def test_turns(spark):
    rows = [
        ("d", "p", 1, "00:00:01.9", "E. Calbry: One um, two. >> Greta: three"),
        ("d", "p", 2, "[0:05]", "(laughter)"),
        ("d", "p", 3, "--:--", "four <crosstalk> five"),
        ("d", "p", 3, "--:--", "four <crosstalk> five"),
        ("d", "p", 5, "00:00:03", "HOST - late"),
        ("d", "p", 6, "00:00:09 --> 00:00:11", "Zelhusrt, Greta: Uh."),
        ("d", "p", 7, "00:00:12", "Quick question: who said: yes?"),
        ("d", "p", 8, "00:00:12", "Quick question: who said: yes?"),
        ("d", "p", 9, None, "**Linnea Holstedt:** [music]"),
        ("d", "p", 10, "1:00:00", "[Orla Sanmoor]"),
        ("d", "p", 11, "1:00:01", "last"),
        ("e", None, 1, None, "Edda: nobody known"),
        ("f", "p", 1, "x", None),
        (None, "p", 1, "0:01", "no document"),
    ]
    got = said(spark, rows)
    assert got == [
        ("d", 1, 1, 1, "One two."), ("d", 2, 2, 1, "three"), ("d", 3, 1, 3, "late four five"), ("d", 4, 2, 12, "Quick question: who said: yes?"), ("d", 5, 4, 3601, "last"),
        ("e", 1, None, None, "Edda: nobody known"),
    ]
    assert [g[:4] for g in got] == said(spark, rows, text=False)
    assert said(spark, []) == []


def test_long_document_in_blocks_equals_one_pass(spark):
    rnd = random.Random(3)
    rows, now, want, speaker = [], 0, [], None
    for i in range(2500):
        now += rnd.randint(1, 3)
        label = rnd.choice(["", "", "", "Edda: ", "Greta: "])
        body = rnd.choice(["", f"word{i}"])
        rows.append(("d", "p", i, f"{now // 3600}:{now // 60 % 60:02d}:{now % 60:02d}", label + body))
        speaker = {"E": 1, "G": 2}.get(label[:1], speaker)
        if body and (not want or want[-1][0] != speaker):
            want.append((speaker, now))
    rnd.shuffle(rows)
    assert [(g[2], g[3]) for g in said(spark, rows, text=False)] == want


CREW = turns.People([(i, name, role) for i, _, name, role in PEOPLE])
AMBIGUOUS = [
    ("(Edda) I laughed. (laughs) Then [crosstalk] it was over.", [(None, ""), (1, "I laughed. Then it was over.")]),
    ("Two words: the harbour. Then I met Greta - and Edda: both were late.", [(None, "Two words: the harbour. Then I met Greta - and Edda: both were late.")]),
    ("Greta, if you are listening: come home.", [(None, "Greta, if you are listening: come home.")]),
    ("Um, host - er, hello. *applause* >> O. Sanmoor: thanks", [(None, ""), (1, "hello."), (4, "thanks")]),
    ("**Calbry, Edda (host):** It was the host: nobody else.", [(None, ""), (1, "It was the host: nobody else.")]),
]


def test_ambiguous_marks_are_decided_by_the_path():
    model = turns.Model.prior()
    got = turns.parts_of([t for t, _ in AMBIGUOUS], [CREW] * len(AMBIGUOUS), model)
    assert [[(w, " ".join(s.split())) for w, s in parts] for parts in got] == [want for _, want in AMBIGUOUS]


def test_without_transitions_or_names_the_tags_are_others():
    """The states' order and the weak evidence of names both decide: taking either away changes the tags."""
    model, seen = turns.Model.prior(), [turns.observe(t, CREW) for t, _ in AMBIGUOUS]
    paths = model.decode([s for _, s in seen])
    alone = [model.emit[:, s].argmax(0) for _, s in seen]
    tag = lambda path: [turns.TAG_OF[k] for k in path]
    assert any(tag(p) != tag(a) for p, a in zip(paths, alone))
    nobody = [turns.observe(t, turns.People([])) for t, _ in AMBIGUOUS]
    assert any(tag(p) != tag(q) for p, q in zip(paths, model.decode([s for _, s in nobody])))
    assert [len(p) for p in model.decode([np.zeros(0, np.int64), seen[0][1][:1], seen[0][1][:5]])] == [0, 1, 5]


def words_of(t):
    return [w.lower() for w in regex.findall(r"\p{L}+", t)]


def shingles(t, n=3):
    w = words_of(t)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def variant(rnd, base):
    w = base.split()
    for _ in range(rnd.randint(0, 9)):
        i = rnd.randrange(len(w))
        w[i : i + rnd.randint(0, 1)] = [rnd.choice(["x", "new", "Wort"])] * rnd.randint(0, 2)
    return " ".join(w)


def corpus(n=120):
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(4)) for _ in range(60)]
    bases = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([45, 80, 300]))) for _ in range(n // 4)]
    return [(i, variant(rnd, rnd.choice(bases))) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, "too short"), (n + 3, bases[0]), (n + 4, bases[0]), (n + 4, bases[0])]


def brute(rows, least=40, t=0.6):
    docs = {i: shingles(x) for i, x in rows if x and len(words_of(x)) >= least}
    return {(a, b) for a in docs for b in docs if a < b and len(docs[a] & docs[b]) >= t * len(docs[a] | docs[b]) - 1e-9}


@pytest.mark.parametrize("small", [False, True])
def test_alike_pairs_equal_brute_force(spark, monkeypatch, small):
    if small:  # every group is frequent and split into cells, and trees have more than a leaf
        for name, value in {"FREQUENT": 0, "CELL": 3, "LEAF": 1}.items():
            monkeypatch.setattr(signature, name, value)
    rows = corpus()
    docs = spark.createDataFrame(rows, "r bigint, t string").withColumn("id", F.lit("clash")).withColumn("a", F.lit(0))
    got = [(r.a, r.b) for r in signature.alike_pairs(docs, "r", "t", 3, 0.6).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    if not small:  # with all runs, by the exact way
        assert {(r.a, r.b) for r in signature.alike_pairs(docs, "r", "t", 3, 0.6, runs=None).collect()} == brute(rows)
    classes = {r.r: r for r in signature.alike_classes(docs, "r", "t", 3, 0.6).collect()}
    assert classes[124].class_id == classes[123].class_id and 120 not in classes
    assert signature.alike_pairs(docs.where("r > 1000"), "r", "t").collect() == []


def test_links_of_a_hot_group_are_kept(spark):
    """Over FREQUENT variants of a text, and some with so many edits of their own that most of their runs are unique and the rest frequent."""
    rnd = random.Random(11)
    base = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" for c in "klmnprst"]
    edit = lambda: "".join(rnd.choice("vwxyz") for _ in range(9))
    rows = []
    for i in range(230):
        w = list(base)
        for at in [rnd.randrange(len(w))] if i < 222 else range(7, len(w), 15):
            w[at] = edit()
        rows.append((i, " ".join(w)))
    got = [(r.a, r.b) for r in signature.alike_pairs(spark.createDataFrame(rows, "r bigint, t string"), "r", "t", 3, 0.6).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows) and {i for p in got for i in p} == set(range(230))


def test_alike_texts_without_a_common_run_are_found(spark):
    """Equal shingle sets but for their ends, in blocks of four words that stand in another order: no run of eight words is shared."""
    rnd = random.Random(3)
    a = lambda i: f"{'abcdefghij'[i // 10]}{'klmnopqrst'[i % 10]}"
    blocks = [["hub", a(i), a(i + 40), "hub"] for i in range(40)]
    rows = [(1, " ".join(sum(blocks, []))), (2, " ".join(sum(blocks[::-1], []))), *((10 + i, variant(rnd, " ".join(sum(rnd.sample(blocks, 30), [])))) for i in range(20))]
    runs = [{tuple(w[i : i + 8]) for i in range(len(w) - 7)} for w in (words_of(t) for _, t in rows[:2])]
    got = [(r.a, r.b) for r in signature.alike_pairs(spark.createDataFrame(rows, "r bigint, t string"), "r", "t", 3, 0.6).collect()]
    assert not runs[0] & runs[1] and (1, 2) in got and len(got) == len(set(got)) and set(got) == brute(rows)


def test_a_value_for_each_text_goes_to_the_kernels(spark):
    """Not one for each word, which took half as much memory again; the words, their hashes and their sets are the same."""
    texts = ["One two TWO, one", "a b c d", "too short", None, "ein zwei drei ein zwei drei vier"]
    got = signature.texts_of(spark.createDataFrame(list(enumerate(texts)), "r int, t string"), "r", "t", 4)
    assert dict(got.dtypes)["words"] == "string"
    joined = [r.words for r in sorted(got.collect(), key=lambda r: r.id)]
    assert joined == ["one two two one", "a b c d", "ein zwei drei ein zwei drei vier"]
    h, off = signature.hashed_words(pa.array(joined))
    assert off.tolist() == [0, *np.cumsum([len(t.split(" ")) for t in joined])]
    assert h.tolist() == word_hashes(pa.array(" ".join(joined).split(" "))).tolist()
    values, at = signature.per_text(h, off)
    assert [values[a:b].tolist() for a, b in zip(at, at[1:])] == [np.unique(h[a:b]).tolist() for a, b in zip(off, off[1:])]
    assert [x.tolist() for x in signature.per_text(h[:0], np.array([0, 0, 0]))] == [[], [0, 0, 0]]


def test_blocks_of_first_shingles_meet_as_single_rows_do(monkeypatch):
    """Blocks, not rows of single shingles, go to the tasks that compare them; a frequent top takes no more memory than tells so."""
    rnd = random.Random(5)
    texts = [(i, rnd.randint(20, 60), rnd.sample(range(-3, 300), rnd.randint(0, 12)) + [2**31 - 1] * (i % 2) + [-(2**31)] * (i < 9)) for i in range(500)]
    texts[7] = (7, 40, [299, 299])  # equal bits of two shingles of one text
    kind = pa.schema([("id", pa.int64()), ("n", pa.int32()), ("tops", pa.list_(pa.int32()))])
    batch = pa.RecordBatch.from_pylist([dict(zip(kind.names, x)) for x in texts], kind)
    monkeypatch.setattr(signature, "TOPS", 1_000)
    blocks = [b for part in (batch.slice(0, 200), batch.slice(200), batch.slice(500)) for b in signature._top_blocks(5)([part])]
    assert sum(b.num_rows for b in blocks) <= 5 * len(blocks) <= 5 * 6
    assert sum(len(x) // 20 for b in blocks for x in b.column(1).to_pylist()) == sum(len(x[2]) for x in texts)
    in_bucket = lambda made, k: pa.Table.from_batches(made).filter(pc.field("bucket") == k).to_batches(max_chunksize=1)
    monkeypatch.setattr(signature, "TOPS", 20)  # thinned again and again
    monkeypatch.setattr(signature, "MEETINGS", 400)
    met = [b for k in range(5) for b in signature._meet_kernel(0.6, 3, 50)(in_bucket(blocks, k))]
    found = [x for b in met for block in b.column(1).to_pylist() if block for x in zip(*(c.tolist() for c in signature._unpacked([block], signature.MEETING)))]
    frequent = [t for b in met for t in b.column(2).to_pylist() if t is not None]
    often = [(r["a"], r["b"]) for k in range(3) for b in signature._often(iter(in_bucket(met, k))) for r in b.to_pylist()]
    places = {}
    for i, n, tops in texts:
        for place, top in enumerate(tops):
            places.setdefault(top, []).append((i, n, n - place))
    assert frequent == [2**31 - 1] and len(places[2**31 - 1]) == 249
    expected = []
    for top, rows in places.items():
        for x, (i, n, rest) in enumerate(rows) if len(rows) <= signature.FREQUENT else ():
            for j, m, other in rows[x + 1 :]:
                fits, least = signature.meet(np.array([n]), np.array([rest]), np.array([m]), np.array([other]), 0.6)
                expected += [(min(i, j), max(i, j), int(least[0]))] * int(fits[0] and i != j)
    assert expected and sorted(found) == sorted(expected)
    enough = {(a, b) for (a, b, least), c in Counter(expected).items() if c >= least}
    assert enough and len(often) == len(set(often)) and set(often) == enough | {(2**31 - 1, None)}


def test_words_of_texts_are_those_of_words(spark):
    """The words are joined without an array of them; they are the same in any script, and so is their number."""
    odd = ["ΟΔΥΣΣΕΥΣ ΣΑΣ Σ, Σ'ΑΣ'Σ ΑΣ́Α", "İstanbul IŞIK ıI", "Džungla Džǅ", "𝐀𝐁 𐐀𐐁x", "  lead trail  ", " ", "", "a", "-a--b-", "a b\u3000c\tD\nE", "A1B2C3", "ẞ ŒUVRE ﬁ", "日本語テキスト、ラー", "नमस्ते दुनिया", "a\u0000b", "Σ\u00adΣ", None]
    docs = spark.createDataFrame(list(enumerate(odd)), "r int, t string")
    want = {r.r: r.w for r in docs.select("r", words(F.col("t")).alias("w")).collect()}
    for least in (0, 1, 2, 3):
        got = {r.id: r.words for r in signature.texts_of(docs, "r", "t", least).collect()}
        assert got == {i: " ".join(w) for i, w in want.items() if w is not None and len(w) >= least}


def test_tree_prunes_without_loss():
    rnd = np.random.default_rng(1)
    sets = [set(rnd.integers(0, 400, rnd.integers(20, 60)).tolist()) for _ in range(150)]
    sets += [s | {1000 + i} for i, s in enumerate(sets[:40])]
    sets.sort(key=len)
    values = np.array([v for s in sets for v in sorted(s)], np.uint64)
    off = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    sizes = np.diff(off)
    signs = signature.Signatures(signature.bitmaps(values, off))
    i, j = tree_join(signs.at(np.arange(len(sets)), 512), sizes, 0.6)
    i, j = signature.survivors(signs, sizes, i, j, 0.6)
    found = set(zip(i.tolist(), j.tolist()))
    assert len(found) < len(sets) * (len(sets) - 1) / 2
    assert all((a, b) in found for a in range(len(sets)) for b in range(a + 1, len(sets)) if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b]))


def test_repeated_lines(spark):
    rows = [(i, "s", f"{'x' * (i % 3)} own line number word{'abcdefghijkl'[i]} here\n  Share THIS page, with friends!  \n\nshort one\n" + ("this longer legal notice returns in every single document of the source again\n" if i < 6 else "")) for i in range(12)]
    rows += [(20, "s", None), (21, "s", ""), (22, None, "share this page with friends"), (23, "t", "share this page with friends"), (24, "s", "share this page with friends\nshare this page with friends"), (24, "s", "share this page with friends\nshare this page with friends")]
    docs = spark.createDataFrame(rows, "r bigint, p string, t string").withColumn("id", F.lit("clash")).withColumn("source", F.lit("clash"))
    got = Counter((r.r, r.line_no) for r in sitelines.repeated_lines(docs, "r", "p", "t").collect())
    assert set(got) == {(i, 2) for i in range(12)} | {(i, 5) for i in range(6)} | {(24, 1), (24, 2)}
    out = {r.r: r.t for r in sitelines.remove_lines(docs, sitelines.repeated_lines(docs, "r", "p", "t"), "r", "t").collect()}
    assert out[24] == "" and out[20] is None and out[7].startswith("x own line") and "Share" not in out[7] and out[22] == "share this page with friends"
    assert sitelines.repeated_lines(docs.where("r > 99"), "r", "p", "t").collect() == []


def test_chunks_are_found_across_line_breaks(spark):
    rnd = random.Random(5)
    notice = " ".join("".join(rnd.choice("abcdef") for _ in range(6)) for _ in range(60))
    own = lambda i: " ".join("".join(random.Random(i * 100 + k).choice("ghijkl") for _ in range(6)) for k in range(40))
    rows = [(i, "s", own(i) + " " + notice.replace(" ", "\n" if i % 2 else " ") + " " + own(i + 50)) for i in range(8)] + [(9, "s", None), (10, None, notice)]
    out = {r.r: r for r in sitelines.cut_chunks(spark.createDataFrame(rows, "r bigint, p string, t string"), "r", "p", "t").collect()}
    assert all(len(set(notice.split()) & set(out[i].t.split())) < 25 and out[i].cut >= 2 for i in range(8))
    left = sum(len(set(notice.split()) & set(out[i].t.split())) for i in range(8)) / (8 * 60)
    assert left <= 0.3  # of 60 words, those of the chunks at both ends stay
    assert all(len(set(own(i).split()) - set(out[i].t.split())) == 0 for i in range(8)) and out[9].t is None and out[10].t == notice


def test_chunks_count_documents_not_rows(spark):
    """A chunk in two documents, one of them in six rows, is in two documents."""
    body = " ".join(f"word{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}" for i in range(60))
    rows = [(1, "s", body)] * 6 + [(2, "s", body), (3, "s", "something else entirely, and nothing more than that")]
    docs = spark.createDataFrame(rows, "r bigint, p string, t string")
    assert {r.cut for r in sitelines.cut_chunks(docs, "r", "p", "t").collect()} == {0}
    assert sitelines.repeated_lines(docs, "r", "p", "t").collect() == []
    assert {r.r for r in sitelines.cut_chunks(docs, "r", "p", "t", least_docs=2).where("cut > 0").collect()} == {1, 2}


@pytest.mark.parametrize("mean", [1, 2, 4, 50])
def test_lines_come_through_chunks_without_loss(spark, monkeypatch, mean):
    """Whatever the chunks' size, and so however many lines go straight to the exact count, the lines found are those that return."""
    monkeypatch.setattr(sitelines._document_chunks, "__defaults__", (2, mean))
    rnd = random.Random(9)
    vocabulary = ["".join(rnd.choice("abcdef") for _ in range(5)) for _ in range(300)]
    line = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    common = [line(n) for n in (4, 5, 8, 14, 30, 60)]
    rows = []
    for i in range(30):
        own = [line(rnd.randint(1, 25)) for _ in range(6)] + [c.upper() if i % 2 else c for c in common if rnd.random() < 0.4]
        rnd.shuffle(own)
        rows.append((i, "s", "\n".join(own)))
    count = Counter(key for _, _, t in rows for key in {tuple(words_of(x)) for x in t.split("\n")})
    want = {(i, k + 1) for i, _, t in rows for k, x in enumerate(t.split("\n")) if len(words_of(x)) >= 4 and count[tuple(words_of(x))] >= 5}
    got = {(r.r, r.line_no) for r in sitelines.repeated_lines(spark.createDataFrame(rows, "r bigint, p string, t string"), "r", "p", "t").collect()}
    assert got == want and len(want) > 30


PAGE = """Skip to content
Home  Episodes  Categories
Home › Music › How to mend a library
Accept all
This site and its 193 partners use cookies to improve ads and pick content near you.
[00:00:01] Edda Calbry: Welcome back, everyone, this is the show about cookies and how to bake them.
[00:00:05] Right.
(laughter)
[00:00:09] Greta:
He walked along the river until the
bridge came into view at last.
[00:00:20] Subscribe
You can bake cookies in an oven if the kitchen is warm.
Listeners also played
How to repair an oven (12:30)
The narrow map of Quenby
Tags: travel, music, law
https://h.example/people/a?page=2
0:00 / 29:27
© 2024 Cast Ltd. All rights reserved."""


def transcripts(n):
    """Transcripts with times, and page lines, most of them without, around and within them."""
    rnd = random.Random(8)
    nouns, verbs = ["harbour", "teacher", "garden", "lantern", "engine", "letter", "village", "oven", "compass", "tailor"], ["found", "sold", "painted", "carried", "mended", "walked along", "baked"]
    spoken = ["When the {a} was {v}, nobody in the {b} had any idea.", "You can {v} a {a} if the {b} is warm.", "He {v} the {a} until the {b} came into view at last.", "Welcome back, everyone, this is the show about {a} and {b}.", "Right.", "Greta: And what would you say about cookies in a {a}?", "Edda Calbry: I {v} that {a}, and {b} too.", "(laughter)", "Edda:"]
    page = ["Skip to content", "Home  Episodes  Categories", "Home › {a} › How to mend a {b}", "Accept all", "This site and its {n} partners use cookies to improve ads and pick content near you.", "Subscribe", "Listeners also played", "How to repair a {a} ({n}:30)", "The narrow {a} of {b}", "Tags: {a}, {b}, law", "https://h.example/{a}/{b}?page={n}", "0:00 / {n}:27", "© 20{n} Cast Ltd. All rights reserved."]
    fill = lambda t: t.format(a=rnd.choice(nouns), b=rnd.choice(nouns), v=rnd.choice(verbs), n=rnd.randint(10, 59))
    rows = []
    for i in range(n):
        lines = [f"[00:{k // 60:02d}:{k % 60:02d}] {fill(rnd.choice(spoken))}" for k in range(rnd.randint(15, 30))]
        for _ in range(rnd.randint(2, 6)):
            line = fill(rnd.choice(page))
            lines.insert(rnd.choice([0, len(lines), rnd.randrange(len(lines))]), line if rnd.random() < 0.95 else "[00:01:00] " + line)
        rows.append((100 + i, "\n".join(lines)))
    return rows


def test_main_body(spark):
    rows = transcripts(150)
    docs = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "Subscribe\nMenu"), (1, PAGE), *rows], "r bigint, t string").withColumn("id", F.lit("clash")).withColumn("line_no", F.lit(0))
    found = Counter((r.r, r.line_no) for r in mainbody.page_lines(docs, "r", "t").collect())
    got = {k: n for k, n in found.items() if k[0] < 100}
    assert got == {(1, n): 2 for n in (1, 2, 3, 4, 5, 12, 14, 15, 16, 17, 18, 19, 20)}
    assert mainbody.page_lines(docs.where("r < 0"), "r", "t").collect() == []


def test_the_tree_decides_what_density_alone_leaves_open():
    """A phrase as open as that one stays in speech and goes in a list: by density alone both would do the same."""
    prose = ["The harbour was found by a teacher, and nobody in the village had any idea of it."] * 4
    menu = ["Home  Episodes", "Community", "Search", "Help"]
    def kept(lines, density):
        point = np.array([mainbody.points(x) for x in lines])
        phrase = np.array([mainbody.looks(x, x.split())[1] for x in lines])
        twice = mainbody.kept_lines(np.tile(density, 2), np.tile(point, 2), np.tile(phrase, 2), np.tile([float(len(x)) for x in lines], 2), np.repeat([0, 1], len(lines)))
        assert twice[: len(lines)].tolist() == twice[len(lines) :].tolist()  # texts do not touch one another
        return twice[: len(lines)].tolist()
    assert kept([*prose, "Only a phrase", *menu], [0.05] * 4 + [0.6] + [0.97] * 4) == [True] * 4 + [False] * 5
    assert kept([*prose, "Search", *menu], [0.05] * 4 + [0.3] + [0.97] * 4) == [True] * 4 + [False] * 5  # by density alone it would stay
    assert kept([*prose[:2], "Right.", *prose], [0.05] * 2 + [0.6] + [0.05] * 4) == [True] * 7  # by density alone it would go


def test_main_body_without_any_times(spark):
    """No labels to learn from: only how lines look counts. Nothing fails, menus go, sentences stay."""
    text = "Home | Shows | Help\nhttps://h.example/x\n" + "\n".join(f"In the year {i}, the harbour was sold again, as nobody could have known." for i in range(8))
    got = {r.line_no for r in mainbody.page_lines(spark.createDataFrame([(1, text)], "r bigint, t string"), "r", "t").collect()}
    assert got == {1, 2}


def test_spam(spark):
    rnd = random.Random(2)
    nouns, verbs = ["harbour", "teacher", "garden", "lantern", "engine", "letter", "village", "oven", "compass", "tailor"], ["found", "sold", "painted", "carried", "mended"]
    def prose():
        return " ".join(f"When the {rnd.choice(nouns)} was {rnd.choice(verbs)}, nobody in the {rnd.choice(nouns)} had any idea that a {rnd.choice(nouns)} could be {rnd.choice(verbs)} by the {rnd.choice(nouns)}." for _ in range(8))
    good = [(i, prose(), rnd.choice(["en", "EN", None])) for i in range(150)]
    bad = [
        (1000, "pop filter " * 60, "en"), (1001, "\n".join(f"https://a.example/x/{i}" for i in range(40)), None), (1002, " ".join(f"#tag{i}" for i in range(60)), "en"),
        (1003, prose()[:150] + "\n" + "\n".join(f"ITEM-{i} | {rnd.choice(nouns)} | {i} % off" for i in range(60)), "de"), (1004, "Tags: " + ", ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(40)), "en"),
        (1005, " ".join(f"Looking for pop filter in Town{i}? Our pop filter is the best pop filter in Town{i}." for i in range(12)), "en"),
        (1006, "pop filter " * 20_000, "en"),
    ]
    other = [(2000, None, None), (2001, "", "en"), (2002, " \n ", "en"), (2003, "Hello there", "en")]
    docs = spark.createDataFrame(good + bad + other + bad[:1], "i bigint, t string, lang string").withColumn("id", F.lit("clash")).withColumn("text", F.lit("clash"))
    got = Counter(r.i for r in spam.flag(docs, "i", "t", "lang").collect())
    assert got == {1000: 2, 1001: 1, 1002: 1, 1003: 1, 1004: 1, 1005: 1, 1006: 1}
    assert spam.flag(docs.where("i < 0"), "i", "t", "lang").collect() == []


def test_every_text_of_prose_is_counted(spark):
    """Texts beyond any sample, and long ones: each trigram of classes is counted as often as it stands."""
    name = lambda i: "".join("abcdefghij"[int(d)] for d in str(10_000 + i))
    rows = [(i, " ".join(f"When the {name(1_000 * k + i)} was in the {name(k + 7 * i)}, nobody had any idea of it." for k in range(400 if i == 0 else 2)), "en") for i in range(5_400)]
    model, free, known = spam.fit(spark.createDataFrame(rows, "i bigint, t string, lang string").repartition(4), "t", "lang")
    want = sum(len(spam.tokens(t)) for _, t, _ in rows)
    assert model.total == sum(model.counts[2].values()) == want == free.total and known == {"en"}


@pytest.mark.skipif(not os.path.exists(DOCUMENTS), reason="the test tables are not here")
def test_honest_texts_of_rare_languages_are_not_spam(spark):
    """English and eight documents of each other language: what the whole table does not show as spam is not spam here, and what it shows still is."""
    docs = spark.read.parquet(DOCUMENTS).select("doc_id", "text", "lang").cache()
    everything = {r.doc_id for r in spam.flag(docs, "doc_id", "text", "lang").collect()}
    few = [docs.where(f"lower(lang) = '{k}'").orderBy("doc_id").limit(8) for k in ("de", "es", "fr", "ja", "zh")]
    some = functools.reduce(lambda a, b: a.union(b), few, docs.where("lower(lang) = 'en'"))
    rare = {r.doc_id for f in few for r in f.collect()}
    got = {r.doc_id for r in spam.flag(some, "doc_id", "text", "lang").collect()}
    assert len(rare) == 40 and got & rare == everything & rare and len(everything) > 300
    small = spark.read.parquet(DOCUMENTS.replace("sf0.1", "sf0.001")).select("doc_id", "text", "lang")
    assert small.count() * 0.15 > spam.flag(small, "doc_id", "text", "lang").count() >= 5  # a hundred documents, most languages with a few
