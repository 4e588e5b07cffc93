"""The queries pN_... of the llm operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import cap, history, hnsw, mainbody, mix, signature, sitelines, spam, tokens, turns
from quern.llm.common import with_podcast


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def latest_quality(scores: DataFrame) -> DataFrame:
    """(record_id, quality): the score of the latest scored_at; of equal times the higher one."""
    return scores.groupBy("record_id").agg(F.max(F.struct("scored_at", "quality"))["quality"].alias("quality"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows beyond max(2, floor(4 % of the batch)) of a known podcast in a batch."""
    docs = _table(spark, sf_dir, "source_documents").select("record_id", "batch_no", "podcast_title", F.col("metadata.podcast_slug").alias("slug"))
    known = with_podcast(docs, _table(spark, sf_dir, "podcast_series"), slug=F.col("slug"))
    scored = known.join(latest_quality(_table(spark, sf_dir, "quality_scores")), "record_id", "left")
    limits = docs.groupBy("batch_no").agg(F.greatest(F.lit(2), F.floor(F.count("*") * 4 / 100)).alias("cap"))
    return cap.cap(scored, ["batch_no", "podcast"], "quality", "record_id", limits).where(~F.col("kept")).select("record_id")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.turns(_table(spark, sf_dir, "transcript_segments"), _table(spark, sf_dir, "speakers"), with_text=False)


def p2_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns with the clean words spoken."""
    return turns.turns(_table(spark, sf_dir, "transcript_segments"), _table(spark, sf_dir, "speakers"))


#: Alike, as the test tables define it.
ALIKE = {"shingle": 3, "similarity": 0.6, "least_words": 40}


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "source_documents").select("record_id", "batch_no", "url", "clean_text")
    return history.repeats(docs, "record_id", "batch_no", "clean_text", "url", **ALIKE)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = signature.alike_pairs(_table(spark, sf_dir, "source_documents").select("record_id", "clean_text"), "record_id", "clean_text", **ALIKE)
    return pairs.select(F.col("a").alias("record_id_a"), F.col("b").alias("record_id_b"))


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates by the general terms (five words, 0.8): class and links of each document."""
    return signature.alike_classes(_table(spark, sf_dir, "source_documents").select("record_id", "clean_text"), "record_id", "clean_text")


def _sourced(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "source_documents").select("record_id", "podcast_title", F.col("metadata.podcast_slug").alias("slug"), "clean_text")
    return with_podcast(docs, _table(spark, sf_dir, "podcast_series"), slug=F.col("slug"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainbody.page_lines(_table(spark, sf_dir, "source_documents").select("record_id", "clean_text"), "record_id", "clean_text")


def p5_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents without their page lines."""
    docs = _table(spark, sf_dir, "source_documents").select("record_id", "clean_text")
    return sitelines.remove_lines(docs, mainbody.page_lines(docs, "record_id", "clean_text"), "record_id", "clean_text")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitelines.repeated_lines(_sourced(spark, sf_dir), "record_id", "podcast", "clean_text")


def p6_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents without the lines that p6_found names."""
    docs = _sourced(spark, sf_dir).select("record_id", "podcast", "clean_text")
    found = sitelines.repeated_lines(docs, "record_id", "podcast", "clean_text")
    return sitelines.remove_lines(docs, found, "record_id", "clean_text")


def p6_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents without the content-defined chunks that return too often in their podcast."""
    return sitelines.cut_chunks(_sourced(spark, sf_dir), "record_id", "podcast", "clean_text")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that are embedded: each has its vector in vectors, under its chunk_id."""
    chunks = _table(spark, sf_dir, "chunks").select(F.col("chunk_id").alias("id"))
    vectors = _table(spark, sf_dir, "vectors").select("id", "embedding").join(chunks, "id", "left_semi")
    found = hnsw.neighbours(vectors, "id", "embedding", dims=48, k=5)
    return hnsw.pairs(found, "id").select(F.col("a").alias("chunk_id_a"), F.col("b").alias("chunk_id_b"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(_table(spark, sf_dir, "documents"))


def p8_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode again: the text of every document comes back, null as ''."""
    return tokens.decode(tokens.encode(_table(spark, sf_dir, "documents")))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares that p9_mix really reaches, and the total."""
    targets = _table(spark, sf_dir, "mix_targets")
    return mix.shares(mix.mix(_table(spark, sf_dir, "documents"), targets), targets)


def _by_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mix_targets with a domain for each source: the catalogue page its podcast stands on."""
    pages = _table(spark, sf_dir, "podcast_series").where("slug is not null").groupBy(F.col("slug").alias("source")).agg(F.min("catalog_page_url").alias("domain"))
    return _table(spark, sf_dir, "mix_targets").join(pages, "source", "left")


def p9_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mix of 80 % of all that the sources may give: most run short, are repeated, and leave their shares to siblings and then to other domains."""
    return mix.mix(_table(spark, sf_dir, "documents"), _by_catalogue(spark, sf_dir), of_room=0.8)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam.flag(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id", "text", "lang")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p2_found, p2_turns, p3_found, p4_found, p4_classes, p5_found, p5_body, p6_found, p6_cleaned, p6_cut, p7_found, p8_ids, p8_decoded, p9_mix, p9_shares, p9_short, p10_found)}


WIDE = "".join(chr(0xFF01 + i) for i in range(94)) + "　 "
NARROW = "".join(chr(0x21 + i) for i in range(94)).replace("'", "''") + "  "


def _key(x: str) -> str:
    """The SQL of ``name_key``."""
    x = f"regexp_replace(strip_accents(lower(translate({x}, '{WIDE}', '{NARROW}'))), '&amp;|&#38;|&', ' and ', 'g')"
    x = f"trim(regexp_replace(regexp_replace({x}, '[''’`´]', '', 'g'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    x = f"regexp_replace({x}, '(.) page [0-9]+$', '\\1')"
    return f"regexp_replace(regexp_replace(regexp_replace(' ' || {x} || ' ', ' and( )', '\\1', 'g'), '^ (the )?', ''), ' $', '')"


SQL_PODCAST = f"""series AS (SELECT slug, {_key('title')} AS k FROM podcast_series WHERE slug IS NOT NULL UNION SELECT slug, {_key('slug')} FROM podcast_series WHERE slug IS NOT NULL),
names AS (SELECT k, min(slug) AS podcast FROM series WHERE k <> '' GROUP BY k HAVING min(slug) = max(slug)),
titles AS (SELECT DISTINCT podcast_title AS title, {_key('podcast_title')} AS k FROM source_documents WHERE podcast_title IS NOT NULL AND {_key('podcast_title')} <> ''),
near AS (SELECT title, podcast, CASE WHEN length(t.k) < length(n.k) OR list_sort(string_split(t.k, '')) = list_sort(string_split(n.k, '')) THEN 0 ELSE 1 END AS added
FROM (SELECT * FROM titles WHERE k NOT IN (SELECT k FROM names)) t JOIN names n ON abs(length(t.k) - length(n.k)) <= 1 AND length(t.k) >= 4 AND length(n.k) >= 4 AND damerau_levenshtein(t.k, n.k) <= 1),
edited AS (SELECT title, min(podcast) AS podcast FROM near JOIN (SELECT title, min(added) AS added FROM near GROUP BY title) USING (title, added) GROUP BY title HAVING min(podcast) = max(podcast)),
named AS (SELECT title, podcast FROM titles JOIN names USING (k) UNION ALL SELECT * FROM edited),
docs AS (SELECT d.*, coalesce(n.podcast, CASE WHEN d.metadata.podcast_slug IN (SELECT slug FROM podcast_series WHERE slug IS NOT NULL) THEN d.metadata.podcast_slug END) AS podcast FROM source_documents d LEFT JOIN named n ON d.podcast_title = n.title)"""

SQL_ALIKE = r"""w AS (SELECT record_id, regexp_extract_all(lower(clean_text), '\p{L}+') AS w FROM source_documents WHERE clean_text IS NOT NULL),
s AS (SELECT DISTINCT record_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT record_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 40)),
n AS (SELECT record_id, count(*) AS n FROM s GROUP BY record_id),
k AS (SELECT a.record_id AS a, b.record_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.record_id < b.record_id GROUP BY 1, 2),
alike AS (SELECT a, b FROM k JOIN n x ON x.record_id = a JOIN n y ON y.record_id = b WHERE k >= 0.6 * (x.n + y.n - k))"""

SQL_PAGE = r"""u AS (SELECT record_id, batch_no, regexp_replace(trim(url), '#.*$', '') AS u FROM source_documents WHERE trim(url) <> ''),
p AS (SELECT record_id, batch_no, regexp_replace(regexp_replace(regexp_replace(regexp_replace(u, '\?.*$', ''), '^(?i:(?:[a-z][a-z0-9+.-]*:)?//[^/]*)', ''), '/{2,}', '/', 'g'), '/+$', '') AS path, regexp_extract(u, '[?&;]episode=([^&;]+)', 1) AS episode FROM u)"""

SQL_OFTEN = rf"""sizes AS (SELECT podcast, count(DISTINCT record_id) AS size FROM docs WHERE podcast IS NOT NULL GROUP BY podcast),
lines AS (SELECT record_id, podcast, unnest(string_split(clean_text, chr(10))) AS l, generate_subscripts(string_split(clean_text, chr(10)), 1) AS line_no FROM docs WHERE podcast IS NOT NULL AND clean_text IS NOT NULL),
worded AS (SELECT record_id, podcast, line_no, regexp_extract_all(lower(l), '\p{{L}}+') AS w FROM lines),
often AS (SELECT podcast, w FROM worded JOIN sizes USING (podcast) WHERE len(w) >= 4 GROUP BY podcast, w, size HAVING count(DISTINCT record_id) >= 5 AND count(DISTINCT record_id) * 10 >= size),
found AS (SELECT DISTINCT record_id, line_no FROM worded JOIN often USING (podcast, w))"""

SQL_FIVE = r"""w AS (SELECT record_id, regexp_extract_all(lower(clean_text), '\p{L}+') AS w FROM source_documents WHERE clean_text IS NOT NULL),
s AS (SELECT DISTINCT record_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT record_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 40)),
n AS (SELECT record_id, count(*) AS n FROM s GROUP BY record_id),
k AS (SELECT a.record_id AS a, b.record_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.record_id < b.record_id GROUP BY 1, 2),
p AS (SELECT a, b, k = x.n AND k = y.n AS same FROM k JOIN n x ON x.record_id = a JOIN n y ON y.record_id = b WHERE k >= 0.8 * (x.n + y.n - k)),
c AS (SELECT n.record_id, coalesce(min(p.a), n.record_id) AS class_id FROM n LEFT JOIN p ON p.b = n.record_id AND p.same GROUP BY n.record_id),
l AS (SELECT DISTINCT x.class_id AS x, y.class_id AS y FROM p JOIN c x ON x.record_id = a JOIN c y ON y.record_id = b WHERE NOT same),
links AS (SELECT class_id, count(*) AS links FROM (SELECT x AS class_id, y AS other FROM l UNION SELECT y, x FROM l) GROUP BY class_id)"""

SQL = {
    "p4_classes": f"WITH {SQL_FIVE} SELECT record_id, class_id, coalesce(links, 0) AS links FROM c LEFT JOIN links USING (class_id)",
    "p6_cleaned": f"""WITH {SQL_PODCAST}, {SQL_OFTEN}, kept AS (SELECT record_id, string_agg(l, chr(10) ORDER BY line_no) AS t FROM lines ANTI JOIN found USING (record_id, line_no) GROUP BY record_id)
SELECT record_id, podcast, CASE WHEN record_id IN (SELECT record_id FROM found) THEN coalesce(t, '') ELSE clean_text END AS clean_text FROM docs LEFT JOIN kept USING (record_id)""",
    "p1_found": f"""WITH {SQL_PODCAST}, latest AS (SELECT record_id, max(scored_at) AS t FROM quality_scores GROUP BY record_id), score AS (SELECT record_id, max(quality) AS quality FROM quality_scores JOIN latest USING (record_id) WHERE scored_at = t GROUP BY record_id),
cap AS (SELECT batch_no, greatest(2, count(*) * 4 // 100) AS cap FROM source_documents GROUP BY batch_no)
SELECT record_id FROM (SELECT record_id, cap, row_number() OVER (PARTITION BY batch_no, podcast ORDER BY quality DESC NULLS LAST, record_id) AS r FROM docs JOIN cap USING (batch_no) LEFT JOIN score USING (record_id) WHERE podcast IS NOT NULL) WHERE r > cap""",
    "p3_found": f"""WITH {SQL_ALIKE}, {SQL_PAGE}, batch AS (SELECT record_id, batch_no FROM source_documents)
SELECT x.record_id FROM alike JOIN batch x ON x.record_id IN (a, b) JOIN batch y ON y.record_id IN (a, b) AND y.batch_no < x.batch_no
UNION SELECT record_id FROM (SELECT record_id, batch_no, min(batch_no) OVER (PARTITION BY path, episode) AS first FROM p) WHERE batch_no > first""",
    "p4_found": f"WITH {SQL_ALIKE} SELECT a AS record_id_a, b AS record_id_b FROM alike",
    "p6_found": f"WITH {SQL_PODCAST}, {SQL_OFTEN} SELECT record_id, line_no FROM found",
    "p7_found": """WITH v AS (SELECT id, CAST(min(embedding) AS DOUBLE[]) AS e FROM vectors WHERE len(embedding) = 48 AND len(list_filter(embedding, lambda x: isnan(x) OR isinf(x) OR x IS NULL)) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AND id IN (SELECT chunk_id FROM chunks WHERE chunk_id IS NOT NULL) GROUP BY id),
near AS (SELECT a.id AS a, b.id AS b, row_number() OVER (PARTITION BY a.id ORDER BY list_cosine_similarity(a.e, b.e) DESC, b.id) AS r FROM v a JOIN v b ON a.id <> b.id)
SELECT DISTINCT least(a, b) AS chunk_id_a, greatest(a, b) AS chunk_id_b FROM near WHERE r <= 5""",
    "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
