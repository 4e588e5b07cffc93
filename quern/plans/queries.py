"""Queries over the test tables, one or more for each operator, with SQL that gives the same rows wherever SQL can."""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import adapters
from quern.config import ChunkConfig, GenerateConfig, RetrieveConfig, load_yaml, merged
from quern.functions import html as H
from quern.functions import kernels
from quern.functions import text as T
from quern.functions.layout import spread
from quern.operators import audit, chunk, clean, generate, index, retrieve, rewrite, scrape
from quern.plans import acquire, pipeline
from quern.sources import jsonl, sinks
from quern.storage import new_path, stored
from quern.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# White space and line ends in RE2, as quern.functions.text has them in Java.
WS = r"[\t-\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINES = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def sql_collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'), ' ')"


def chars():
    return F.length(F.coalesce("clean_text", F.lit("")))


# Audit


@query("SELECT count(*) AS documents, min(length(coalesce(clean_text, ''))) AS min_chars, max(length(coalesce(clean_text, ''))) AS max_chars, avg(length(coalesce(clean_text, ''))) AS avg_chars FROM source_documents")
def audit_summary(spark, sf_dir):
    return audit.summary(table(spark, sf_dir, "source_documents"), chars())


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM source_documents WHERE {c} <> '' GROUP BY {c} HAVING count(*) > 1" for c in ("url", "doc_id", "content_hash")))
def audit_duplicates(spark, sf_dir):
    return audit.duplicates(table(spark, sf_dir, "source_documents"), ["url", "doc_id", "content_hash"])


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, min(doc_id)")
def audit_counts_by_source(spark, sf_dir):
    return audit.counts_by(table(spark, sf_dir, "documents"), "source", "doc_id")


@query("SELECT DISTINCT slug FROM podcast_series WHERE slug NOT IN (SELECT metadata.podcast_slug FROM source_documents WHERE metadata.podcast_slug IS NOT NULL)")
def audit_empty_partitions(spark, sf_dir):
    docs = table(spark, sf_dir, "source_documents").select(F.col("metadata.podcast_slug").alias("slug"))
    return audit.empty_partitions(table(spark, sf_dir, "podcast_series"), docs, "slug")


def _lengths(spark, sf_dir):
    return table(spark, sf_dir, "source_documents").select("record_id", chars().alias("chars"))


@query("SELECT record_id, length(coalesce(clean_text, '')) AS chars FROM source_documents ORDER BY chars, record_id LIMIT 200")
def audit_shortest_200(spark, sf_dir):
    return audit.shortest(_lengths(spark, sf_dir), "chars", ["record_id"])


@query("SELECT record_id, length(coalesce(clean_text, '')) AS chars FROM source_documents ORDER BY chars DESC, record_id DESC LIMIT 200")
def audit_longest_200(spark, sf_dir):
    return audit.longest(_lengths(spark, sf_dir), "chars", ["record_id"])


@query("SELECT round_even(avg(length(coalesce(clean_text, ''))), 1) AS avg_chars, min(length(coalesce(clean_text, ''))) AS min_chars, max(length(coalesce(clean_text, ''))) AS max_chars, count(*) AS documents FROM source_documents")
def audit_rounded(spark, sf_dir):
    """The summary as reports show it, means rounded half to even."""
    return clean.rounded(audit.summary(table(spark, sf_dir, "source_documents"), chars()))


@query("""SELECT (SELECT count(DISTINCT slug) FROM podcast_series WHERE slug IS NOT NULL) AS podcast_files, count(DISTINCT metadata.podcast_slug) AS nonempty_podcast_files, count(*) AS documents, sum(length(coalesce(clean_text, ''))) / count(*) AS avg_chars
FROM source_documents WHERE metadata.podcast_slug IN (SELECT slug FROM podcast_series WHERE slug IS NOT NULL)""")
def audit_roll_up(spark, sf_dir):
    """Documents and characters of each podcast rolled up to all of them, those without documents included."""
    docs = table(spark, sf_dir, "source_documents").select(F.col("metadata.podcast_slug").alias("slug"), chars().alias("chars")).where("slug is not null")
    return audit.roll_up(audit.by_file(docs, F.col("chars"), "slug"), table(spark, sf_dir, "podcast_series").where("slug is not null"), "slug")


@query("""SELECT count(*) AS documents, min(length(coalesce(clean_text, ''))) AS min_chars, max(length(coalesce(clean_text, ''))) AS max_chars, avg(length(coalesce(clean_text, ''))) AS avg_chars,
arg_min(struct_pack(u := url), record_id).u AS url, arg_min(struct_pack(t := substr(clean_text, 1, 300)), record_id).t AS text_preview FROM source_documents""")
def audit_validated(spark, sf_dir):
    found = audit.validated(table(spark, sf_dir, "source_documents"), chars(), ["record_id"])
    return found.select("documents", "min_chars", "max_chars", "avg_chars", "sample.url", "sample.text_preview")


# Cleaning


def _raw_lines(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "source_documents").select("record_id", "clean_text").where("clean_text is not null"))
    return docs.select("record_id", F.posexplode(F.transform(T.lines(F.col("clean_text")), T.strip)).alias("pos", "line")).where("line <> ''")


SQL_LINES = f"""raw AS (SELECT record_id, unnest(string_split_regex(clean_text, '{LINES}')) AS l, generate_subscripts(string_split_regex(clean_text, '{LINES}'), 1) - 1 AS pos FROM source_documents WHERE clean_text IS NOT NULL),
lines AS (SELECT record_id, pos, {sql_strip("l")} AS line FROM raw WHERE {sql_strip("l")} <> ''),
bare AS (SELECT record_id, pos, line, {sql_strip(f"regexp_replace(line, '^\\[[0-9]{{1,2}}:[0-9]{{2}}:[0-9]{{2}}\\]{WS}*', '')")} AS b FROM lines)"""


def _sql_speaks(phrases: str) -> str:
    return f"regexp_matches(b, '(?i)\\b({phrases})\\b')"


SQL_URLS = "len(regexp_extract_all(b, '(?i)https?://[^\\t\\n\\f\\r ]+')) >= 2"
SQL_REASON = f"""judged AS (SELECT record_id, pos, line, b, {" + ".join(f"(CASE WHEN {_sql_speaks(p)} THEN {n} ELSE 0 END)" for _, n, p in clean.RULES)} + (CASE WHEN {SQL_URLS} THEN 2 ELSE 0 END) AS score,
concat_ws('+', {", ".join(f"CASE WHEN {_sql_speaks(p)} THEN '{name}' END" for name, _, p in clean.RULES)}, CASE WHEN {SQL_URLS} THEN 'url_heavy' END) AS fired FROM bare),
reasons AS (SELECT record_id, pos, score, CASE WHEN b = '' THEN 'empty_block' WHEN regexp_matches(b, '(?i)^({clean.NOISE})$') THEN 'standalone_noise' WHEN (score >= 3 AND length(b) <= 2500) OR score >= 5 THEN fired END AS reason FROM judged)"""


@query(f"WITH {SQL_LINES}, {SQL_REASON} SELECT record_id, sum(score) AS score FROM reasons GROUP BY record_id")
def clean_ad_scores(spark, sf_dir):
    scored = _raw_lines(spark, sf_dir).select("record_id", clean.signs(clean.without_timestamp(F.col("line"))).alias("s")).select("record_id", clean.score_of(F.col("s")).alias("score"))
    return scored.groupBy("record_id").agg(F.sum("score").alias("score"))


@query("""SELECT record_id, CASE WHEN length(t) < 1000 THEN 'too_short_after_cleaning' WHEN record_id <> first THEN 'duplicate_clean_content_hash' END AS skip_reason FROM
(SELECT record_id, t, min(CASE WHEN length(t) >= 1000 THEN record_id END) OVER (PARTITION BY sha256(t)) AS first FROM (SELECT record_id, coalesce(clean_text, '') AS t FROM source_documents))""")
def clean_exact_dedupe(spark, sf_dir):
    docs = table(spark, sf_dir, "source_documents").select("record_id", F.coalesce("clean_text", F.lit("")).alias("cleaned_text"))
    return clean.decided(docs, ["record_id"]).select("record_id", "skip_reason")


@query(f"SELECT doc_id, list_aggregate(list_filter(list_transform(string_split_regex(coalesce(text, ''), '{LINES}'), lambda s: {sql_collapse('s')}), lambda s: s <> ''), 'string_agg', chr(10)) AS clean FROM documents")
def clean_scraped_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.nullif(T.clean_lines(F.col("text")), F.lit("")).alias("clean"))


# The whole cleaning in SQL. Compatibility forms in the test tables are the wide colon and the no-break space.
SQL_NFKC = "replace(replace(coalesce(clean_text, ''), '：', ':'), chr(160), ' ')"


def _sql_inline(x: str, pattern: str) -> str:
    return sql_strip(f"regexp_replace({x}, '(?is){pattern.replace(chr(92) + 's', WS).replace(chr(92) + 'S', WS.replace('[', '[^'))}', '', 'g')")


SQL_CLEAN = f"""n0 AS (SELECT record_id, clean_text, string_split_regex({SQL_NFKC}, '{LINES}') AS ls FROM source_documents),
n1 AS (SELECT record_id, clean_text, list_filter(list_transform(ls, lambda x: {sql_strip("regexp_replace(x, '[ \t]+', ' ', 'g')")}), lambda x: x <> '') AS ls FROM n0),
n2 AS (SELECT record_id, pos, l0, {_sql_inline("l0", clean.INLINE[0])} AS l1 FROM (SELECT record_id, unnest(ls) AS l0, generate_subscripts(ls, 1) AS pos FROM n1)),
n3 AS (SELECT *, {_sql_inline("l1", clean.INLINE[1])} AS l2 FROM n2),
bare AS (SELECT *, {sql_strip(f"regexp_replace(l2, '^\\[[0-9]{{1,2}}:[0-9]{{2}}:[0-9]{{2}}\\]{WS}*', '')")} AS b, l2 AS line, CAST(l1 <> l0 AS INT) + CAST(l2 <> l1 AS INT) AS inline_hits FROM n3),
{SQL_REASON.replace("SELECT record_id, pos, line, b,", "SELECT record_id, pos, line, b, inline_hits,").replace("SELECT record_id, pos, score,", "SELECT record_id, pos, line, b, score, inline_hits,").replace("CASE WHEN b = ''", "CASE WHEN line = '' THEN 'empty_after_inline_clean' WHEN b = ''")},
kept AS (SELECT *, lag(k) OVER (PARTITION BY record_id ORDER BY pos) AS p FROM (SELECT *, lower({sql_collapse("b")}) AS k FROM reasons WHERE reason IS NULL)),
texts AS (SELECT record_id, {sql_strip("string_agg(line, chr(10) ORDER BY pos)")} AS t FROM kept WHERE p IS NULL OR p <> k GROUP BY record_id),
counts AS (SELECT record_id, count(reason) AS removed_blocks, sum(inline_hits) AS removed_inline_phrases FROM reasons GROUP BY record_id),
dups AS (SELECT record_id, count(*) AS n FROM kept WHERE p = k GROUP BY record_id),
cleaned AS (SELECT n1.record_id, coalesce(t, '') AS cleaned_text, length(coalesce(clean_text, '')) AS original_chars, length(array_to_string(ls, chr(10))) AS normalized_chars, length(coalesce(t, '')) AS cleaned_chars,
coalesce(removed_blocks, 0) AS removed_blocks, CAST(coalesce(removed_inline_phrases, 0) AS BIGINT) AS removed_inline_phrases, coalesce(dups.n, 0) AS removed_consecutive_duplicate_blocks FROM n1 LEFT JOIN texts USING (record_id) LEFT JOIN counts USING (record_id) LEFT JOIN dups USING (record_id)),
decided AS (SELECT *, CASE WHEN cleaned_chars < 1000 THEN 'too_short_after_cleaning' WHEN record_id <> first THEN 'duplicate_clean_content_hash' END AS skip_reason FROM
(SELECT *, min(CASE WHEN cleaned_chars >= 1000 THEN record_id END) OVER (PARTITION BY sha256(cleaned_text)) AS first FROM cleaned))"""


def _cleaned(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "source_documents"))
    return clean.decided(clean.cleaned(docs), ["record_id"])


@query(f"""WITH {SQL_CLEAN} SELECT record_id, cleaned_text, skip_reason, original_chars, normalized_chars, cleaned_chars, greatest(0, normalized_chars - cleaned_chars) AS removed_chars, removed_blocks, removed_inline_phrases, removed_consecutive_duplicate_blocks FROM decided""")
def clean_documents(spark, sf_dir):
    return _cleaned(spark, sf_dir).select("record_id", "cleaned_text", "skip_reason", "cleaning.*").drop("cleaning_version", "remove_reasons")


@query(f"WITH {SQL_CLEAN} SELECT reason, count(*) AS n FROM reasons WHERE reason IS NOT NULL GROUP BY reason")
def clean_reason_histogram(spark, sf_dir):
    """The documents' maps of reasons, merged."""
    return clean.reason_histogram(clean.cleaned(spread(table(spark, sf_dir, "source_documents"))))


@query(f"WITH {SQL_CLEAN} SELECT record_id, removed_consecutive_duplicate_blocks AS n FROM cleaned WHERE removed_consecutive_duplicate_blocks > 0")
def clean_consecutive_duplicates(spark, sf_dir):
    cleaned = clean.cleaned(spread(table(spark, sf_dir, "source_documents").select("record_id", "clean_text")))
    return cleaned.select("record_id", F.col("cleaning.removed_consecutive_duplicate_blocks").alias("n")).where("n > 0")


@query(f"""WITH {SQL_LINES}, keyed AS (SELECT record_id, pos, lower({sql_collapse("b")}) AS k FROM bare)
SELECT record_id, pos FROM (SELECT *, lag(k) OVER (PARTITION BY record_id ORDER BY pos) AS p FROM keyed) WHERE k = p""")
def clean_consecutive_lines(spark, sf_dir):
    """The same drop in row form, over raw lines."""
    keyed = _raw_lines(spark, sf_dir).select("record_id", "pos", T.collapse(F.lower(clean.without_timestamp(F.col("line")))).alias("k"))
    return clean.consecutive_duplicates(keyed, ["record_id"], "pos", "k").select("record_id", "pos")


@query(f"WITH {SQL_CLEAN} SELECT n1.record_id, array_to_string(ls, chr(10)) AS normalized FROM n1")
def clean_normalized(spark, sf_dir):
    return table(spark, sf_dir, "source_documents").select("record_id", T.normalize_text(F.col("clean_text")).alias("normalized"))


@query(f"""WITH {SQL_CLEAN} SELECT count(*) AS docs_seen, count(*) FILTER (skip_reason IS NULL) AS docs_written, count(skip_reason) AS docs_skipped, count(*) FILTER (skip_reason = 'too_short_after_cleaning') AS too_short,
count(*) FILTER (skip_reason = 'duplicate_clean_content_hash') AS duplicates, avg(original_chars) AS avg_original_chars, avg(cleaned_chars) AS avg_cleaned_chars, CAST(sum(removed_blocks) AS BIGINT) AS removed_blocks, CAST(sum(removed_inline_phrases) AS BIGINT) AS removed_inline_phrases FROM decided""")
def clean_summary(spark, sf_dir):
    return clean.summary(_cleaned(spark, sf_dir))


@query(f"WITH {SQL_CLEAN} SELECT record_id, greatest(0, original_chars - cleaned_chars) AS removed_chars FROM decided WHERE skip_reason IS NULL ORDER BY removed_chars DESC, record_id LIMIT 200")
def clean_largest_reductions(spark, sf_dir):
    return clean.largest_reductions(clean.report(_cleaned(spark, sf_dir)), ["record_id"]).select("record_id", "removed_chars")


@query(f"WITH {SQL_CLEAN} SELECT record_id, cleaned_chars FROM decided WHERE skip_reason IS NULL ORDER BY cleaned_chars, record_id LIMIT 200")
def clean_shortest_written(spark, sf_dir):
    return clean.shortest_written(clean.report(_cleaned(spark, sf_dir)), ["record_id"]).select("record_id", "cleaned_chars")


@query(f"WITH {SQL_CLEAN} SELECT record_id, original_chars, cleaned_chars, greatest(0, original_chars - cleaned_chars) AS removed_chars, sha256(cleaned_text) AS cleaned_hash, skip_reason FROM decided")
def clean_report_rows(spark, sf_dir):
    return clean.report(_cleaned(spark, sf_dir)).select("record_id", "original_chars", "cleaned_chars", "removed_chars", "cleaned_hash", "skip_reason")


@query(f"WITH {SQL_CLEAN} SELECT metadata.podcast_slug AS podcast_slug, count(*) AS documents_written FROM decided JOIN source_documents USING (record_id) WHERE skip_reason IS NULL GROUP BY 1")
def clean_written_by_podcast(spark, sf_dir):
    rows = clean.report(_cleaned(spark, sf_dir)).withColumn("podcast_slug", F.col("metadata.podcast_slug"))
    return clean.written_by(rows, "podcast_slug", F.col("record_id"))


@query(f"""WITH {SQL_CLEAN} SELECT record_id, cleaned_text AS clean_text, sha256(cleaned_text) AS content_hash, nullif(content_hash, '') AS source_content_hash, 'clean_v1' AS cleaning_method, title, removed_blocks
FROM decided JOIN source_documents USING (record_id) WHERE skip_reason IS NULL""")
def clean_rewritten(spark, sf_dir):
    """Written documents in the shape of their input, with what was replaced kept in metadata."""
    return clean.rewritten(_cleaned(spark, sf_dir)).select("record_id", "clean_text", "content_hash", "metadata.source_content_hash", "cleaning_method", "title", "metadata.cleaning.removed_blocks")


# Chunking


SQL_TIMED = f"""timed AS (SELECT record_id, pos, line, regexp_matches(line, '^{WS}*\\[?[0-9]{{1,2}}:[0-9]{{2}}(:[0-9]{{2}})?\\]?') AND NOT regexp_matches(lower(regexp_extract(line, '^{WS}*\\[?([0-9]{{1,2}}:[0-9]{{2}}(?::[0-9]{{2}})?)\\]?{WS}*(.*)$', 2)), '\\b(am|pm)\\b') AS is_ts FROM lines),
numbered AS (SELECT *, sum(CASE WHEN is_ts THEN 1 ELSE 0 END) OVER (PARTITION BY record_id ORDER BY pos) AS block FROM timed)"""


# Blocks by windows: a running count of timestamp lines numbers them; blank lines stay within a block but begin none.
SQL_BLOCKS = f"""r0 AS (SELECT record_id, coalesce(clean_text, '') AS t FROM source_documents),
r1 AS (SELECT record_id, generate_subscripts(ls, 1) AS pos, {sql_strip("unnest(ls)")} AS line FROM (SELECT record_id, string_split_regex(t, '{LINES}') AS ls FROM r0)),
r2 AS (SELECT *, regexp_extract(line, '^\\[?([0-9]{{1,2}}:[0-9]{{2}}(?::[0-9]{{2}})?)\\]?{WS}*(.*)$', ['ts', 'rest']) AS m FROM r1),
r3 AS (SELECT record_id, pos, line, m.ts AS ts, {sql_strip("m.rest")} AS rest, m.ts <> '' AND NOT regexp_matches(lower(m.rest), '\\b(am|pm)\\b') AS timed FROM r2),
r4 AS (SELECT *, sum(CASE WHEN timed THEN 1 ELSE 0 END) OVER (PARTITION BY record_id ORDER BY pos) AS block, CASE WHEN timed THEN rest ELSE line END AS said FROM r3),
r5 AS (SELECT *, max(CASE WHEN said <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY record_id, block ORDER BY pos) AS begun FROM r4),
r6 AS (SELECT record_id, block, max(CASE WHEN timed THEN ts END) AS timestamp, {sql_strip("string_agg(CASE WHEN begun = 1 THEN said END, chr(10) ORDER BY pos)")} AS text FROM r5 GROUP BY record_id, block HAVING max(begun) = 1),
aware AS (SELECT record_id, max(block) >= 2 AS aware FROM r4 GROUP BY record_id),
paras AS (SELECT record_id, generate_subscripts(ps, 1) AS block, unnest(ps) AS text FROM (SELECT record_id, list_filter(list_transform(string_split_regex(t, '\\n{WS}*\\n+'), lambda p: {sql_strip("p")}), lambda p: p <> '') AS ps FROM r0 JOIN aware USING (record_id) WHERE NOT aware)),
blocks AS (SELECT record_id, aware, row_number() OVER (PARTITION BY record_id ORDER BY block) - 1 AS block, timestamp, text FROM
(SELECT record_id, block, timestamp, text FROM r6 JOIN aware USING (record_id) WHERE aware UNION ALL SELECT record_id, block, NULL, text FROM paras) JOIN aware USING (record_id))"""


@query(f"WITH {SQL_BLOCKS} SELECT record_id, aware, block, timestamp, text FROM blocks")
def chunk_timestamp_blocks(spark, sf_dir):
    found, aware = chunk.blocks(F.coalesce("clean_text", F.lit("")))
    return spread(table(spark, sf_dir, "source_documents").select("record_id", "clean_text")).select("record_id", aware.alias("aware"), found.alias("b")).select("record_id", "aware", F.posexplode("b").alias("block", "x")).select("record_id", "aware", "block", "x.timestamp", "x.text")


# Packing: sentences of long blocks by a walk over them, block windows by their running lengths, then the two merges as walks over the chunks.
SQL_PACK = f"""{SQL_BLOCKS},
sent AS (SELECT record_id, block, generate_subscripts(ss, 1) AS i, unnest(ss) AS s FROM (SELECT record_id, block, list_filter(list_transform(string_split(regexp_replace(text, '([.!?。！？]){WS}+', '\\1' || chr(2), 'g'), chr(2)), lambda x: {sql_strip("x")}), lambda x: x <> '') AS ss FROM blocks WHERE length(text) > 3600)),
held AS (SELECT record_id, block, 1 AS i, 1 AS part, CAST(length(s) + 1 AS BIGINT) AS size FROM sent WHERE i = 1
UNION ALL SELECT h.record_id, h.block, h.i + 1, CASE WHEN size + length(s) + 1 > 3600 THEN part + 1 ELSE part END, CASE WHEN size + length(s) + 1 > 3600 THEN length(s) ELSE size + length(s) + 1 END FROM held h JOIN sent x ON x.record_id = h.record_id AND x.block = h.block AND x.i = h.i + 1),
parts AS (SELECT record_id, block, part, string_agg(s, ' ' ORDER BY i) AS text FROM held JOIN sent USING (record_id, block, i) GROUP BY record_id, block, part),
split AS (SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY block, part) AS i, timestamp, text FROM
(SELECT record_id, block, 0 AS part, timestamp, text FROM blocks WHERE length(text) <= 3600 UNION ALL SELECT record_id, block, part, timestamp, p.text FROM parts p JOIN blocks USING (record_id, block))),
sums AS (SELECT *, length(text) AS len, sum(length(text) + 2) OVER (PARTITION BY record_id ORDER BY i) AS upto, count(*) OVER (PARTITION BY record_id) AS n FROM split),
stops AS (SELECT a.record_id, a.i, max(a.n) AS n, least(max(a.n), min(CASE WHEN b.upto - a.upto + a.len + 2 >= 2800 THEN b.i WHEN b.i > a.i AND b.upto - b.len - 2 - a.upto + a.len + 2 + b.len > 3600 THEN b.i - 1 END)) AS e FROM sums a JOIN sums b ON a.record_id = b.record_id AND b.i >= a.i GROUP BY a.record_id, a.i),
walk AS (SELECT record_id, i AS s, coalesce(e, n) AS e, n, 1 AS k FROM stops WHERE i = 1
UNION ALL SELECT w.record_id, x.i, coalesce(x.e, x.n), x.n, k + 1 FROM walk w JOIN stops x ON x.record_id = w.record_id AND x.i = greatest(w.s + 1, w.e) WHERE w.e < w.n),
raw AS (SELECT w.record_id, k, any_value(e - s + 1) AS bc, arg_min(timestamp, i) FILTER (i = s) AS ts, arg_min(timestamp, i) FILTER (i = e) AS te, string_agg(text, chr(10) || chr(10) ORDER BY i) AS text FROM walk w JOIN split x ON x.record_id = w.record_id AND x.i BETWEEN w.s AND w.e GROUP BY w.record_id, k),
back AS (SELECT record_id, k, 1 AS j, ts, te, bc, text FROM raw WHERE k = 1
UNION ALL SELECT b.record_id, b.k + 1, CASE WHEN tiny THEN j ELSE j + 1 END, CASE WHEN tiny THEN b.ts ELSE r.ts END, CASE WHEN tiny THEN coalesce(r.te, b.te) ELSE r.te END, CASE WHEN tiny THEN b.bc + r.bc ELSE r.bc END, CASE WHEN tiny THEN b.text || chr(10) || chr(10) || r.text ELSE r.text END
FROM (SELECT *, 0 AS x FROM back) b JOIN (SELECT *, length(text) AS len FROM raw) r ON r.record_id = b.record_id AND r.k = b.k + 1, LATERAL (SELECT r.len < 400 AND length(b.text) + r.len <= 3600 AS tiny)),
merged1 AS (SELECT record_id, j, arg_max(ts, k) FILTER (true) AS ts0, max(struct_pack(k := k, ts := ts, te := te, bc := bc, text := text)) AS c FROM back GROUP BY record_id, j),
pass1 AS (SELECT record_id, j, c.ts AS ts, c.te AS te, c.bc AS bc, c.text AS text, length(c.text) AS len, count(*) OVER (PARTITION BY record_id) AS n FROM merged1),
fwd AS (SELECT record_id, 0 AS step, 1 AS nxt, CAST(NULL AS VARCHAR) AS ts, CAST(NULL AS VARCHAR) AS te, CAST(0 AS BIGINT) AS bc, CAST(NULL AS VARCHAR) AS text, false AS out FROM pass1 WHERE j = 1
UNION ALL SELECT f.record_id, f.step + 1, CASE WHEN joined THEN f.nxt + 2 ELSE f.nxt + 1 END, CASE WHEN joined THEN coalesce(p.ts, q.ts) ELSE p.ts END, CASE WHEN joined THEN q.te ELSE p.te END, CASE WHEN joined THEN p.bc + q.bc ELSE p.bc END, CASE WHEN joined THEN p.text || chr(10) || chr(10) || q.text ELSE p.text END, p.len >= 400 OR joined OR p.n = 1
FROM fwd f JOIN pass1 p ON p.record_id = f.record_id AND p.j = f.nxt LEFT JOIN pass1 q ON q.record_id = p.record_id AND q.j = p.j + 1, LATERAL (SELECT p.len < 400 AND q.j IS NOT NULL AND p.len + 2 + q.len <= 3600 AS joined)),
packed AS (SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY step) - 1 AS chunk_index, ts AS start_timestamp, te AS end_timestamp, bc AS block_count, text, length(text) AS char_count FROM fwd WHERE out),
chunked AS (SELECT d.record_id, aware, {sql_strip("coalesce(clean_text, '')")} = '' AS missing, coalesce(b.n, 0) AS blocks, coalesce(c.n, 0) AS chunks FROM source_documents d JOIN aware USING (record_id) LEFT JOIN (SELECT record_id, count(*) AS n FROM split GROUP BY 1) b USING (record_id) LEFT JOIN (SELECT record_id, count(*) AS n FROM packed GROUP BY 1) c USING (record_id))"""


def _chunked(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "source_documents")).drop("doc_id").withColumn("doc_id", F.col("record_id").cast("string"))
    return chunk.chunked(docs, ChunkConfig(), slug=F.col("metadata.podcast_slug"))


@query(f"""WITH RECURSIVE {SQL_PACK} SELECT printf('%s::chunk_%04d', CAST(record_id AS VARCHAR), chunk_index) AS chunk_id, chunk_index, start_timestamp, end_timestamp, block_count, char_count, text, aware AS timestamp_aware,
substr(sha1({sql_collapse('text')}), 1, 16) AS chunk_content_hash, metadata.podcast_slug AS podcast_slug, nullif(title, '') AS title, nullif(url, '') AS url, 'quern' AS provider FROM packed JOIN aware USING (record_id) JOIN source_documents USING (record_id, text) """.replace("JOIN source_documents USING (record_id, text)", "JOIN (SELECT record_id, metadata, title, url FROM source_documents) USING (record_id)"))
def chunk_documents(spark, sf_dir):
    made = chunk.records(_chunked(spark, sf_dir))
    return made.select("chunk_id", "chunk_index", "start_timestamp", "end_timestamp", "block_count", "char_count", "text", "timestamp_aware", "chunk_content_hash", "podcast_slug", "title", "url", "provider")


@query(f"""WITH RECURSIVE {SQL_PACK} SELECT count(*) AS documents_seen, count(*) FILTER (chunks > 0) AS documents_written, count(*) FILTER (chunks = 0) AS documents_skipped, count(*) FILTER (chunks > 0 AND aware) AS timestamp_aware_docs, count(*) FILTER (chunks > 0 AND NOT aware) AS non_timestamp_docs,
min(chunks) FILTER (chunks > 0) AS chunks_per_doc_min, max(chunks) FILTER (chunks > 0) AS chunks_per_doc_max, avg(chunks) FILTER (chunks > 0) AS chunks_per_doc_avg, median(chunks) FILTER (chunks > 0) AS chunks_per_doc_median,
CAST(sum(chunks) AS BIGINT) AS chunks_written, (SELECT min(char_count) FROM packed) AS chunk_chars_min, (SELECT max(char_count) FROM packed) AS chunk_chars_max, (SELECT avg(char_count) FROM packed) AS chunk_chars_avg, (SELECT median(char_count) FROM packed) AS chunk_chars_median FROM chunked""")
def chunk_statistics(spark, sf_dir):
    return chunk.statistics(_chunked(spark, sf_dir))


@query(f"""WITH RECURSIVE {SQL_PACK} SELECT CASE WHEN missing THEN 'missing_text' WHEN blocks = 0 THEN 'no_blocks_after_split' ELSE 'no_chunks_after_chunking' END AS skip_reason, count(*) AS n FROM chunked WHERE chunks = 0 GROUP BY 1""")
def chunk_skip_reasons(spark, sf_dir):
    return chunk.skip_reasons(_chunked(spark, sf_dir))


@query(f"""SELECT record_id, 'doc_' || substr(sha1(coalesce(metadata.podcast_slug, 'None') || '|' || coalesce(nullif(title, ''), 'None') || '|' || coalesce(nullif(url, ''), 'None') || '|'), 1, 16) AS doc_id FROM source_documents WHERE {sql_strip("coalesce(clean_text, '')")} <> ''""")
def chunk_made_ids(spark, sf_dir):
    """Documents without an id of their own get one made from slug, title and address."""
    docs = spread(table(spark, sf_dir, "source_documents")).drop("doc_id")
    made = chunk.chunked(docs, ChunkConfig(), slug=F.col("metadata.podcast_slug")).where("size(chunks) > 0")
    return made.select("record_id", F.col("chunks")[0]["doc_id"].alias("doc_id"))


@query(f"SELECT record_id, coalesce(nullif({sql_strip('clean_text')}, ''), nullif({sql_strip('title')}, ''), '') AS text, coalesce(nullif(doc_id, ''), nullif(content_hash, '')) AS id FROM source_documents")
def chunk_fields(spark, sf_dir):
    """The first column that holds a text, and the first that holds an id."""
    docs = table(spark, sf_dir, "source_documents")
    return docs.select("record_id", chunk.first_text(docs, ("clean_text", "title")).alias("text"), chunk.first_true(docs, ("doc_id", "content_hash")).alias("id"))


@query(f"SELECT doc_id, list_aggregate(ps, 'string_agg', '¶') AS paragraphs, len(ps) AS n FROM (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '\\n{WS}*\\n+'), lambda p: {sql_strip('p')}), lambda p: p <> '') AS ps FROM documents WHERE text IS NOT NULL) WHERE len(ps) > 0")
def chunk_paragraphs(spark, sf_dir):
    found = T.paragraphs(F.col("text"))
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.array_join(found, "¶").alias("paragraphs"), F.size(found).alias("n")).where("n > 0")


@query(f"SELECT doc_id, unnest(parts) AS sentence, generate_subscripts(parts, 1) - 1 AS at FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?。！？]){WS}+', '\\1' || chr(2), 'g'), chr(2)) AS parts FROM documents WHERE text IS NOT NULL)")
def chunk_sentences(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("at", "sentence"))


@query("SELECT min(char_count) AS min, max(char_count) AS max, avg(char_count) AS avg, median(char_count) AS median FROM chunks")
def chunk_char_spread(spark, sf_dir):
    found = table(spark, sf_dir, "chunks").agg(*chunk.spread(F.col("char_count"), "c"))
    return found.select(*[F.col(f"c_{k}").alias(k) for k in ("min", "max", "avg", "median")])


@query(f"SELECT substr(sha1({sql_collapse('text')}), 1, 16) AS chunk_content_hash, count(*) AS n FROM chunks GROUP BY 1 HAVING count(*) > 1")
def chunk_repeated_hashes(spark, sf_dir):
    return chunk.repeated_hashes(table(spark, sf_dir, "chunks").select(T.chunk_hash(F.col("text")).alias("chunk_content_hash")))


@query("SELECT chunk_index, printf('%s::chunk_%04d', doc_id, chunk_index) AS made FROM chunks")
def chunk_ids(spark, sf_dir):
    return table(spark, sf_dir, "chunks").select("chunk_index", chunk.chunk_id(F.col("doc_id"), F.col("chunk_index")).alias("made"))


# Index


@query("SELECT chunk_id FROM chunks WHERE chunk_id NOT IN (SELECT id FROM vectors WHERE embedding IS NOT NULL AND id IS NOT NULL)")
def index_missing(spark, sf_dir):
    return index.missing(table(spark, sf_dir, "chunks"), table(spark, sf_dir, "vectors").where("embedding is not null")).select("chunk_id")


@query(f"SELECT chunk_id FROM (SELECT chunk_id, text FROM chunks ORDER BY chunk_id, chunk_index OFFSET 50) WHERE {sql_strip('text')} <> '' AND {sql_strip('chunk_id')} <> '' ORDER BY chunk_id LIMIT 100")
def index_offset_limit(spark, sf_dir):
    return index.window(table(spark, sf_dir, "chunks"), ["chunk_id", "chunk_index"], 50, 100).select("chunk_id")


@query("SELECT coalesce(chunk_id, '') AS chunk_id, coalesce(title, '') AS title, coalesce(url, '') AS url, coalesce(start_timestamp, '') AS start_timestamp, chunk_index, timestamp_aware FROM chunks")
def index_metadata(spark, sf_dir):
    return index.metadata(table(spark, sf_dir, "chunks")).select("chunk_id", "title", "url", "start_timestamp", "chunk_index", "timestamp_aware")


# Retrieval over the table embeddings: every vector whose id is divisible by 100 is a variant, five of them a request.

PICK = RetrieveConfig(min_relevance_distance=0.75, weak_relevance_distance=0.65)


def _variants(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").where("vec_id % 100 = 0")
    return e.select(F.floor(F.col("vec_id") / 500).alias("query_id"), F.floor(F.col("vec_id") % 500 / 100).alias("query_index"), F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("matched_query"), F.col("embedding").alias("q_embedding"))


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"), "embedding", "vec_id", "label")


SQL_KNN = """v AS (SELECT vec_id, label, CAST(vec_id AS VARCHAR) AS chunk_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
q AS (SELECT vec_id // 500 AS query_id, (vec_id % 500) // 100 AS query_index, 'v' || vec_id AS matched_query, e AS qe FROM v WHERE vec_id % 100 = 0),
scored AS (SELECT query_id, query_index, matched_query, chunk_id, abs(round(1 - list_cosine_similarity(qe, e), 12)) AS distance FROM q, v),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, query_index ORDER BY distance, chunk_id) AS rank FROM scored) WHERE rank <= 30)"""
SQL_MERGE = """merged AS (SELECT query_id, chunk_id, min(distance) AS distance, arg_min(matched_query, struct_pack(d := distance, q := query_index, r := rank)) AS matched_query,
string_agg(matched_query, ',' ORDER BY query_index, rank) AS matched_queries, min(struct_pack(q := query_index, r := rank)) AS f FROM near GROUP BY query_id, chunk_id)"""
SQL_PICK = """ranked AS (SELECT query_id, chunk_id, distance, CAST(vec_id % 97 AS VARCHAR) AS doc, CAST(label AS VARCHAR) AS podcast, CAST(vec_id % 53 AS VARCHAR) AS title,
row_number() OVER (PARTITION BY query_id ORDER BY distance, f) AS i FROM merged JOIN v USING (chunk_id) WHERE distance <= 0.75),
walk AS (SELECT query_id, 0 AS i, CAST([] AS VARCHAR[]) AS ids, CAST([] AS VARCHAR[]) AS docs, CAST([] AS VARCHAR[]) AS pods, CAST([] AS VARCHAR[]) AS titles FROM (SELECT DISTINCT query_id FROM ranked)
UNION ALL SELECT w.query_id, w.i + 1, CASE WHEN ok THEN list_append(ids, chunk_id) ELSE ids END, CASE WHEN ok THEN list_append(docs, doc) ELSE docs END,
CASE WHEN ok THEN list_append(pods, podcast) ELSE pods END, CASE WHEN ok THEN list_append(titles, title) ELSE titles END
FROM (SELECT w0.*, r.chunk_id, r.doc, r.podcast, r.title, len(ids) < 8 AND NOT list_contains(docs, r.doc) AND len(list_filter(pods, lambda x: x = r.podcast)) < 3 AND NOT list_contains(titles, r.title) AS ok
FROM walk w0 JOIN ranked r ON r.query_id = w0.query_id AND r.i = w0.i + 1) w),
picked AS (SELECT query_id, unnest(ids) AS chunk_id, generate_subscripts(ids, 1) AS rank FROM (SELECT query_id, arg_max(ids, i) AS ids FROM walk GROUP BY query_id))"""


def _merged(spark, sf_dir):
    return retrieve.merged(pipeline.candidates(_variants(spark, sf_dir), _vectors(spark, sf_dir), PICK))


def _picked(spark, sf_dir):
    meta = _vectors(spark, sf_dir).select(
        "chunk_id", F.concat(F.lit("d"), (F.col("vec_id") % 97).cast("string")).alias("doc_id"), F.col("label").cast("string").alias("podcast_slug"), F.concat(F.lit("title "), (F.col("vec_id") % 53).cast("string")).alias("title"),
        F.lit("").alias("chunk_content_hash"),
    )
    return retrieve.picked(retrieve.relevant(_merged(spark, sf_dir), PICK).join(meta, "chunk_id"), config=PICK)


@query(f"WITH {SQL_KNN} SELECT query_id, query_index, chunk_id, rank, round(distance, 6) AS distance FROM near")
def knn_topk(spark, sf_dir):
    found = pipeline.candidates(_variants(spark, sf_dir), _vectors(spark, sf_dir), PICK)
    return found.select("query_id", "query_index", "chunk_id", "rank", F.round("distance", 6).alias("distance"))


@query(f"WITH {SQL_KNN}, {SQL_MERGE} SELECT query_id, chunk_id, round(distance, 6) AS distance, matched_query, matched_queries FROM merged")
def retrieve_merge(spark, sf_dir):
    return _merged(spark, sf_dir).select("query_id", "chunk_id", F.round("distance", 6).alias("distance"), "matched_query", F.array_join("matched_queries", ",").alias("matched_queries"))


@query(f"WITH RECURSIVE {SQL_KNN}, {SQL_MERGE}, {SQL_PICK} SELECT query_id, chunk_id, rank FROM picked")
def retrieve_capped_pick(spark, sf_dir):
    return _picked(spark, sf_dir).select("query_id", "chunk_id", F.col("rank").cast("bigint").alias("rank"))


@query(f"""WITH RECURSIVE {SQL_KNN}, {SQL_MERGE}, {SQL_PICK}, counts AS (SELECT query_id, count(*) AS u, count(*) FILTER (WHERE distance <= 0.65) AS s FROM picked JOIN merged USING (query_id, chunk_id) GROUP BY query_id)
SELECT query_id, CASE WHEN coalesce(u, 0) = 0 THEN 'none' WHEN u < 3 THEN 'weak' WHEN s >= 3 THEN 'strong' ELSE 'medium' END AS coverage_status, coalesce(u, 0) AS usable_source_count, coalesce(s, 0) AS strong_source_count
FROM (SELECT DISTINCT query_id FROM q) LEFT JOIN counts USING (query_id)""")
def retrieve_coverage(spark, sf_dir):
    return retrieve.coverage(_picked(spark, sf_dir), _variants(spark, sf_dir), config=PICK)


# Requests over chunks and vectors; the walk of the capped pick as above, with empty keys uncapped and equal contents once.
SQL_USABLE = """u AS (SELECT id AS chunk_id, CAST(min(embedding) AS DOUBLE[]) AS e FROM vectors WHERE len(embedding) = 48 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 GROUP BY id),
ch AS (SELECT chunk_id, arg_min(struct_pack(doc := doc_id, pod := podcast_slug, title := title, h := chunk_content_hash, t := text, ix := chunk_index, cc := char_count, url := url, st := start_timestamp, et := end_timestamp), struct_pack(a := title, b := url, c := start_timestamp)) AS m FROM chunks GROUP BY chunk_id)"""
SQL_TITLE_KEY = "trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(TITLE, '')), '\\([\\t\\n\\f\\r ]*20[0-9]{2}[\\t\\n\\f\\r ]*\\)', '', 'g'), '\\b20[0-9]{2}\\b', '', 'g'), '[^a-z0-9]+', ' ', 'g'), ' ')"


def _sql_picks(near: str, limit: float, weak: float) -> str:
    """CTEs merged, ranked, walk, picked, packs over ``near`` (query_id, query_index, matched_query, chunk_id, distance, rank)."""
    return f"""{near},
merged AS (SELECT query_id, chunk_id, min(distance) AS distance, min(struct_pack(q := query_index, r := rank)) AS f, string_agg(matched_query, '|' ORDER BY query_index, rank) AS met FROM near GROUP BY query_id, chunk_id),
ranked AS (SELECT query_id, chunk_id, distance, met, coalesce(m.doc, '') AS doc, coalesce(m.pod, '') AS podcast, {SQL_TITLE_KEY.replace('TITLE', 'm.title')} AS title, coalesce(m.h, '') AS hash, row_number() OVER (PARTITION BY query_id ORDER BY distance, f) AS i FROM merged JOIN ch USING (chunk_id) WHERE distance <= {limit}),
walk AS (SELECT query_id, 0 AS i, CAST([] AS VARCHAR[]) AS ids, CAST([] AS VARCHAR[]) AS docs, CAST([] AS VARCHAR[]) AS pods, CAST([] AS VARCHAR[]) AS titles, CAST([] AS VARCHAR[]) AS hashes FROM (SELECT DISTINCT query_id FROM ranked)
UNION ALL SELECT w.query_id, w.i + 1, CASE WHEN ok THEN list_append(ids, chunk_id) ELSE ids END, CASE WHEN ok THEN list_append(docs, doc) ELSE docs END, CASE WHEN ok THEN list_append(pods, podcast) ELSE pods END, CASE WHEN ok THEN list_append(titles, title) ELSE titles END, CASE WHEN ok THEN list_append(hashes, hash) ELSE hashes END
FROM (SELECT w0.*, r.chunk_id, r.doc, r.podcast, r.title, r.hash, len(ids) < 8 AND NOT list_contains(ids, r.chunk_id) AND (r.hash = '' OR NOT list_contains(hashes, r.hash)) AND (r.doc = '' OR NOT list_contains(docs, r.doc)) AND (r.podcast = '' OR len(list_filter(pods, lambda x: x = r.podcast)) < 3) AND (r.title = '' OR NOT list_contains(titles, r.title)) AS ok
FROM walk w0 JOIN ranked r ON r.query_id = w0.query_id AND r.i = w0.i + 1) w),
picked AS (SELECT query_id, unnest(ids) AS chunk_id, generate_subscripts(ids, 1) AS rank FROM (SELECT query_id, arg_max(ids, i) AS ids FROM walk GROUP BY query_id)),
packs AS (SELECT query_id, count(p.chunk_id) AS usable_source_count, count(p.chunk_id) FILTER (m2.distance <= {weak}) AS strong_source_count, coalesce(string_agg(p.rank || ':' || p.chunk_id || ':' || coalesce(m.title, '') || ':' || coalesce(m.st, '') || ':' || m2.met || ':' || length(m.t), ',' ORDER BY p.rank), '') AS sources
FROM (SELECT DISTINCT query_id FROM asked) LEFT JOIN picked p USING (query_id) LEFT JOIN merged m2 USING (query_id, chunk_id) LEFT JOIN ch USING (chunk_id) GROUP BY query_id),
covered AS (SELECT *, CASE WHEN usable_source_count = 0 THEN 'none' WHEN usable_source_count < 3 THEN 'weak' WHEN strong_source_count >= 3 THEN 'strong' ELSE 'medium' END AS coverage_status FROM packs)"""


def _one_chunk(spark, sf_dir):
    """Chunks, each id once: of differing rows the smallest by title, address and start."""
    return sinks.first_rows(table(spark, sf_dir, "chunks"), "chunk_id", [F.col(c) for c in ("title", "url", "start_timestamp")])


def _shown(packs):
    one = lambda s: F.concat_ws(":", s["rank"].cast("string"), s["chunk_id"], s["title"], s["start_timestamp"], F.array_join(s["matched_queries"], "|"), F.length(s["text"]).cast("string"))
    return packs.select("query_id", "user_query", "coverage.*", F.array_join(F.transform("sources", one), ",").alias("sources"))


SQL_LIKE = SQL_USABLE + """, asked AS (SELECT chunk_id AS query_id, e AS qe FROM u WHERE substr(md5(chunk_id), 1, 1) = '0'),
scored AS (SELECT query_id, 0 AS query_index, 'like ' || query_id AS matched_query, chunk_id, abs(round(1 - list_cosine_similarity(qe, e), 12)) AS distance FROM asked, u),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rank FROM scored) WHERE rank <= 30)"""


@query(f"WITH RECURSIVE {_sql_picks(SQL_LIKE, 0.75, 0.65)} SELECT query_id, 'like ' || query_id AS user_query, coverage_status, usable_source_count, strong_source_count, sources FROM covered")
def retrieve_source_packs(spark, sf_dir):
    """A stated query set, chunks whose hash begins with 0, against all vectors; neighbours, pick and packs over chunks and vectors."""
    ok = (F.size("embedding") == 48) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0)
    vectors = table(spark, sf_dir, "vectors").where(F.col("embedding").isNotNull() & ok).groupBy(F.col("id").alias("chunk_id")).agg(F.min("embedding").alias("embedding"))
    asked = vectors.where(F.substring(F.md5("chunk_id"), 1, 1) == "0")
    variants = asked.select(F.col("chunk_id").alias("query_id"), F.lit(0).alias("query_index"), F.concat(F.lit("like "), F.col("chunk_id")).alias("matched_query"), F.col("embedding").alias("q_embedding"))
    return _shown(pipeline.retrieve_batch(variants, vectors, _one_chunk(spark, sf_dir), PICK)[1])


# A request answered end to end, with stand-ins for the models that SQL can follow: letters counted as embedding, words as rewrite.

SQL_WORDS = f"""titles AS (SELECT DISTINCT title AS q, string_split({sql_collapse('title')}, ' ') AS w, {sql_collapse('title')} AS flat FROM source_documents WHERE title IS NOT NULL AND {sql_strip('title')} <> ''),
raws AS (SELECT q, [q, array_to_string(w[1:3], ' '), array_to_string(list_reverse(w), ' ')] AS vs, list_filter(w, lambda x: length(x) >= 5) AS terms FROM titles),
flats AS (SELECT q, terms, list_filter(list_transform(vs, lambda x: {sql_collapse('x')}), lambda x: x <> '') AS vs FROM raws),
rewrites AS (SELECT q, terms, vs[2] AS core_query, list_filter(vs, lambda x, i: list_position(list_transform(vs, lambda y: lower(y)), lower(x)) = i) AS variants FROM flats)"""


def _titles(spark, sf_dir):
    return table(spark, sf_dir, "source_documents").where(T.strip(F.col("title")) != "").select(F.col("title").alias("query")).distinct()


@query(f"WITH {SQL_WORDS} SELECT q AS query, array_to_string(list_transform(string_split({sql_collapse('q')}, ' ')[1:3], lambda x: x), ' ') AS core_query, array_to_string(terms, '|') AS terms, array_to_string(variants, '|') AS variants, true AS rewrite_used FROM rewrites")
def rewrite_requests(spark, sf_dir):
    """Every title as a request: prompt, stand-in model, strict JSON, validation, distinct variants; asked twice, the second time from the cache."""
    cache, requests = new_path(spark, "rewrite-cache"), _titles(spark, sf_dir).withColumn("query_id", F.xxhash64("query"))
    once = pipeline.rewritten_requests(requests, adapters.WordRewriter, cache_path=cache)
    once.write.format("noop").mode("overwrite").save()
    again = pipeline.rewritten_requests(requests, adapters.EchoGenerator, cache_path=cache)  # this stand-in gives no JSON: what comes is cached
    r = F.col("query_rewrite")
    return again.select(F.col("user_query").alias("query"), r["core_query"].alias("core_query"), F.array_join(r["canonical_terms"], "|").alias("terms"), F.array_join(r["retrieval_queries"], "|").alias("variants"), r["rewrite_used"].alias("rewrite_used"))


@query(f"SELECT DISTINCT title AS query, 'rewrite_failed:not_a_json_object' AS fallback_reason, title AS variants FROM source_documents WHERE {sql_strip('title')} <> ''")
def rewrite_fallback(spark, sf_dir):
    """A model that gives no JSON: the request itself, and why."""
    made = pipeline.rewritten_requests(_titles(spark, sf_dir).withColumn("query_id", F.xxhash64("query")), adapters.EchoGenerator)
    return made.select(F.col("user_query").alias("query"), "query_rewrite.fallback_reason", F.array_join("query_rewrite.retrieval_queries", "|").alias("variants"))


@query("""SELECT record_id, CASE WHEN record_id % 5 IN (0, 1) THEN 'B' || record_id END AS core FROM source_documents""")
def rewrite_strict_json(spark, sf_dir):
    """Answers with prose around one object parse; single quotes, two objects and lists do not."""
    i = F.col("record_id").cast("string")
    one = F.concat(F.lit('{"core_query": "B'), i, F.lit('"}'))
    kind = F.pmod("record_id", F.lit(5))
    text = F.when(kind == 0, one).when(kind == 1, F.concat(F.lit("Here: "), one, F.lit(" - done"))).when(kind == 2, F.translate(one, '"', "'")).when(kind == 3, F.concat(one, F.lit(" and "), one)).otherwise(F.concat(F.lit("["), one, F.lit("]")))
    return table(spark, sf_dir, "source_documents").select("record_id", F.get_json_object(kernels.json_object(text), "$.core_query").alias("core"))


SQL_LETTERS = "list_transform(range(97, 123), lambda c: CAST(length(X) - length(replace(X, chr(CAST(c AS INT)), '')) AS DOUBLE))"


@query(f"SELECT doc_id, array_to_string(list_transform({SQL_LETTERS.replace('X', 'low')}, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',') AS counts FROM (SELECT doc_id, lower({sql_collapse("coalesce(text, '')")}) AS low FROM documents)")
def index_embedded(spark, sf_dir):
    """Embedding in batches, with the stand-in that counts letters."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = adapters.embedded(docs, "text", adapters.LetterEmbedder, longest=10**9)
    return made.select("doc_id", F.array_join(F.transform("embedding", lambda x: x.cast("bigint").cast("string")), ",").alias("counts"))


SQL_END = f"""ch AS (SELECT chunk_id, arg_min(struct_pack(doc := doc_id, pod := podcast_slug, title := title, h := chunk_content_hash, t := text, ix := chunk_index, cc := char_count, url := url, st := start_timestamp, et := end_timestamp), struct_pack(a := title, b := url, c := start_timestamp)) AS m FROM chunks GROUP BY chunk_id),
u AS (SELECT chunk_id, {SQL_LETTERS.replace('X', 'low')} AS e FROM (SELECT chunk_id, lower(array_to_string(string_split({sql_collapse("coalesce(m.t, '')")}, ' ')[1:1024], ' ')) AS low FROM ch)),
{SQL_WORDS}, asked AS (SELECT q AS query_id FROM rewrites WHERE substr(md5(q), 1, 1) = '0'),
vs AS (SELECT q AS query_id, generate_subscripts(variants, 1) - 1 AS query_index, unnest(variants) AS matched_query FROM rewrites JOIN asked ON q = query_id),
ve AS (SELECT *, {SQL_LETTERS.replace('X', 'low')} AS qe FROM (SELECT *, lower(matched_query) AS low FROM vs)),
scored AS (SELECT query_id, query_index, matched_query, chunk_id, abs(round(1 - list_cosine_similarity(qe, e), 12)) AS distance FROM ve, u WHERE len(list_filter(qe, lambda x: x > 0)) > 0 AND len(list_filter(e, lambda x: x > 0)) > 0),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, query_index ORDER BY distance, chunk_id) AS rank FROM scored) WHERE rank <= 30)"""


@query(f"WITH RECURSIVE {_sql_picks(SQL_END, 0.3, 0.2)} SELECT query_id AS user_query, coverage_status, usable_source_count, strong_source_count, sources FROM covered")
def answer_requests(spark, sf_dir):
    """Requests from rewrite to source pack: a stated query set of titles, against all chunks."""
    requests = _titles(spark, sf_dir).where(F.substring(F.md5("query"), 1, 1) == "0").withColumn("query_id", F.col("query"))
    chunks = stored(_one_chunk(spark, sf_dir), "chunks")
    vectors = adapters.embedded(chunks.select("chunk_id", "text"), "text", adapters.LetterEmbedder).select("chunk_id", "embedding")
    config = RetrieveConfig(min_relevance_distance=0.3, weak_relevance_distance=0.2)
    packs, _ = pipeline.answer(requests, vectors, chunks, adapters.LetterEmbedder, adapters.WordRewriter, adapters.EchoGenerator, retrieve_config=config)
    return _shown(packs).drop("query_id")


# Strings, addresses, rewriting, generation


@query("SELECT record_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(title, '')), '\\([\\t\\n\\f\\r ]*20[0-9]{2}[\\t\\n\\f\\r ]*\\)', '', 'g'), '\\b20[0-9]{2}\\b', '', 'g'), '[^a-z0-9]+', ' ', 'g'), ' ') AS title_key FROM source_documents")
def title_keys(spark, sf_dir):
    return table(spark, sf_dir, "source_documents").select("record_id", T.title_key(F.col("title")).alias("title_key"))


SQL_PATH = "regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
SQL_PARTS = f"list_filter(string_split({SQL_PATH}, '/'), lambda p: p <> '')"


@query(f"""SELECT record_id, 'site__' || CASE WHEN len({SQL_PARTS}) >= 2 THEN {SQL_PARTS}[-2] || '__' || {SQL_PARTS}[-1] ELSE substr(sha256(url), 1, 16) END AS id,
CASE WHEN len({SQL_PARTS}) > 0 THEN {SQL_PARTS}[-1] ELSE 'unknown-' || substr(sha256(url), 1, 16) END AS slug FROM source_documents WHERE url IS NOT NULL""")
def url_ids(spark, sf_dir):
    docs = table(spark, sf_dir, "source_documents").where("url is not null")
    return docs.select("record_id", T.id_from_url(F.col("url"), "site").alias("id"), T.slug_from_url(F.col("url")).alias("slug"))


@query(f"""SELECT record_id, CASE WHEN s = '' THEN 'https' ELSE s END || '://' || CASE WHEN h = '' THEN 'site.example' ELSE h END || CASE WHEN p = '' THEN '/' ELSE p END || '?page=2' AS second FROM
(SELECT record_id, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1) AS s, regexp_extract(url, '//([^/?#]*)', 1) AS h, regexp_replace({SQL_PATH}, '/+$', '') AS p FROM source_documents WHERE url IS NOT NULL)""")
def url_pages(spark, sf_dir):
    return table(spark, sf_dir, "source_documents").where("url is not null").select("record_id", T.page_url(F.col("url"), F.lit(2), "site.example").alias("second"))


@query("SELECT record_id FROM source_documents WHERE batch_no > 0 AND url IS NOT NULL AND url NOT IN (SELECT url FROM source_documents WHERE batch_no = 0 AND url IS NOT NULL)")
def resume_anti_join(spark, sf_dir):
    docs = table(spark, sf_dir, "source_documents")
    return scrape.unseen(docs.where("batch_no > 0 and url is not null"), docs.where("batch_no = 0")).select("record_id")


SQL_ASKED = " , ".join(f"CAST(nullif(regexp_extract(t, '(?i)([0-9]+){WS}*{unit}', 1), '') AS HUGEINT)" for unit in ("轮", "回合", "rounds?")) + f", (CAST(nullif(regexp_extract(t, '(?i)([0-9]+){WS}*turns?', 1), '') AS HUGEINT) + 1) // 2"


@query(f"SELECT doc_id, CAST(CASE WHEN coalesce({SQL_ASKED}) IS NULL THEN 30 ELSE least(greatest(coalesce({SQL_ASKED}), 1), 80) END AS INTEGER) AS rounds FROM (SELECT doc_id, translate(coalesce(text, '') || ' ' || doc_id % 170 || [' rounds', ' 轮', '回合', ' turns', ' pages'][CAST(doc_id % 5 AS INT) + 1], '０１２３４５６７８９', '0123456789') AS t FROM documents)")
def rounds_from_text(spark, sf_dir):
    """Every text with a request behind it, in one of the four forms or in none."""
    unit = F.element_at(F.array(*[F.lit(u) for u in (" rounds", " 轮", "回合", " turns", " pages")]), (F.col("doc_id") % 5 + 1).cast("int"))
    text = F.concat(F.coalesce("text", F.lit("")), F.lit(" "), (F.col("doc_id") % 170).cast("string"), unit)
    return table(spark, sf_dir, "documents").select("doc_id", T.rounds(text, 30).alias("rounds"))


@query(f"SELECT record_id, {sql_strip("regexp_replace('  READ ' || title, '^' || '" + WS + "' || '*(?i:read)' || '" + WS + "' || '+', '')")} AS read, regexp_replace(title || ' - Page ' || record_id, '(?i)' || '{WS}' || '+-' || '{WS}' || '+Page' || '{WS}' || '+[0-9]+' || '{WS}' || '*$', '') AS bare FROM source_documents WHERE title IS NOT NULL")
def title_parts(spark, sf_dir):
    """Titles without the word that links put before them and without the page number that lists put behind them."""
    docs = table(spark, sf_dir, "source_documents").where("title is not null")
    return docs.select("record_id", T.without_prefix(F.concat(F.lit("  READ "), F.col("title")), "Read").alias("read"), T.without_page_suffix(F.concat(F.col("title"), F.lit(" - Page "), F.col("record_id").cast("string"))).alias("bare"))


@query(f"SELECT doc_id, {sql_strip("text")} AS dialogue FROM documents WHERE {sql_strip("text")} <> '' AND NOT regexp_matches(text, '(?i)\n##')".replace(sql_strip("text") + " AS dialogue", f"regexp_replace(text, '{WS}+$', '') AS dialogue"))
def generate_without_notes(spark, sf_dir):
    """Texts with source notes of a model's own behind them come back without these."""
    heading = F.element_at(F.array(*[F.lit(h) for h in ("Source Notes", "Sources", "source appendix")]), (F.col("doc_id") % 3 + 1).cast("int"))
    docs = table(spark, sf_dir, "documents").where((T.strip(F.col("text")) != "") & ~F.col("text").rlike(r"(?i)\n##"))
    return docs.select("doc_id", T.without_source_notes(F.concat(F.col("text"), F.lit("\n\n## "), heading, F.lit("\n- one\n- two\n"))).alias("dialogue"))


@query("SELECT record_id, 'https://host.example/' || CASE record_id % 3 WHEN 0 THEN 'e/' || record_id WHEN 1 THEN 'shows/list/' || record_id ELSE 'shows/up/' || record_id END AS url, CASE WHEN record_id % 3 = 1 THEN record_id END AS page FROM source_documents")
def url_resolved(spark, sf_dir):
    """Addresses as they stand on a page: from the root, beside it, and above it; and the page number of an address."""
    i = F.col("record_id").cast("string")
    kind = F.col("record_id") % 3
    href = F.when(kind == 0, F.concat(F.lit("/e/"), i)).when(kind == 1, i).otherwise(F.concat(F.lit("../up/"), i))
    url = T.resolve(F.lit("https://host.example/shows/list/now?x=1"), href)
    page = T.page_number(F.concat(url, F.when(kind == 1, F.concat(F.lit("?a=b&page="), i)).otherwise(F.lit("?pages=7"))))
    return table(spark, sf_dir, "source_documents").select("record_id", url.alias("url"), page.alias("page"))


@query("SELECT doc_id, strftime(crawled_at, '%Y%m%d_%H%M%S') AS stamp, strftime(crawled_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS iso FROM documents WHERE crawled_at IS NOT NULL")
def run_stamps(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("crawled_at is not null")
    return docs.select("doc_id", T.run_stamp(F.col("crawled_at")).alias("stamp"), T.iso_stamp(F.col("crawled_at")).alias("iso"))


@query("SELECT source, doc_id, title FROM documents WHERE doc_id = (SELECT max(doc_id) FROM documents WHERE source IS NOT NULL)")
def latest_run(spark, sf_dir):
    """The rows of the newest run, runs being numbered by doc_id."""
    return sinks.latest(table(spark, sf_dir, "documents").where("source is not null"), "doc_id").select("source", "doc_id", "title")


@query(f"SELECT doc_id, CASE WHEN length(t) > 500 THEN regexp_replace(substr(t, 1, 500), '{WS}+$', '') || '...' ELSE t END AS preview FROM (SELECT doc_id, {sql_collapse('text')} AS t FROM documents)")
def previews(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.preview(F.col("text"), 500).alias("preview"))


@query(f"""SELECT record_id, string_agg(s, '|' ORDER BY i) AS variants FROM (SELECT record_id, lower(s) AS k, min(i) AS i, arg_min(s, i) AS s FROM
(SELECT record_id, i, {sql_collapse('x')} AS s FROM (SELECT record_id, unnest([title, podcast_title, upper(title), metadata.podcast_slug, source_site, description, language]) AS x, unnest([0, 1, 2, 3, 4, 5, 6]) AS i FROM source_documents)) WHERE s <> '' GROUP BY record_id, lower(s)) GROUP BY record_id""")
def rewrite_distinct(spark, sf_dir):
    items = F.filter(F.array("title", "podcast_title", F.upper("title"), "metadata.podcast_slug", "source_site", "description", "language"), lambda x: x.isNotNull())
    return table(spark, sf_dir, "source_documents").select("record_id", F.array_join(T.distinct_ignoring_case(items), "|").alias("variants")).where("variants <> ''")


@query("""SELECT record_id, sha1('{"base_url": "http://localhost", "max_queries": 5, "model": "m", "prompt_version": "v2_core_query", "provider": "p", "query": ' || CAST(to_json(title) AS VARCHAR) || '}') AS key FROM source_documents WHERE title IS NOT NULL""")
def rewrite_cache_keys(spark, sf_dir):
    return table(spark, sf_dir, "source_documents").where("title is not null").select("record_id", rewrite.cache_key(F.col("title"), "p", "http://localhost", "m").alias("key"))


SQL_SOURCES = """ch AS (SELECT chunk_id, arg_min(struct_pack(doc_id := doc_id, podcast_slug := podcast_slug, title := title, text := text, ix := chunk_index, url := url, st := start_timestamp, et := end_timestamp), struct_pack(a := title, b := url, c := start_timestamp)) AS m FROM chunks GROUP BY chunk_id),
src AS (SELECT m.doc_id AS doc_id, chunk_id, m.ix + 1 AS rank, CAST(m.ix AS DOUBLE) / 10 AS distance, m.* EXCLUDE (doc_id) FROM (SELECT chunk_id, m, m.* FROM ch))""".replace("m.* EXCLUDE (doc_id) FROM (SELECT chunk_id, m, m.* FROM ch)", "m.podcast_slug AS podcast_slug, m.title AS title, m.text AS text, m.ix AS ix, m.url AS url, m.st AS st, m.et AS et FROM ch")


def _sources(spark, sf_dir):
    """The chunks of each document as its sources."""
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    source = F.struct(
        (F.col("chunk_index") + 1).alias("rank"), (F.col("chunk_index") / 10).alias("distance"), "chunk_id", "doc_id", text("title"), text("podcast_slug"), text("url"), text("start_timestamp"), text("end_timestamp"), "chunk_index", "char_count",
        F.array(F.lit("q1"), F.concat(F.lit("q"), (F.col("chunk_index") + 2).cast("string"))).alias("matched_queries"), text("text"),
    )
    return _one_chunk(spark, sf_dir).groupBy("doc_id").agg(F.sort_array(F.collect_list(source)).alias("sources"))


@query(f"""WITH RECURSIVE {SQL_SOURCES}, ordered AS (SELECT * FROM (SELECT doc_id, rank, chunk_id, {sql_collapse("coalesce(text, '')")} AS t, row_number() OVER (PARTITION BY doc_id ORDER BY distance, rank, chunk_id) AS i FROM src) WHERE i <= 6),
walk AS (SELECT doc_id, 0 AS i, 0 AS used, CAST(NULL AS BIGINT) AS rank, CAST(NULL AS BIGINT) AS chars FROM ordered WHERE i = 1
UNION ALL SELECT w.doc_id, w.i + 1, CASE WHEN skip THEN used ELSE used + n END, CASE WHEN skip THEN NULL ELSE o.rank END, CASE WHEN skip THEN NULL ELSE n END FROM walk w JOIN ordered o ON o.doc_id = w.doc_id AND o.i = w.i + 1,
LATERAL (SELECT o.t = '' OR w.used >= 5000 AS skip, length(regexp_replace(substr(o.t, 1, least(3000, greatest(5000 - w.used, 0))), '{WS}+$', '')) AS n))
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS at, rank, chars FROM walk WHERE rank IS NOT NULL""")
def generate_source_budget(spark, sf_dir):
    """The chunks of each document as its sources, under the prompt's budget."""
    taken = _sources(spark, sf_dir).select("doc_id", F.posexplode(generate.budgeted(F.col("sources"), GenerateConfig(max_source_chars=5_000))).alias("at", "s"))
    return taken.select("doc_id", "at", F.col("s.rank").cast("bigint").alias("rank"), F.length("s.text").alias("chars"))


SQL_ENTRY = f"""'### S' || rank || '. ' || coalesce(title, '') || chr(10) || chr(10) || '- Podcast: `' || coalesce(podcast_slug, '') || '`' || chr(10) || '- URL: ' || CASE WHEN coalesce(url, '') = '' THEN 'N/A' ELSE url END || chr(10) || '- Timestamp: ' || coalesce(st, '') || ' - ' || coalesce(et, '') || chr(10)
|| '- Chunk ID: `' || chunk_id || '`' || chr(10) || '- Doc ID: `' || doc_id || '`' || chr(10) || '- Chunk index: `' || ix || '`' || chr(10) || '- Retrieval distance: `' || CAST(distance AS VARCHAR) || '`' || chr(10) || '- Matched queries:' || chr(10) || '  - q1' || chr(10) || '  - q' || (ix + 2) || chr(10) || chr(10) || 'Retrieved excerpt:' || chr(10) || chr(10)
|| '> ' || CASE WHEN length(flat) > 1200 THEN regexp_replace(substr(flat, 1, 1200), '{WS}+$', '') || '...' ELSE flat END || chr(10)"""


@query(f"""WITH {SQL_SOURCES} SELECT doc_id, chr(10) || chr(10) || '## Source Appendix' || chr(10) || chr(10) || 'Made from the retrieved sources, not by the language model.' || chr(10) || chr(10) || string_agg({SQL_ENTRY}, chr(10) ORDER BY rank, distance, chunk_id) AS appendix
FROM (SELECT *, {sql_collapse("coalesce(text, '')")} AS flat FROM src) GROUP BY doc_id""")
def generate_appendix(spark, sf_dir):
    return _sources(spark, sf_dir).select("doc_id", generate.appendix(F.col("sources")).alias("appendix"))


@query(f"""WITH {SQL_SOURCES} SELECT doc_id, 'A: Question: about ' || doc_id || chr(10) || 'B: Go on.' || chr(10) || chr(10) || '## Source Appendix' || chr(10) || chr(10) || 'Made from the retrieved sources, not by the language model.' || chr(10) || chr(10) || string_agg({SQL_ENTRY}, chr(10) ORDER BY rank, distance, chunk_id) AS dialogue_md, 30 AS rounds, 2 AS dialogue_lines
FROM (SELECT *, {sql_collapse("coalesce(text, '')")} AS flat FROM src) GROUP BY doc_id""")
def generate_dialogues(spark, sf_dir):
    """Prompt, stand-in model, its notes cut, appendix: one dialogue for each document's chunks as sources."""
    packs = _sources(spark, sf_dir).select(
        F.col("doc_id").alias("query_id"), F.concat(F.lit("about "), F.col("doc_id")).alias("user_query"), rewrite.not_rewritten(F.col("doc_id"), F.lit("none")).alias("query_rewrite"),
        F.struct(F.lit("strong").alias("coverage_status"), F.lit(3).alias("usable_source_count"), F.lit(3).alias("strong_source_count")).alias("coverage"), "sources",
    )
    return pipeline.dialogues(packs, adapters.EchoGenerator).select(F.col("query_id").alias("doc_id"), "dialogue_md", "rounds", "dialogue_lines")


@query("SELECT doc_id, length(coalesce(title, '')) + length(coalesce(text, '')) AS chars FROM documents")
def generate_prompt_chars(spark, sf_dir):
    message = lambda role, c: F.struct(F.lit(role).alias("role"), F.coalesce(c, F.lit("")).alias("content"))
    return table(spark, sf_dir, "documents").select("doc_id", generate.prompt_chars(F.array(message("system", "title"), message("user", "text"))).alias("chars"))


@query(f"""WITH {SQL_SOURCES} SELECT doc_id, string_agg('[' || rank || '] distance=' || printf('%.4f', distance) || '~chunk_id: ' || chunk_id || '~title: ' || coalesce(title, '') || '~podcast_slug: ' || coalesce(podcast_slug, '') || '~url: ' || coalesce(url, '') || '~timestamp: ' || coalesce(st, '') || ' - ' || coalesce(et, '') || '~matched_queries: 2~preview: '
|| CASE WHEN length(flat) > 80 THEN regexp_replace(substr(flat, 1, 80), '{WS}+$', '') || '...' ELSE flat END, '~' ORDER BY rank, distance, chunk_id) AS listing FROM (SELECT *, {sql_collapse("coalesce(text, '')")} AS flat FROM src) GROUP BY doc_id""")
def retrieve_listing(spark, sf_dir):
    """What is shown of a pack's sources."""
    return _sources(spark, sf_dir).select("doc_id", F.array_join(retrieve.listing(F.col("sources"), 80), "~").alias("listing"))


@query(f"WITH {SQL_KNN} SELECT query_id, query_index, rank, chunk_id, round(distance, 6) AS distance FROM near")
def retrieve_flattened(spark, sf_dir):
    """Parallel result lists of each variant made rows again."""
    found = pipeline.candidates(_variants(spark, sf_dir), _vectors(spark, sf_dir), PICK)
    lists = found.groupBy("query_id", "query_index").agg(F.sort_array(F.collect_list(F.struct("rank", "chunk_id", "distance"))).alias("r"))
    nested = lists.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("query_index", "r"))).alias("v"))
    of = lambda name: F.transform("v", lambda q: F.transform(q["r"], lambda x: x[name]))
    results = nested.select("query_id", of("chunk_id").alias("ids"), of("distance").alias("distances"), of("chunk_id").alias("documents"))
    return retrieve.flattened(results).select("query_id", F.col("query_index").cast("bigint").alias("query_index"), F.col("rank").cast("bigint").alias("rank"), "chunk_id", F.round("distance", 6).alias("distance"))


@query(f"SELECT record_id, CASE WHEN {sql_strip("coalesce(title, '')")} = '' AND {sql_strip("coalesce(podcast_title, '')")} = '' THEN 'the query' ELSE concat_ws('|', CASE WHEN {sql_strip("coalesce(title, '')")} <> '' THEN title END, CASE WHEN {sql_strip("coalesce(podcast_title, '')")} <> '' THEN podcast_title END) END AS variants FROM source_documents")
def retrieve_usable_variants(spark, sf_dir):
    return table(spark, sf_dir, "source_documents").select("record_id", F.array_join(retrieve.usable_variants(F.array("title", "podcast_title"), F.lit("the query")), "|").alias("variants"))


# Pages made of columns of the tables, read back as HTML

SQL_ESCAPED = "replace(replace(replace(replace(X, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


def _escaped(x):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def _page(body, head="Menu"):
    return F.concat(F.lit(f"<html><head><title>t</title><script>var a = '<p>no</p>';</script></head><body><header>{head}</header><nav><a href='/'>Home</a></nav><main>"), body, F.lit("</main><footer>About <b>us</b></footer></body></html>"))


@query(f"SELECT doc_id, coalesce(list_aggregate(list_filter(list_transform(string_split_regex(coalesce(text, ''), '{LINES}'), lambda s: {sql_collapse('s')}), lambda s: s <> ''), 'string_agg', chr(10)), '') AS text FROM documents")
def page_text(spark, sf_dir):
    """Visible lines of a page around each text, without its menus, scripts and footers."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.array_join(H.visible_lines_udf(_page(F.concat(F.lit("<p>"), _escaped(F.coalesce("text", F.lit(""))), F.lit("<form><button>Send</button></form>")))), "\n").alias("text"))


@query(f"SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN doc_id % 40 + 1 ELSE greatest(doc_id % 30, 1) END AS pages FROM documents")
def page_counts(spark, sf_dir):
    """Numbers of pages, from the words on a page or from its links."""
    n = F.col("doc_id")
    said = F.concat(F.lit("<div class='podcast-page-info x'>Page 1 of "), (n % 40 + 1).cast("string"), F.lit("</div><a href='?page=99'>x</a>"))
    links = F.concat(F.lit("<div class='pagination'><a href='/p?page="), (n % 30).cast("string"), F.lit("'>n</a><a href='/p'>first</a></div>"))
    return table(spark, sf_dir, "documents").select("doc_id", H.total_pages_udf(_page(F.when(n % 2 == 0, said).otherwise(links))).alias("pages"))


@query(f"SELECT record_id, nullif({sql_collapse('title')}, '') AS podcast, {sql_collapse('title')} AS episode FROM source_documents WHERE title IS NOT NULL")
def page_titles(spark, sf_dir):
    """Titles of podcasts and episodes as their pages show them."""
    docs = table(spark, sf_dir, "source_documents").where("title is not null")
    podcast = F.concat(F.lit("<h1>Other</h1><h1 class='podcast-title'>"), _escaped(F.col("title")), F.lit(" - Page 3</h1>"))
    episode = F.concat(F.lit("<nav><h1>Transcript of "), _escaped(F.col("title")), F.lit("</h1></nav>"))
    return docs.select("record_id", H.page_title_udf(podcast).alias("podcast"), H.episode_title_udf(episode).alias("episode"))


def _catalog_pages(spark, sf_dir):
    series = table(spark, sf_dir, "podcast_series").where("url is not null and catalog_page_url is not null")
    tag = lambda c, end: F.when(c.isNotNull(), F.concat(F.lit("<span class='tag'>"), _escaped(c.cast("string")), F.lit(f"{end}</span>"))).otherwise("")
    card = F.concat(
        F.lit("<a class='podcast-card' href=\""), _escaped(F.col("url")), F.lit("\"><div class='podcast-card-title'>"), _escaped(F.coalesce("title", F.lit(""))), F.lit("</div>"), tag(F.col("episode_count"), " episodes"), tag(F.col("views_text"), ""), F.lit("</a><a class='podcast-card'>none</a>"),
    )
    cards = F.transform(F.sort_array(F.collect_list(F.struct("url", "title", card.alias("card")))), lambda c: c["card"])
    return series.groupBy("catalog_page_url").agg(_page(F.array_join(cards, "")).alias("html"))


@query(rf"""WITH s AS (SELECT *, {sql_collapse("coalesce(title, '')")} AS t, string_split(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://[^/]*', ''), '/') AS parts, row_number() OVER (PARTITION BY url ORDER BY catalog_page_url, title NULLS FIRST) AS r FROM podcast_series WHERE url IS NOT NULL AND catalog_page_url IS NOT NULL)
SELECT url, catalog_page_url, list_filter(parts, lambda x: x <> '')[-1] AS slug, CASE WHEN t = '' THEN list_filter(parts, lambda x: x <> '')[-1] ELSE t END AS title, episode_count, CASE WHEN views_text ILIKE '%view%' THEN views_text END AS views_text FROM s WHERE r = 1""")
def page_catalog(spark, sf_dir):
    """Podcasts of catalogue pages, each address once, where it comes first."""
    pages = _catalog_pages(spark, sf_dir).withColumnRenamed("catalog_page_url", "url")
    return scrape.catalog(pages.withColumn("at", F.col("url")), "at").select("url", "catalog_page_url", "slug", "title", "episode_count", "views_text")


def _episode_rows(spark, sf_dir):
    """One episode for each address: that of the smallest record."""
    docs = table(spark, sf_dir, "source_documents").where("url is not null and title is not null and list_page_url is not null").withColumn("url", F.regexp_replace(F.trim("url"), "[&\"'<>\\s]|#.*$", ""))
    docs = docs.withColumn("list_page_url", F.regexp_replace(F.trim("list_page_url"), "[&\"'<>\\s]|#.*$", "")).where("url like 'http%' and list_page_url like 'http%'")
    return sinks.first_rows(docs.select("record_id", "url", "list_page_url", "title", "description", "duration", "published_text", "podcast_title", "clean_text"), "url", [F.col("record_id")])


def _list_pages(episodes):
    tag = lambda c: F.when(c.isNotNull(), F.concat(F.lit("<i class='tag'>"), _escaped(c), F.lit("</i>"))).otherwise("")
    card = F.concat(
        F.lit("<a class='podcast-episode-card' href=\""), _escaped(F.col("url")), F.lit("\" aria-label=\"Read "), _escaped(F.col("title")), F.lit("\"><p class='podcast-episode-description'>"), _escaped(F.coalesce("description", F.lit(""))), F.lit("</p>"), tag(F.col("duration")), tag(F.col("published_text")), F.lit("</a>"),
    )
    cards = F.transform(F.sort_array(F.collect_list(F.struct("record_id", card.alias("card")))), lambda c: c["card"])
    return episodes.groupBy(F.col("list_page_url").alias("url")).agg(_page(F.array_join(cards, "")).alias("html"))


SQL_EPISODES = f"""e0 AS (SELECT record_id, regexp_replace(trim(url, ' '), '[&"''<>\t\n\f\r ]|#.*$', '', 'g') AS url, regexp_replace(trim(list_page_url, ' '), '[&"''<>\t\n\f\r ]|#.*$', '', 'g') AS list_page_url, title, description, duration, published_text, podcast_title, clean_text FROM source_documents WHERE url IS NOT NULL AND title IS NOT NULL AND list_page_url IS NOT NULL),
e1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY record_id) AS r FROM e0 WHERE url LIKE 'http%' AND list_page_url LIKE 'http%') WHERE r = 1),
e AS (SELECT *, {sql_strip('title')} AS shown FROM e1 WHERE {sql_strip('title')} <> '')"""


@query(f"""WITH {SQL_EPISODES} SELECT url, list_page_url, shown AS title, {sql_collapse("coalesce(description, '')")} AS description, CASE WHEN regexp_full_match({sql_collapse('duration')}, '[0-9]{{1,2}}:[0-9]{{2}}') THEN {sql_collapse('duration')} END AS duration, CASE WHEN {sql_collapse('published_text')} ILIKE 'published%' THEN {sql_collapse('published_text')} END AS published_text FROM e""")
def page_listing(spark, sf_dir):
    """Episodes of listing pages, each address once."""
    pages = _list_pages(_episode_rows(spark, sf_dir))
    return scrape.listing(pages.withColumn("at", F.col("url")), "at").select("url", "list_page_url", "title", "description", "duration", "published_text")


SQL_SPOKEN = f"""sl AS (SELECT record_id, unnest(ls) AS x, generate_subscripts(ls, 1) AS i FROM (SELECT record_id, list_filter(list_transform(string_split_regex(coalesce(clean_text, ''), '{LINES}'), lambda s: {sql_collapse('s')}), lambda s: s <> '' AND NOT regexp_full_match(s, '[0-9]{{1,2}}:[0-9]{{2}}:[0-9]{{2}}')) AS ls FROM source_documents)),
cut AS (SELECT record_id, min(i) AS stop FROM sl WHERE lower(x) IN ('about us', 'contact us', 'privacy', 'terms') OR starts_with(lower(x), 'description of ') GROUP BY record_id),
seg AS (SELECT record_id, (i - 1) // 3 AS block, string_agg(x, ' ' ORDER BY i) AS t FROM sl LEFT JOIN cut USING (record_id) WHERE (stop IS NULL OR i < stop) AND lower(x) NOT IN ('copy link to transcript', 'audio transcription by', 'transcribed from audio to text by') GROUP BY 1, 2)"""


def _spoken(text):
    """Visible lines of a transcript page: a time before every third line."""
    lines = F.filter(F.transform(T.lines(F.coalesce(text, F.lit(""))), T.collapse), lambda s: (s != "") & ~scrape.is_time(s))
    return F.flatten(F.transform(lines, lambda s, i: F.when(i % 3 == 0, F.array(F.format_string("%02d:%02d:00", (i / 180).cast("int"), (i / 3).cast("int") % 60), s)).otherwise(F.array(s))))


@query(f"WITH {SQL_SPOKEN} SELECT record_id, printf('%02d:%02d:00', block // 60, block % 60) AS timestamp, t AS text FROM seg")
def scrape_segments(spark, sf_dir):
    """Transcript segments of visible lines: from each time to the next, labels left out, nothing from a closing line on."""
    docs = spread(table(spark, sf_dir, "source_documents").select("record_id", "clean_text")).withColumn("l", _spoken(F.col("clean_text")))
    return docs.select("record_id", F.inline(scrape.segments(F.col("l")))).select("record_id", "timestamp", "text")


@query(f"""WITH {SQL_SPOKEN}, fb AS (SELECT record_id, string_agg(x, chr(10) ORDER BY i) AS t FROM sl WHERE lower(x) NOT IN ('home', 'podcasts', 'youtube channels', 'about us', 'request podcast', 'copy link to transcript', 'audio transcription by', 'privacy', 'terms') AND NOT starts_with(x, 'Transcript of ') GROUP BY record_id)
SELECT record_id, coalesce(t, '') AS text FROM source_documents LEFT JOIN fb USING (record_id)""")
def scrape_fallback(spark, sf_dir):
    """The text of pages without times."""
    lines = F.filter(F.transform(T.lines(F.coalesce("clean_text", F.lit(""))), T.collapse), lambda s: (s != "") & ~scrape.is_time(s))
    return table(spark, sf_dir, "source_documents").select("record_id", scrape.fallback(lines).alias("text"))


SQL_MADE = f"""{SQL_SPOKEN}, doc AS (SELECT record_id, string_agg('[' || printf('%02d:%02d:00', block // 60, block % 60) || '] ' || t, chr(10) ORDER BY block) AS clean_text, count(*) AS segments FROM seg GROUP BY record_id)"""


@query(f"""WITH {SQL_EPISODES}, {SQL_MADE} SELECT e.url, e.shown AS title, e.list_page_url, coalesce(d.clean_text, '') AS clean_text, sha256(coalesce(d.clean_text, '')) AS content_hash, coalesce(segments, 0) AS segment_count, length(coalesce(d.clean_text, '')) AS text_char_count,
'shop' AS podcast_title FROM e LEFT JOIN doc d USING (record_id) WHERE e.record_id % 4 <> 0 AND e.record_id % 11 <> 3""")
def acquire_documents(spark, sf_dir):
    """From listing pages to new source documents, over pages kept in a table: a quarter of the episodes is there already, and some pages cannot be had."""
    episodes = stored(_episode_rows(spark, sf_dir).where(T.strip(F.col("title")) != ""), "episodes")
    lists = _list_pages(episodes)
    # One podcast with a single list that links all episodes' own lists would not be like a site: each list page is a podcast here.
    series = lists.select("url", T.slug_from_url(F.col("url")).alias("slug"), F.lit("shop").alias("title"))
    paras = F.transform(_spoken(F.col("clean_text")), lambda s: F.concat(F.lit("<p>"), _escaped(s), F.lit("</p>")))
    pages = lists.unionByName(episodes.where("record_id % 11 <> 3").select("url", _page(F.array_join(paras, "")).alias("html")))
    existing = episodes.where("record_id % 4 = 0").select("url")
    docs, _ = acquire.new_documents(series, existing, stored(pages, "pages"), "host.example", "site", "2024-01-01T00:00:00+00:00", list_url=F.col("root"))
    return docs.select("url", "title", "list_page_url", "clean_text", "content_hash", "metadata.segment_count", "metadata.text_char_count", "podcast_title")


# Scans and sinks: tables written as files and read back


def _lines_of(spark, sf_dir, *columns):
    return table(spark, sf_dir, "source_documents").select("record_id", "batch_no", F.to_json(F.struct("record_id", *columns)).alias("value"))


def _broken_file(spark, sf_dir):
    """Documents as JSON lines, each behind a blank line, every seventh broken; a few files."""
    path = new_path(spark, "scan-broken")
    text = F.when(F.col("record_id") % 7 == 3, F.concat(F.lit("{broken "), F.col("record_id").cast("string"))).otherwise(F.col("value"))
    _lines_of(spark, sf_dir, "title").repartition(3, "record_id").select(F.concat(F.lit("\n"), text)).write.text(path)
    return path


@query("SELECT record_id, title FROM source_documents WHERE record_id % 7 <> 3")
def scan_lenient(spark, sf_dir):
    return jsonl.lenient(spark, _broken_file(spark, sf_dir), "record_id bigint, title string")[0].select("record_id", "title")


@query("SELECT '{broken ' || record_id AS line FROM source_documents WHERE record_id % 7 = 3")
def scan_problems(spark, sf_dir):
    return jsonl.lenient(spark, _broken_file(spark, sf_dir), "record_id bigint, title string")[1].select("line")


@query("SELECT record_id, title FROM source_documents WHERE record_id % 7 <> 3")
def scan_dropping(spark, sf_dir):
    return jsonl.dropping(spark, _broken_file(spark, sf_dir), "record_id bigint, title string").where("record_id is not null")


@query("SELECT record_id, title, clean_text FROM source_documents")
def scan_strict(spark, sf_dir):
    path = new_path(spark, "scan-strict")
    _lines_of(spark, sf_dir, "title", "clean_text").select("value").write.text(path)
    return jsonl.strict(spark, path, "record_id bigint, title string, clean_text string")


@query("SELECT count(*) AS documents, count(*) FILTER (record_id % 7 = 3) AS broken, 2 * count(*) AS last_lines, true AS even FROM source_documents")
def scan_numbered(spark, sf_dir):
    """Physical line numbers: every document stands in an even line, and the last lines of all files add up."""
    rows = jsonl.numbered(spark, _broken_file(spark, sf_dir), "record_id bigint, title string")
    by_file = rows.groupBy("source_file").agg(F.max("line_no").alias("last"), F.count("*").alias("n"), F.count_if("broken").alias("broken"), F.min(F.col("line_no") % 2 == 0).alias("even"), F.count_distinct("line_no").alias("d"))
    return by_file.agg(F.sum("d").alias("documents"), F.sum("broken").alias("broken"), F.sum("last").alias("last_lines"), F.min("even").alias("even"))


def _by_slug(spark, sf_dir):
    path = new_path(spark, "scan-folders")
    rows = _lines_of(spark, sf_dir).join(table(spark, sf_dir, "source_documents").select("record_id", F.coalesce("metadata.podcast_slug", F.lit("catalog")).alias("slug")), "record_id")
    rows.select("slug", "value").write.partitionBy("slug").text(path)
    return path


@query("SELECT record_id, 'slug=' || metadata.podcast_slug AS podcast_slug FROM source_documents WHERE metadata.podcast_slug IS NOT NULL")
def scan_partitioned(spark, sf_dir):
    """Documents of all podcasts' folders but the one of the catalogue."""
    return jsonl.partitioned(spark, _by_slug(spark, sf_dir), "record_id bigint", "*.txt", ("slug=catalog",)).select("record_id", "podcast_slug")


@query("SELECT record_id, coalesce(metadata.podcast_slug, 'catalog') AS slug FROM source_documents")
def scan_recursive(spark, sf_dir):
    path = _by_slug(spark, sf_dir)
    return jsonl.recursive(spark, path, "record_id bigint", "*.txt").select("record_id", jsonl.slug_below(F.col("source_file"), path).alias("slug"))


@query("SELECT record_id FROM source_documents WHERE coalesce(metadata.podcast_slug, 'catalog') IN (SELECT DISTINCT coalesce(metadata.podcast_slug, 'catalog') AS s FROM source_documents ORDER BY s LIMIT 3)")
def scan_first_files(spark, sf_dir):
    """Of one file a folder, the first three by path."""
    path = new_path(spark, "scan-files")
    rows = spark.read.text(_by_slug(spark, sf_dir))
    rows.repartition("slug").write.partitionBy("slug").option("maxRecordsPerFile", 0).text(path)
    return jsonl.recursive(spark, path, "record_id bigint", "*.txt", max_files=3).select("record_id")


@query("SELECT count(*) AS documents, max(length(clean_text)) AS longest FROM source_documents")
def scan_document(spark, sf_dir):
    """A report written as one JSON document over several lines, and read again."""
    path = new_path(spark, "scan-document")
    table(spark, sf_dir, "source_documents").agg(F.count("*").alias("documents"), F.max(F.length("clean_text")).alias("longest")).select(sinks.pretty(F.struct("documents", "longest")).alias("value")).coalesce(1).write.text(path)
    return jsonl.document(spark, path, "documents bigint, longest bigint")


@query("SELECT record_id, title, published_date FROM source_documents UNION ALL SELECT record_id, title, published_date FROM source_documents WHERE batch_no = 0")
def sink_jsonl(spark, sf_dir):
    """JSON lines overwritten, then appended; the writers count what they write."""
    path, docs = new_path(spark, "sink-jsonl"), table(spark, sf_dir, "source_documents").select("record_id", "batch_no", "title", "published_date")
    assert sinks.write_jsonl(docs, path) == docs.count()
    assert sinks.write_jsonl(docs.where("batch_no = 0"), path, append=True) == docs.where("batch_no = 0").count()
    return spark.read.schema("record_id bigint, title string, published_date string").json(path)


@query("SELECT record_id, batch_no FROM source_documents WHERE CASE WHEN batch_no IN (0, 1) THEN record_id % 3 = 0 ELSE batch_no <> 2 END")
def sink_partitions(spark, sf_dir):
    """Written twice by batch: batches with rows are replaced, a batch that was to come and has no rows is emptied, the others stay."""
    path, docs = new_path(spark, "sink-partitions"), table(spark, sf_dir, "source_documents").select("record_id", "batch_no")
    sinks.write_partitions(docs, path, "batch_no")
    sinks.write_partitions(docs.where("batch_no in (0, 1) and record_id % 3 = 0"), path, "batch_no", expected=docs.where("batch_no in (0, 1, 2)").select("batch_no"))
    return spark.read.schema("record_id bigint, batch_no int").json(path)


@query("SELECT doc_id, record_id FROM (SELECT doc_id, record_id, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN batch_no = 0 THEN 0 ELSE 1 END, record_id) AS r FROM source_documents WHERE doc_id IS NOT NULL) WHERE r = 1")
def sink_append_new(spark, sf_dir):
    """Rows added once by doc_id, first those of batch 0, then all: of equal keys the first stays."""
    path, docs = new_path(spark, "sink-append"), table(spark, sf_dir, "source_documents").where("doc_id is not null").select("doc_id", "record_id", "batch_no")
    sinks.append_new(docs.where("batch_no = 0"), path, "doc_id", [F.col("record_id")])
    return sinks.append_new(docs, path, "doc_id", [F.col("record_id")]).select("doc_id", "record_id")


@query("SELECT id, count(*) AS n FROM vectors WHERE podcast_slug IS NOT NULL GROUP BY id")
def sink_vector_table(spark, sf_dir):
    """A vector table opened (and so created), begun anew with other rows, and opened again."""
    path, schema = new_path(spark, "sink-vectors"), "id string, podcast_slug string"
    _, none = sinks.open_table(spark, path, schema)
    assert none == 0
    sinks.reset(table(spark, sf_dir, "vectors").where("podcast_slug is not null").select("id", "podcast_slug"), path)
    return sinks.open_table(spark, path, schema)[0].groupBy("id").agg(F.count("*").alias("n"))


@query(f"""WITH k AS (SELECT record_id, ['catalog_page', 'podcast_list_page', 'episode_page', 'other'][CAST(record_id % 4 AS INT) + 1] AS kind, metadata.podcast_slug AS pod, url FROM source_documents WHERE url IS NOT NULL AND metadata.podcast_slug IS NOT NULL),
p AS (SELECT CASE kind WHEN 'catalog_page' THEN 'catalog/page_' || printf('%03d', page) || '.html' WHEN 'podcast_list_page' THEN pod || '/list_pages/page_' || printf('%03d', page) || '.html'
WHEN 'episode_page' THEN pod || '/episode_pages/' || CASE WHEN len({SQL_PARTS}) > 0 THEN {SQL_PARTS}[-1] ELSE 'unknown-' || substr(sha256(url), 1, 16) END || '.html' ELSE 'misc/' || substr(sha256(url), 1, 16) || '.html' END AS path, url
FROM (SELECT *, coalesce(CAST(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS BIGINT), 1) AS page FROM k)) SELECT path, min(url) AS url FROM p GROUP BY path""")
def sink_raw_pages(spark, sf_dir):
    """Raw pages kept write-once by the path of their kind: a second writing changes nothing."""
    path, docs = new_path(spark, "sink-pages"), table(spark, sf_dir, "source_documents").where("url is not null and metadata.podcast_slug is not null")
    kind = F.element_at(F.array(*[F.lit(k) for k in ("catalog_page", "podcast_list_page", "episode_page", "other")]), (F.col("record_id") % 4 + 1).cast("int"))
    pages = docs.select(kind.alias("kind"), F.col("metadata.podcast_slug").alias("slug"), "url", F.col("url").alias("html"))
    sinks.keep_pages(pages, path)
    return sinks.keep_pages(pages.withColumn("html", F.lit("other")), path).where("html <> 'other'").select("path", "url")


@query("SELECT slug AS podcast_slug, count(*) AS written FROM podcast_series WHERE slug IS NOT NULL GROUP BY slug")
def adapter_fetch_summary(spark, sf_dir):
    """Written, skipped and failed pages of a run add up to its links."""
    links = table(spark, sf_dir, "podcast_series").where("slug is not null").select(F.col("slug").alias("podcast_slug"), F.concat(F.lit("https://h.example/"), F.col("slug")).alias("url"))
    fetched = adapters.fetched(links.where(F.pmod(F.crc32("url"), F.lit(3)) > 0), functools.partial(adapters.EchoFetcher, fails="a-"))
    found = adapters.fetch_summary(fetched, links, "podcast_slug")
    return found.select("podcast_slug", (F.col("written") + F.col("skipped") + F.col("failed")).alias("written"))


@query("SELECT slug AS name, title AS text FROM (SELECT slug, max(title) AS title FROM podcast_series WHERE slug IS NOT NULL AND title IS NOT NULL GROUP BY slug)")
def sink_texts(spark, sf_dir):
    """A file for each podcast, written by the tasks, and read back."""
    path = new_path(spark, "sink-texts")
    rows = table(spark, sf_dir, "podcast_series").where("slug is not null and title is not null").groupBy(F.col("slug").alias("name")).agg(F.max("title").alias("md"))
    assert sinks.write_texts(rows, path, "name", "md") == rows.count()
    return spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"^(.*)\.md$", 1).alias("name"), F.col("value").alias("text"))


@query("SELECT count(*) AS documents, min(length(coalesce(clean_text, ''))) AS min_chars, max(length(coalesce(clean_text, ''))) AS max_chars, avg(length(coalesce(clean_text, ''))) AS avg_chars FROM source_documents")
def sink_report(spark, sf_dir):
    """A report written twice over, and read back."""
    path = new_path(spark, "sink-report")
    for _ in range(2):
        sinks.write_report(audit.summary(table(spark, sf_dir, "source_documents"), chars()), path)
    return spark.read.schema("documents bigint, min_chars int, max_chars int, avg_chars double").json(path)


@query(f"WITH {SQL_CLEAN} SELECT url, min(record_id) AS record_id FROM cleaned JOIN (SELECT record_id, url FROM source_documents WHERE url IS NOT NULL) USING (record_id) WHERE cleaned_chars >= 1000 GROUP BY url")
def stream_ingest(spark, sf_dir):
    """A stream of JSON lines cleaned and added once by address: of equal addresses the first by file and place."""
    at = new_path(spark, "stream")
    docs = table(spark, sf_dir, "source_documents").select("record_id", "url", "clean_text")
    docs.repartitionByRange(4, "record_id").sortWithinPartitions("record_id").write.json(f"{at}/in")
    ingest.ingest(ingest.arriving(spark, f"{at}/in", "record_id bigint, url string, clean_text string"), f"{at}/table", f"{at}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{at}/table").select("url", "record_id")


@query("""SELECT * FROM (VALUES ('raw_top_k_per_query', '30'), ('final_top_k', '5'), ('max_chunks_per_doc', '1'), ('max_chunks_per_podcast', '3'), ('max_chunks_per_title', '1'), ('preview_chars', '500'), ('min_relevance_distance', '0.5'), ('weak_relevance_distance', '0.4'), ('min_sources_required', '3')) t(setting, value)""")
def config_effective(spark, sf_dir):
    """Settings from defaults, a file and a caller; a caller's zero does not count, and a file that is missing changes nothing."""
    import tempfile

    with tempfile.NamedTemporaryFile("w", suffix=".yaml") as f:  # a settings file of the driver
        f.write("retrieval:\n  final_top_k: 6 # of the file\n  min_relevance_distance: 0.5\n  unknown: 1\n")
        f.flush()
        given = load_yaml(f.name)["retrieval"] | load_yaml(f.name + ".none").get("retrieval", {})
    found = merged(RetrieveConfig(), given, final_top_k=5, preview_chars=0)
    return spark.createDataFrame([(k, str(v)) for k, v in dataclasses.asdict(found).items()], "setting string, value string")


@query(f"""WITH t AS (SELECT record_id, i, {sql_collapse('x')} AS s FROM (SELECT record_id, unnest([title, podcast_title, upper(title)]) AS x, unnest([0, 1, 2]) AS i FROM source_documents)),
u AS (SELECT record_id, lower(s) AS k, min(i) AS i, arg_min(s, i) AS s FROM t WHERE s <> '' GROUP BY record_id, lower(s)), j AS (SELECT record_id, string_agg(s, ' ' ORDER BY i) AS joined FROM u GROUP BY record_id)
SELECT record_id, CASE WHEN joined IS NULL THEN 'request ' || record_id ELSE 'request ' || record_id || '|' || joined END AS variants FROM source_documents LEFT JOIN j USING (record_id)""")
def rewrite_canonical(spark, sf_dir):
    """Answers without a core query: the distinct terms in one string stand for it."""
    docs = table(spark, sf_dir, "source_documents")
    terms = F.filter(F.array("title", "podcast_title", F.upper("title")), lambda x: x.isNotNull())
    asked = docs.select("record_id", F.concat(F.lit("request "), F.col("record_id").cast("string")).alias("query"), F.to_json(F.struct(terms.alias("canonical_terms"), F.lit(" ").alias("core_query"))).alias("answer"))
    return rewrite.parsed(asked).select("record_id", F.array_join("result.retrieval_queries", "|").alias("variants"))


@query("SELECT slug, slug IN (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL) AS available FROM podcast_series WHERE slug IS NOT NULL")
def adapter_available(spark, sf_dir):
    """Which of the names asked for a remote list has."""
    have = table(spark, sf_dir, "documents").select(F.col("source").alias("model"))
    return adapters.available(table(spark, sf_dir, "podcast_series").where("slug is not null").select("slug"), "slug", have, "model")
