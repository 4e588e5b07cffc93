"""Column functions on strings, hashes and addresses. All but NFKC and ``resolve`` are built-in expressions."""

from __future__ import annotations

import unicodedata
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.layout import arrow

# White space as Python counts it: Java's Unicode white space and the four information separators.
SPACE = r"[\s\x1c-\x1f]"
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
TIMESTAMP_LINE = r"^\s*\[?(\d{1,2}:\d{2}(?::\d{2})?)\]?\s*(.*)$"


def strip(x: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.btrim(x, F.lit(SPACES))


def rstrip(x: Column) -> Column:
    return F.rtrim(x, F.lit(SPACES))


def collapse(x: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.trim(F.regexp_replace(x, rf"(?U){SPACE}+", " "))


def blank_to_null(x: Column) -> Column:
    return F.when(strip(x) != "", x)


@arrow(pa.string())
def _nfkc(x: pa.Array) -> pa.Array:
    return pa.array([v if v is None else unicodedata.normalize("NFKC", v) for v in x.to_pylist()], pa.string())


def nfkc(x: Column) -> Column:
    """NFKC; only texts with characters beyond ASCII go through Python."""
    return F.coalesce(_nfkc(F.when(x.rlike(r"[^\x00-\x7f]"), x)), x)


def lines(x: Column) -> Column:
    """The lines of a text, broken wherever Python's splitlines breaks."""
    return F.split(x, LINE_ENDS, -1)


def normalized_lines(x: Column) -> Column:
    """NFKC, no-break spaces to spaces, lines with single blanks, stripped, blank ones dropped."""
    each = F.transform(lines(F.translate(nfkc(F.coalesce(x, F.lit(""))), " ", " ")), lambda s: strip(F.regexp_replace(s, r"[ \t]+", " ")))
    return F.filter(each, lambda s: s != "")


def normalize_text(x: Column) -> Column:
    return F.array_join(normalized_lines(x), "\n")


def clean_lines(x: Column) -> Column:
    """Scraped text: no-break spaces to spaces, white space of each line to single blanks, blank lines dropped."""
    each = F.transform(lines(F.translate(F.coalesce(x, F.lit("")), " ", " ")), collapse)
    return F.array_join(F.filter(each, lambda s: s != ""), "\n")


def preview(x: Column, n: int) -> Column:
    """The collapsed text, cut to n characters with "..." if it is longer."""
    flat = collapse(x)
    return F.when(F.length(flat) > n, F.concat(rstrip(F.substring(flat, 1, n)), F.lit("..."))).otherwise(flat)


def title_key(title: Column) -> Column:
    """A title without years and punctuation, for capping: '' for null and for titles without Latin letters and digits."""
    x = F.regexp_replace(strip(F.lower(title)), r"(?U)\(\s*20\d{2}\s*\)", "")
    x = F.regexp_replace(x, r"(?U)\b20\d{2}\b", "")
    return F.coalesce(F.trim(F.regexp_replace(x, r"[^a-z0-9]+", " ")), F.lit(""))


def without_prefix(x: Column, word: str) -> Column:
    """Without a leading word such as Read or Visit, in any case."""
    return strip(F.regexp_replace(F.coalesce(x, F.lit("")), rf"(?iU)^\s*{word}\s+", ""))


def without_page_suffix(x: Column) -> Column:
    return F.regexp_replace(x, r"(?iU)\s+-\s+Page\s+\d+\s*$", "")


def rounds(query: Column, default: int, most: int = 80) -> Column:
    """Rounds asked for in a text: 轮, 回合 and rounds count as such, turns are halved upwards; within 1..most, else ``default``."""
    x = F.translate(query, "０１２３４５６７８９", "0123456789")
    asked = lambda unit: F.nullif(F.regexp_extract(x, rf"(?iU)(\d+)\s*{unit}", 1), F.lit("")).cast("decimal(38,0)")
    whole = F.coalesce(asked("轮"), asked("回合"), asked("rounds?"), F.floor((asked("turns?") + 1) / 2))
    return F.when(whole.isNotNull(), F.least(F.greatest(whole, F.lit(1)), F.lit(most)).cast("int")).otherwise(default)


def without_source_notes(x: Column) -> Column:
    """A generated text up to its first heading of source notes."""
    out = rstrip(x)
    for heading in ("Source Notes", "Sources", "Source Appendix"):
        out = rstrip(F.regexp_replace(out, rf"(?isU)\n+##\s*{heading}\b.*$", ""))
    return out


def run_stamp(at: Column) -> Column:
    """A moment as runs are named by it: 20240131_235959."""
    return F.date_format(at, "yyyyMMdd_HHmmss")


def iso_stamp(at: Column) -> Column:
    """A moment of a UTC session in ISO form, whole seconds."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def sentences(x: Column) -> Column:
    """Split at white space behind sentence punctuation."""
    return F.split(x, rf"(?U)(?<=[.!?。！？]){SPACE}+", -1)


def paragraphs(x: Column) -> Column:
    return F.filter(F.transform(F.split(x, rf"(?U)\n{SPACE}*\n+", -1), strip), lambda p: p != "")


def is_timestamp_line(line: Column) -> Column:
    """A line that begins with a time and whose rest does not speak of am or pm."""
    rest = F.lower(F.regexp_extract(line, TIMESTAMP_LINE, 2))
    return line.rlike(TIMESTAMP_LINE) & ~rest.rlike(r"\b(am|pm)\b")


def sha256(x: Column) -> Column:
    return F.sha2(x, 256)


def short_hash(x: Column, n: int = 16) -> Column:
    return F.substring(F.sha1(x), 1, n)


def chunk_hash(text: Column) -> Column:
    return short_hash(collapse(text))


def path_parts(url: Column) -> Column:
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.filter(F.split(path, "/", -1), lambda p: p != "")


def id_from_url(url: Column, site: str) -> Column:
    """site__ and the last two parts of the path, else 16 digits of the address's hash."""
    parts = path_parts(url)
    return F.concat(F.lit(f"{site}__"), F.when(F.size(parts) >= 2, F.array_join(F.slice(parts, -2, 2), "__")).otherwise(F.substring(sha256(url), 1, 16)))


def slug_from_url(url: Column) -> Column:
    parts = path_parts(url)
    return F.when(F.size(parts) > 0, F.element_at(parts, -1)).otherwise(F.concat(F.lit("unknown-"), F.substring(sha256(url), 1, 16)))


def page_url(url: Column, page: Column, host: str) -> Column:
    """The address of page n of a listing: query and fragment dropped, ?page=n unless it is the first."""
    scheme = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    own = F.regexp_extract(url, r"//([^/?#]*)", 1)
    path = F.regexp_replace(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1), "/+$", "")
    base = F.concat(F.when(scheme != "", scheme).otherwise("https"), F.lit("://"), F.when(own != "", own).otherwise(host), F.when(path != "", path).otherwise("/"))
    return F.when(page == 1, base).otherwise(F.concat(base, F.lit("?page="), page.cast("string")))


def page_number(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"[?&]page=(\d+)", 1), F.lit("")).cast("bigint")


@arrow(pa.string())
def _urljoin(base: pa.Array, href: pa.Array) -> pa.Array:
    return pa.array([None if b is None or h is None else urljoin(b, h) for b, h in zip(base.to_pylist(), href.to_pylist())], pa.string())


def resolve(base: Column, href: Column) -> Column:
    """An address as it stands on a page of ``base``; whole addresses do not go through Python."""
    whole = href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://")
    return F.coalesce(F.when(whole, href), _urljoin(base, F.when(~whole, href)))


def distinct_ignoring_case(items: Column) -> Column:
    """Collapsed strings in order, blank ones dropped, each once whatever its case, in the first spelling."""
    flat = F.filter(F.transform(items, collapse), lambda s: s != "")
    low = F.transform(flat, F.lower)
    first = F.filter(F.sequence(F.lit(1), F.size(flat)), lambda i: F.array_position(low, F.element_at(low, i.cast("int"))) == i)
    return F.when(F.size(flat) > 0, F.transform(first, lambda i: F.element_at(flat, i.cast("int")))).otherwise(F.array().cast("array<string>"))
