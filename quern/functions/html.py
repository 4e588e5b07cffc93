"""Lenient HTML reading on the standard library's parser, as Arrow UDFs: visible text, cards, page counts, titles."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser
from urllib.parse import parse_qs, urljoin, urlparse

import pyarrow as pa

from quern.functions.layout import arrow

# Parts of a page that are no text of it, and elements that have no end tag.
NOISE = frozenset("script style noscript svg header footer nav aside form button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: "Node | None"):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        """This element and all below it, in order of the page; no recursion, so depth does not matter."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def first(self, tag: str | None = None, cls: str | None = None) -> "Node | None":
        return next(self.all(tag, cls), None)

    def all(self, tag: str | None = None, cls: str | None = None):
        return (n for n in self.walk() if n is not self and (tag is None or n.tag == tag) and (cls is None or cls in n.classes()))

    def texts(self, noise: bool = True) -> list[str]:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif noise or node.tag not in NOISE:
                stack += reversed(node.children)
        return out


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def compact(text: str) -> str:
    return re.sub(r"\s+", " ", text.replace("\xa0", " ")).strip()


def words_of(node: Node | None) -> str:
    return compact(" ".join(node.texts())) if node is not None else ""


def visible_lines(html: str) -> list[str]:
    """Non-blank lines of the visible text of main, else body, else the page, without noise elements."""
    root = parse(html)
    node = root.first("main") or root.first("body") or root
    return [s for s in (compact(x) for x in "\n".join(node.texts(noise=False)).splitlines()) if s]


def total_pages(html: str) -> int:
    """Pages of a listing: "Page x of N", else the greatest page= of its links (a pagination counts as one), else 1."""
    root = parse(html)
    info = root.first(cls="podcast-page-info")
    if info is not None and (found := re.search(r"Page\s+\d+\s+of\s+(\d+)", " ".join(info.texts()))):
        return int(found[1])
    numbers = {int(v) for a in root.all("a") if "page=" in a.attrs.get("href", "") for v in parse_qs(urlparse(a.attrs["href"]).query).get("page", []) if v.isdigit()}
    return max(numbers | ({1} if root.first(cls="pagination") else set()), default=1)


def page_title(html: str) -> str | None:
    """The podcast's title: h1.podcast-title, else h1, without " - Page N"."""
    root = parse(html)
    node = root.first("h1", "podcast-title") or root.first("h1")
    return (re.sub(r"\s+-\s+Page\s+\d+\s*$", "", words_of(node), flags=re.IGNORECASE) or None) if node is not None else None


def episode_title(html: str) -> str | None:
    """The episode's title: the first h1, noise elements included, without "Transcript of"."""
    node = parse(html).first("h1")
    return re.sub(r"^Transcript of\s+", "", words_of(node), flags=re.IGNORECASE).strip() if node is not None else None


def _slug(url: str) -> str | None:
    parts = [p for p in urlparse(url).path.split("/") if p]
    return parts[-1] if parts else None


def podcast_cards(html: str, page: str) -> list[dict]:
    """a.podcast-card[href]: title as shown, else of aria-label, else the slug; tags give episodes (number) and views (the last one)."""
    out = []
    for card in parse(html).all("a", "podcast-card"):
        if not card.attrs.get("href"):
            continue
        url = urljoin(page, card.attrs["href"])
        label = re.sub(r"(?i)^\s*Visit\s+", "", card.attrs.get("aria-label", "")).strip()
        row = {"title": words_of(card.first(cls="podcast-card-title")) or label or _slug(url), "url": url, "slug": _slug(url), "catalog_page_url": page, "episode_count": None, "views_text": None}
        for tag in map(words_of, card.all(cls="tag")):
            if found := re.search(r"(\d+)\s+episodes?\b", tag, re.IGNORECASE):
                row["episode_count"] = int(found[1])
            elif "view" in tag.lower():
                row["views_text"] = tag
        out.append(row)
    return out


def episode_cards(html: str, page: str) -> list[dict]:
    """a.podcast-episode-card[href]: title of aria-label, else as shown (cards without any are left out); duration and publication from the first fitting tags."""
    out = []
    for card in parse(html).all("a", "podcast-episode-card"):
        label = re.sub(r"(?i)^\s*Read\s+", "", card.attrs.get("aria-label", "")).strip()
        title = label or words_of(card.first(cls="podcast-episode-title"))
        if not card.attrs.get("href") or not title:
            continue
        about = card.first(cls="podcast-episode-description")
        tags = [words_of(t) for t in card.all(cls="tag")]
        duration = next((t for t in tags if re.fullmatch(r"\d{1,2}:\d{2}", t)), None)
        published = next((t for t in tags if t.lower().startswith("published")), None)
        out.append({"title": title, "url": urljoin(page, card.attrs["href"]), "list_page_url": page, "description": words_of(about) if about is not None else None, "duration": duration, "published_text": published})
    return out


def _over(to: pa.DataType, read: Callable):
    """An Arrow UDF of ``read`` over pages; null pages are read as empty ones."""

    @arrow(to)
    def run(html: pa.Array) -> pa.Array:
        return pa.array([read(h or "") for h in html.to_pylist()], to)

    return run


def _cards(read: Callable, **fields: pa.DataType):
    """An Arrow UDF of ``read`` over pages and their addresses: a list of structs for each page."""
    to = pa.list_(pa.struct(list(fields.items())))

    @arrow(to)
    def run(html: pa.Array, page: pa.Array) -> pa.Array:
        return pa.array([read(h or "", p or "") for h, p in zip(html.to_pylist(), page.to_pylist())], to)

    return run


_S = pa.string()
visible_lines_udf = _over(pa.list_(_S), visible_lines)
total_pages_udf = _over(pa.int64(), total_pages)
page_title_udf = _over(_S, page_title)
episode_title_udf = _over(_S, episode_title)
podcast_cards_udf = _cards(podcast_cards, title=_S, url=_S, slug=_S, catalog_page_url=_S, episode_count=pa.int64(), views_text=_S)
episode_cards_udf = _cards(episode_cards, title=_S, url=_S, list_page_url=_S, description=_S, duration=_S, published_text=_S)
