"""Boundaries to the outside: fetching pages, embedding texts, rewriting queries, generating dialogues. Offline stand-ins are for tests and dry runs."""

from __future__ import annotations

import hashlib
import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Fetcher(Protocol):
    def fetch(self, url: str) -> str: ...


class Embedder(Protocol):
    dims: int

    def embed(self, texts: list[str]) -> np.ndarray: ...


class Generator(Protocol):
    def models(self) -> list[str]: ...

    def complete(self, messages: list[dict[str, str]]) -> str: ...


class StoredFetcher:
    """Pages of a folder that ``sinks.keep_pages`` filled, read once on each executor; for runs without the network and for tests."""

    def __init__(self, folder: str):
        import pyarrow.dataset as ds

        table = ds.dataset(folder, format="parquet").to_table(columns=["url", "html"])
        self.pages = dict(zip(table.column("url").to_pylist(), table.column("html").to_pylist()))

    def fetch(self, url: str) -> str:
        return self.pages[url]


class HttpFetcher:
    """GET with retries: ``retries`` times on the statuses that may pass and on connection errors, waiting longer each time; a pause with jitter before each request."""

    STATUSES = frozenset((429, 500, 502, 503, 504))

    def __init__(self, timeout: float = 30, retries: int = 4, backoff: float = 0.8, pause: float = 1.0, jitter: float = 0.5, agent: str = "quern"):
        self.timeout, self.retries, self.backoff, self.pause, self.jitter, self.agent = timeout, retries, backoff, pause, jitter, agent

    def fetch(self, url: str) -> str:
        for attempt in range(self.retries + 1):
            time.sleep(self.pause + random.uniform(0, self.jitter))
            try:
                with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": self.agent}), timeout=self.timeout) as answer:
                    return answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")
            except urllib.error.HTTPError as e:
                if e.code not in self.STATUSES or attempt == self.retries:
                    raise
            except urllib.error.URLError:
                if attempt == self.retries:
                    raise
            time.sleep(self.backoff * 2**attempt)
        raise AssertionError("unreachable")


class TableFetcher:
    """Pages that were fetched before."""

    def __init__(self, pages: dict[str, str]):
        self.pages = pages

    def fetch(self, url: str) -> str:
        return self.pages[url]


class HashEmbedder:
    """Deterministic unit vectors: words and pairs of words hashed to signed dimensions. No model, for tests only."""

    def __init__(self, dims: int = 64):
        self.dims = dims

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dims), np.float32)
        for row, text in zip(out, texts):
            found = text.lower().split()
            for token in found + [" ".join(p) for p in zip(found, found[1:])]:
                h = int.from_bytes(hashlib.blake2b(token.encode(), digest_size=8).digest(), "little")
                row[(h >> 1) % self.dims] += 1 if h & 1 else -1
        size = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(size > 0, size, 1)


class LetterEmbedder:
    """Counts of the letters a to z: vectors that SQL can follow. No model, for tests only."""

    dims = 26

    def embed(self, texts: list[str]) -> np.ndarray:
        low = [t.lower() for t in texts]
        return np.array([[t.count(c) for c in "abcdefghijklmnopqrstuvwxyz"] for t in low], np.float32).reshape(len(texts), 26)


class WordRewriter:
    """Rewrites by rule: words of five letters and more as terms, the first three words as core query, and all words backwards. No model, for tests and dry runs."""

    def models(self) -> list[str]:
        return ["words"]

    def complete(self, messages: list[dict[str, str]]) -> str:
        words = messages[-1]["content"].rpartition("Question: ")[2].split(" ")
        return json.dumps({"canonical_terms": [w for w in words if len(w) >= 5], "core_query": " ".join(words[:3]), "retrieval_queries": [" ".join(words[::-1])]}, ensure_ascii=False)


class EchoFetcher:
    """Answers an address with itself; those that hold ``fails`` fail. For tests."""

    def __init__(self, fails: str = "\0"):
        self.fails = fails

    def fetch(self, url: str) -> str:
        if self.fails in url:
            raise ValueError(f"no page at {url}")
        return url


class EchoGenerator:
    """Answers with the alternating lines of two speakers; for dry runs."""

    def models(self) -> list[str]:
        return ["echo"]

    def complete(self, messages: list[dict[str, str]]) -> str:
        return "A: " + messages[-1]["content"].splitlines()[0] + "\nB: Go on."


class ChatGenerator:
    """A chat model behind an HTTP endpoint of the common form: GET {base}/models, POST {base}/chat/completions."""

    def __init__(self, base_url: str, model: str, temperature: float = 0.65, top_p: float = 0.9, max_tokens: int = 9_000, timeout: float = 1_200, key: str = ""):
        self.base_url, self.model, self.timeout, self.key = base_url.rstrip("/"), model, timeout, key
        self.settings = {"model": model, "temperature": temperature, "top_p": top_p, "max_tokens": max_tokens}

    def _ask(self, path: str, body: dict | None = None) -> dict:
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        request = urllib.request.Request(self.base_url + path, data=None if body is None else json.dumps(body).encode(), headers=headers)
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return json.load(answer)

    def models(self) -> list[str]:
        return [m["id"] for m in self._ask("/models").get("data", [])]

    def complete(self, messages: list[dict[str, str]]) -> str:
        found = self._ask("/chat/completions", self.settings | {"messages": messages})["choices"][0]["message"].get("content") or ""
        if not found.strip():
            raise ValueError("the model gave no text")
        return found


def assert_model(generator: Generator, model: str) -> None:
    if model not in generator.models():
        raise ValueError(f"model {model} is not available: {', '.join(generator.models())}")


def available(asked: DataFrame, name: str, have: DataFrame, have_name: str) -> DataFrame:
    """``asked`` with ``available``: whether the list ``have`` holds the name."""
    held = have.select(F.col(have_name).alias("_have")).where("_have is not null").distinct()
    return asked.join(held, F.col(name) == F.col("_have"), "left").withColumn("available", F.col("_have").isNotNull()).drop("_have")


def embedded(rows: DataFrame, text: str, make: Callable[[], Embedder], column: str = "embedding", batch: int = 16, longest: int = 1024) -> DataFrame:
    """``rows`` with the embeddings of their texts (cut to ``longest`` words), in batches inside Arrow; null and empty texts get the embedding of ''."""
    from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

    schema = StructType([*rows.schema.fields, StructField(column, ArrayType(FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for b in batches:
            texts = [" ".join((t or "").split()[:longest]) for t in b.column(text).to_pylist()]
            vectors = [model.embed(texts[i : i + batch]) for i in range(0, len(texts), batch)]
            flat = np.concatenate(vectors).astype(np.float32) if vectors else np.zeros((0, model.dims), np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * model.dims, pa.int32()), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], [*b.schema.names, column])

    return rows.mapInArrow(run, schema)


def fetched(links: DataFrame, fetch: Callable[[], Fetcher] | DataFrame, url: str = "url") -> DataFrame:
    """``links`` with ``html`` and ``error``: one page's failure is a value in its row and never fails the job.

    ``fetch`` makes a fetcher on the executors, or is a table of pages (url, html), each address once, which is joined.
    """
    if isinstance(fetch, DataFrame):
        pages = fetch.select(F.col("url").alias("_url"), "html")
        return links.join(pages, F.col(url) == F.col("_url"), "left").drop("_url").withColumn("error", F.when(F.col("html").isNull(), F.lit("KeyError: no such page")))
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([*links.schema.fields, StructField("html", StringType()), StructField("error", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = fetch()
        for b in batches:
            html, errors = [], []
            for u in b.column(url).to_pylist():
                try:
                    html.append(source.fetch(u))
                    errors.append(None)
                except Exception as e:  # whatever the page did, the others go on
                    html.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(html, pa.string()), pa.array(errors, pa.string())], [*b.schema.names, "html", "error"])

    return links.mapInArrow(run, schema)


def fetch_summary(pages: DataFrame, links: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """(written, skipped, failed) of fetched pages, for each ``key`` if there is one. ``links``: all links there were; those that were not fetched are skipped."""
    got = pages.groupBy(*([key] if key else [])).agg(F.count_if(F.col("error").isNull()).alias("written"), F.count_if(F.col("error").isNotNull()).alias("failed"))
    if links is None:
        return got
    every = links.groupBy(*([key] if key else [])).agg(F.count("*").alias("_links"))
    both = every.join(got, key, "left") if key else every.crossJoin(got)  # two single rows
    written, failed = F.coalesce("written", F.lit(0)), F.coalesce("failed", F.lit(0))
    return both.select(*([key] if key else []), written.alias("written"), (F.col("_links") - written - failed).alias("skipped"), failed.alias("failed"))
