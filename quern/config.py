"""Effective settings of all stages, as frozen dataclasses. An explicit 0 given by a caller is ignored in favour of the setting."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from typing import TypeVar

T = TypeVar("T")


@dataclass(frozen=True)
class CleanConfig:
    min_chars: int = 1000
    dedupe: bool = True
    version: str = "clean_v1"


@dataclass(frozen=True)
class ChunkConfig:
    target_chars: int = 2800
    max_chars: int = 3600
    min_chunk_chars: int = 400
    overlap_blocks: int = 1

    def __post_init__(self) -> None:
        if self.target_chars > self.max_chars:
            raise ValueError("target_chars must not exceed max_chars")


@dataclass(frozen=True)
class IndexConfig:
    metric: str = "cosine"
    batch_size: int = 16
    max_length: int = 1024
    skip_existing: bool = True


@dataclass(frozen=True)
class RetrieveConfig:
    raw_top_k_per_query: int = 30
    final_top_k: int = 8
    max_chunks_per_doc: int = 1
    max_chunks_per_podcast: int = 3
    max_chunks_per_title: int = 1
    preview_chars: int = 500
    min_relevance_distance: float = 0.42
    weak_relevance_distance: float = 0.40
    min_sources_required: int = 3


@dataclass(frozen=True)
class RewriteConfig:
    enabled: bool = True
    max_queries: int = 5
    prompt_version: str = "v2_core_query"
    cache_enabled: bool = True


@dataclass(frozen=True)
class GenerateConfig:
    rounds: int = 30
    max_rounds: int = 80
    max_source_chars: int = 18_000
    max_sources: int = 6
    max_chars_per_source: int = 3_000
    appendix_excerpt_chars: int = 1_200


def merged(config: T, given: dict | None = None, **overrides) -> T:
    """``config`` with the settings of a loaded mapping, then with ``overrides``; falsy overrides do not count."""
    known = {f.name for f in fields(config)}
    config = replace(config, **{k: v for k, v in (given or {}).items() if k in known})
    return replace(config, **{k: v for k, v in overrides.items() if v and k in known})


def load_yaml(path: str) -> dict:
    """A mapping from a YAML file; {} where it is missing or empty. Flat ``key: value`` files are read without PyYAML."""
    try:
        with open(path, encoding="utf-8") as f:
            text = f.read()
    except FileNotFoundError:
        return {}
    try:
        import yaml
    except ImportError:
        return _plain_yaml(text)
    return yaml.safe_load(text) or {}


def _plain_yaml(text: str) -> dict:
    """Nested mappings of scalars, by indentation: the subset of YAML that settings files use."""
    root: dict = {}
    stack: list[tuple[int, dict]] = [(-1, root)]
    for line in text.splitlines():
        body = line.split(" #", 1)[0].rstrip()
        if not body.strip() or body.lstrip().startswith("#"):
            continue
        indent = len(body) - len(body.lstrip())
        key, _, value = body.strip().partition(":")
        while stack[-1][0] >= indent:
            stack.pop()
        value = value.strip()
        if not value:
            stack[-1][1][key] = {}
            stack.append((indent, stack[-1][1][key]))
        else:
            stack[-1][1][key] = _scalar(value)
    return root


def _scalar(value: str) -> object:
    if value[:1] in "\"'" and value[-1:] == value[:1]:
        return value[1:-1]
    if value.lower() in ("true", "false"):
        return value.lower() == "true"
    if value.lower() in ("null", "~"):
        return None
    for kind in (int, float):
        try:
            return kind(value)
        except ValueError:
            pass
    return value
