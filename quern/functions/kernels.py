"""Sequential kernels that relational operators cannot express, as plain functions and Arrow UDFs."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa

from quern.functions.layout import arrow

_BLOCK = pa.list_(pa.struct([("timestamp", pa.string()), ("text", pa.string())]))
_PACKED = pa.list_(pa.struct([("start_timestamp", pa.string()), ("end_timestamp", pa.string()), ("char_count", pa.int64()), ("block_count", pa.int64()), ("text", pa.string())]))
_SENTENCE = re.compile(r"(?<=[.!?。！？])\s+")
_TIMED = re.compile(r"\[?(\d{1,2}:\d{2}(?::\d{2})?)\]?\s*(.*)")
_NOON = re.compile(r"\b(?:am|pm)\b")
_PARAGRAPH = re.compile(r"\n\s*\n+")


def time_blocks(text: str) -> tuple[list[dict], bool]:
    """(blocks, timestamp-aware) of a text, in one pass over its lines.

    With two or more timestamp lines a block is the lines from one of them to the next, and what stands before the first has no
    time; a time without any words behind it gives no block. Else each paragraph is a block. A line whose rest speaks of am or pm is no timestamp line.
    """
    blocks: list[dict] = []
    held: list[str] = []
    stamp, times = None, 0

    def close() -> None:
        if held:
            blocks.append({"timestamp": stamp, "text": "\n".join(held).strip()})

    for line in text.splitlines():
        line = line.strip()
        found = _TIMED.match(line) if line[:1] == "[" or line[:1].isdigit() else None
        if found and not _NOON.search(found[2].lower()):
            close()
            rest = found[2].strip()
            held, stamp, times = [rest] if rest else [], found[1], times + 1
        elif line or held:
            held.append(line)
    close()
    if times >= 2:
        return blocks, True
    return [{"timestamp": None, "text": p} for p in (p.strip() for p in _PARAGRAPH.split(text)) if p], False


def split_long(text: str, most: int) -> list[str]:
    """Pieces of at most ``most`` characters: whole sentences packed greedily, longer sentences cut.

    A piece's length is reckoned as its sentences with a blank each, except that a piece begun behind a full one does not
    reckon the blank of its first sentence; so a first piece is closed one character sooner than a later one.
    """
    text = text.strip()
    if len(text) <= most:
        return [text] if text else []
    parts: list[str] = []
    held: list[str] = []
    size = 0

    def close() -> None:
        nonlocal held, size
        if held:
            parts.append(" ".join(held).strip())
        held, size = [], 0

    for sentence in (s.strip() for s in _SENTENCE.split(text)):
        if not sentence:
            continue
        if len(sentence) > most:
            close()
            parts += [sentence[i : i + most].strip() for i in range(0, len(sentence), most)]
        elif held and size + len(sentence) + 1 > most:
            close()
            held, size = [sentence], len(sentence)
        else:
            held.append(sentence)
            size += len(sentence) + 1
    close()
    return [p for p in parts if p]


def pack_blocks(blocks: list[dict], target: int, most: int, least: int, overlap: int) -> list[dict]:
    """Chunks of consecutive blocks: up to ``target`` characters, never beyond ``most``, the next chunk beginning ``overlap`` blocks earlier; small ones merged or dropped.

    A chunk's times are those of its first and its last block, null where these have none.
    """
    chunks, start = [], 0
    sizes = [len(b["text"]) for b in blocks]
    while start < len(blocks):
        end, size = start, 0
        while end < len(blocks) and (end == start or size + sizes[end] <= most):
            size += sizes[end] + 2
            end += 1
            if size >= target:
                break
        taken = blocks[start:end]
        text = "\n\n".join(b["text"] for b in taken).strip()
        chunks.append({"start_timestamp": taken[0]["timestamp"], "end_timestamp": taken[-1]["timestamp"], "char_count": len(text), "block_count": len(taken), "text": text})
        if end >= len(blocks):
            break
        start = max(start + 1, end - overlap)

    backward: list[dict] = []
    for chunk in chunks:
        if backward and chunk["char_count"] < least and backward[-1]["char_count"] + chunk["char_count"] <= most:
            backward[-1] = _joined(backward[-1], chunk, backward[-1]["start_timestamp"], chunk["end_timestamp"] or backward[-1]["end_timestamp"])
        else:
            backward.append(chunk)
    forward: list[dict] = []
    i = 0
    while i < len(backward):
        chunk = backward[i]
        i += 1
        if chunk["char_count"] >= least:
            forward.append(chunk)
            continue
        if i < len(backward):
            both = _joined(chunk, backward[i], chunk["start_timestamp"] or backward[i]["start_timestamp"], backward[i]["end_timestamp"])
            if both["char_count"] <= most:
                forward.append(both)
                i += 1
                continue
        if len(backward) == 1:
            forward.append(chunk)
    return forward


def _joined(a: dict, b: dict, start: str | None, end: str | None) -> dict:
    text = (a["text"] + "\n\n" + b["text"]).strip()
    return {"start_timestamp": start, "end_timestamp": end, "char_count": len(text), "block_count": a["block_count"] + b["block_count"], "text": text}


def split_blocks(blocks: list[dict], most: int) -> list[dict]:
    """Each block's text split to at most ``most`` characters, the pieces keeping its time."""
    return [{"timestamp": b["timestamp"], "text": part} for b in blocks for part in split_long(b["text"] or "", most)]


@arrow(pa.struct([("aware", pa.bool_()), ("blocks", _BLOCK)]))
def blocks_udf(texts: pa.Array) -> pa.Array:
    found = [time_blocks(t or "") for t in texts.to_pylist()]
    return pa.StructArray.from_arrays([pa.array([aware for _, aware in found], pa.bool_()), pa.array([blocks for blocks, _ in found], _BLOCK)], ["aware", "blocks"])


def chunks_udf(target: int, most: int, least: int, overlap: int) -> Callable:
    """Column function text -> struct(aware, blocks, chunks): time blocks found, split and packed in one pass; ``blocks`` is their number after splitting."""

    @arrow(pa.struct([("aware", pa.bool_()), ("blocks", pa.int64()), ("chunks", _PACKED)]))
    def run(texts: pa.Array) -> pa.Array:
        aware, counts, chunks = [], [], []
        for text in texts.to_pylist():
            raw, timed = time_blocks(text or "")
            blocks = split_blocks(raw, most)
            aware.append(timed)
            counts.append(len(blocks))
            chunks.append(pack_blocks(blocks, target, most, least, overlap))
        return pa.StructArray.from_arrays([pa.array(aware, pa.bool_()), pa.array(counts, pa.int64()), pa.array(chunks, _PACKED)], ["aware", "blocks", "chunks"])

    return run


def greedy_pick(rows: list[dict], k: int, per_doc: int, per_podcast: int, per_title: int) -> list[dict]:
    """Up to k rows, in the given order, under three caps; a row that one cap rejects uses up none of the others. Empty keys have no cap."""
    picked, ids, hashes, used = [], set(), set(), Counter()
    for row in rows:
        if len(picked) >= k:
            break
        caps = [(("doc", row["doc_id"]), per_doc), (("podcast", row["podcast_slug"]), per_podcast), (("title", row["title_key"]), per_title)]
        if row["chunk_id"] in ids or (row["content_hash"] and row["content_hash"] in hashes) or any(key[1] and used[key] >= most for key, most in caps):
            continue
        picked.append(row)
        ids.add(row["chunk_id"])
        if row["content_hash"]:
            hashes.add(row["content_hash"])
        used.update(key for key, _ in caps if key[1])
    return picked


def strict_object(text: str | None) -> str | None:
    """The JSON object in a model's answer: the whole answer if it parses, else the span from the first { to the last }; None where neither is an object."""
    for candidate in (text or "", (re.search(r"\{.*\}", text or "", re.DOTALL) or [""])[0]):
        try:
            found = json.loads(candidate)
        except ValueError:
            continue
        return json.dumps(found, ensure_ascii=False) if isinstance(found, dict) else None
    return None


@arrow(pa.string())
def json_object(text: pa.Array) -> pa.Array:
    return pa.array([strict_object(t) for t in text.to_pylist()], pa.string())
