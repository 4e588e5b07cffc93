"""Problem 9: mix sources to target shares of the total size, in tokens, with capped repetition.

Method: hierarchical budgeting. Targets are leaves of a tree (domain, language, source); the total is handed down by
weight, and what a leaf cannot take (its tokens times its allowed repetitions) goes to its siblings first and only
then to the branches beside its ancestors. Each leaf then takes its documents in seeded epochs: whole epochs,
and of the last one the prefix, in order of a hash, that fills its budget. The prefix is found by counts of
tokens over hash bins, so no leaf is ever sorted as a whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm import tokens as tokenizer
from quern.llm.common import stored


def source_key(source: Column) -> Column:
    """One spelling of a source's names: case, spaces and ``_`` for ``-`` do not count."""
    return F.regexp_replace(F.regexp_replace(F.lower(source), r"(?U)^\s+|\s+$", ""), r"(?U)[\s_-]+", "-")


def share_out(budget: float, weights: list[float], room: list[float]) -> list[float]:
    """``budget`` by weight, no part above its room; what is left over goes to parts with room, by weight, until none is left or all are full."""
    given, open_ = [0.0] * len(weights), [i for i, w in enumerate(weights) if w > 0 and room[i] > 0]
    while open_ and budget > 1e-9:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if budget * weights[i] / total >= room[i] - given[i]]
        if not full:
            for i in open_:
                given[i] += budget * weights[i] / total
            break
        for i in full:
            budget -= room[i] - given[i]
            given[i] = room[i]
        open_ = [i for i in open_ if i not in full]
    return given


def budgets(leaves: list[dict], total: float | None = None) -> dict[str, float]:
    """Tokens for each leaf (``name``, ``path``, ``weight``, ``room``); ``total`` None: the largest with which every leaf that has room gets its full share."""
    if total is None:
        present = sum(x["weight"] for x in leaves if x["room"] > 0)
        total = min((x["room"] * present / x["weight"] for x in leaves if x["room"] > 0 and x["weight"] > 0), default=0.0)

    def down(some: list[dict], budget: float, depth: int) -> dict[str, float]:
        groups: dict[str, list[dict]] = {}
        for x in some:
            groups.setdefault(x["path"][depth] if depth < len(x["path"]) else x["name"], []).append(x)
        parts = list(groups.values())
        given = share_out(budget, [sum(x["weight"] for x in g) for g in parts], [sum(x["room"] for x in g if x["weight"] > 0) for g in parts])
        if depth >= max(len(x["path"]) for x in some):
            return {g[0]["name"]: b for g, b in zip(parts, given)}
        return {k: v for g, b in zip(parts, given) for k, v in down(g, b, depth + 1).items()}

    return down(leaves, total, 0) if leaves else {}


def plan(docs: DataFrame, targets: DataFrame, total: float | None = None, of_room: float | None = None) -> list[dict]:
    """Leaves with their budgets. ``docs``: (source key, lang, tokens); a source's language is the one of most of its tokens. One row for each target reaches the driver."""
    domain = F.min("domain") if "domain" in targets.columns else F.lit(None).cast("string")
    sizes = docs.groupBy("source", "lang").agg(F.sum("tokens").alias("n")).groupBy("source").agg(F.sum("n").alias("n"), F.max_by("lang", F.struct("n", "lang")).alias("lang"))
    wanted = targets.where("source is not null").groupBy(source_key(F.col("source")).alias("source")).agg(F.sum("target_share").alias("weight"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("repeats"), domain.alias("domain"))
    rows = wanted.join(sizes, "source", "left").orderBy("source").collect()
    leaves = [
        {"name": r.source, "path": [r.domain or "", r.lang or "und"], "weight": max(r.weight or 0.0, 0.0), "size": r.n or 0, "repeats": max(r.repeats, 0), "room": float((r.n or 0) * max(r.repeats, 0))} for r in rows
    ]
    if of_room is not None:
        total = of_room * sum(x["room"] for x in leaves if x["weight"] > 0)
    given = budgets(leaves, total)
    return [leaf | {"budget": given.get(leaf["name"], 0.0)} for leaf in leaves]


def counted(docs: DataFrame, targets: DataFrame, tokenizer_file: str = tokenizer.TOKENIZER) -> DataFrame:
    """(doc_id, source key, lang, tokens) of the documents of target sources that have any tokens, stored."""
    wanted = targets.select(source_key(F.col("source")).alias("source")).where("source is not null").distinct()
    own = docs.select("doc_id", "text", source_key(F.col("source")).alias("source"), F.lower(F.trim("lang")).alias("lang")).join(wanted, "source", "left_semi")
    sized = tokenizer.encode(own, "doc_id", "text", tokenizer_file).select("doc_id", F.size("ids").alias("tokens")).where("tokens > 0")
    return stored(own.select("doc_id", "source", F.coalesce("lang", F.lit("und")).alias("lang")).join(sized, "doc_id"), "mix-sizes")


def mix(docs: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 1, tokenizer_file: str = tokenizer.TOKENIZER, of_room: float | None = None) -> DataFrame:
    """(doc_id, source, epoch, tokens): a row for each use of a document, epochs from 0, sources in one spelling.

    ``docs``: doc_id (unique), text, lang, source; ``targets``: source, target_share, max_repeats (null: once; 0: never). Documents of
    other and of null sources and those without tokens are not used. A target whose source has no documents leaves its
    share to its siblings: the sources of its domain (a column ``domain`` of ``targets``, if there is one) and language first. Shares are met
    to within half a document of each source. The size is ``total`` tokens, or the part ``of_room`` of all that the sources
    may give with their repetitions, or else the largest with which every source that has documents gets its full share.
    """
    sized = counted(docs, targets, tokenizer_file)
    leaves = [x for x in plan(sized, targets, total, of_room) if x["budget"] > 0]
    schema = "source string, whole int, rest double"
    rows = []
    for x in leaves:
        whole = min(math.floor(x["budget"] / x["size"] + 1e-9), x["repeats"])
        rows.append((x["name"], whole, max(x["budget"] - whole * x["size"], 0.0) if whole < x["repeats"] else 0.0))
    takes = docs.sparkSession.createDataFrame(rows, schema)  # one row for each target
    keyed = sized.join(F.broadcast(takes), "source").withColumn("h", F.xxhash64(F.lit(seed), "whole", "doc_id")).withColumn("bin", F.shiftrightunsigned("h", 48))
    bins = keyed.groupBy("source", "bin").agg(F.sum("tokens").alias("n"))
    upto = bins.select("source", "bin", (F.sum("n").over(Window.partitionBy("source").orderBy("bin")) - F.col("n")).alias("before"), "n")
    placed = keyed.join(upto, ["source", "bin"])
    below = placed.where(F.col("before") + F.col("n") <= F.col("rest")).select("doc_id", "source", F.col("whole").alias("epoch"), "tokens")
    # Only the bin in which a source's budget ends is put in order.
    edge = placed.where((F.col("before") + F.col("n") > F.col("rest")) & (F.col("before") < F.col("rest")))
    cum = F.sum("tokens").over(Window.partitionBy("source", "bin").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    last = edge.withColumn("at", F.col("before") + cum - F.col("tokens") / 2).where(F.col("at") <= F.col("rest")).select("doc_id", "source", F.col("whole").alias("epoch"), "tokens")
    full = keyed.where("whole > 0").select("doc_id", "source", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("epoch"), "tokens")
    return full.unionByName(below).unionByName(last)


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, share, uses, tokens, total_tokens): what ``mix`` really reached, a row for each target."""
    got = mixed.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("uses"))
    wanted = targets.where("source is not null").groupBy(source_key(F.col("source")).alias("source")).agg(F.sum("target_share").alias("target_share"))
    whole = got.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total_tokens"))
    both = wanted.join(got, "source", "left").join(F.broadcast(whole))  # a single row
    return both.select("source", "target_share", F.when(F.col("total_tokens") > 0, F.coalesce("tokens", F.lit(0)) / F.col("total_tokens")).alias("share"), F.coalesce("uses", F.lit(0)).alias("uses"), F.coalesce("tokens", F.lit(0)).alias("tokens"), "total_tokens")
