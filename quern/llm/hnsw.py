"""Problem 7: the most similar vectors of every vector, by cosine, with little loss.

Method: a hierarchical navigable small-world graph per shard, stored as flat neighbour arrays, and the shards'
results merged. Shards are coarse clusters (centroids fitted on a sample of ``sample`` vectors, or of four for each
cluster where those are more; every vector is indexed); a cluster of more than twice ``shard_rows`` vectors is split at random
into shards. Every vector asks the shards of its nearest clusters: all of them up to PROBES, beyond it 1.5 times the
root of their number, so recall does not fall as clusters get more (0.97 to 0.99 of the true neighbours lie there with 10 to
1,600 clusters of the test vectors) and the work grows with the number of vectors to the power 1.5. Clusters are found by two levels
of centroids.

Nodes are numbered from the top layer down, so a layer is a prefix of the numbers and its neighbour
lists one rectangular array. Building and searching work on many vectors at once (NumPy), inside Arrow kernels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import new_path, opened, qualified, stored

LINKS, BUILD, SEARCH, SHARD_ROWS, PROBES, SAMPLE = 16, 64, 128, 10_000, 4, 20_000


def beam(x: np.ndarray, links: np.ndarray, size: int, q: np.ndarray, entry: np.ndarray, width: int, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of a layer for many queries at once: ids and similarities of the ``width`` best nodes met, best first (-1: none)."""
    n = len(q)
    seen = np.zeros(n * size, bool)
    rows = np.arange(n)[:, None]
    ids = np.full((n, width), -1, np.int32)
    sims = np.full((n, width), -np.inf, np.float32)
    k = min(entry.shape[1], width)
    ids[:, :k] = entry[:, :k]
    sims[:, :k] = np.where(entry[:, :k] >= 0, np.einsum("bkd,bd->bk", x[entry[:, :k]], q), -np.inf)
    seen[rows * size + np.maximum(entry[:, :k], 0)] = True
    done = ids < 0
    live, place = np.arange(n), np.zeros(n, np.int64)
    while len(live):
        held, kept, gone = ids[live], sims[live], done[live]
        key = np.where(gone, np.inf, -kept)
        best = np.argpartition(key, step - 1, axis=1)[:, :step] if step < width else np.argsort(key, axis=1)
        best = best + np.arange(len(live))[:, None] * width
        best = best[~gone.take(best)]
        gone.ravel()[best] = True
        near = links.take(held.take(best), axis=0)
        at = ((live * size).take(best // width)[:, None] + near)[near >= 0]
        at = np.sort(at[~seen.take(at)])
        at = at[np.concatenate([np.ones(min(len(at), 1), bool), at[1:] != at[:-1]])]
        seen[at] = True
        of = at // size
        at -= of * size
        sim = np.einsum("kd,kd->k", x.take(at, axis=0), q.take(of, axis=0))
        # Only what is better than the worst that is held can come in.
        place[live] = np.arange(len(live))
        row = place.take(of)
        better = sim > kept.min(1).take(row)
        row, at, sim = row[better], at[better], sim[better]
        more = np.bincount(row, minlength=len(live))
        wide = int(more.max())
        if wide:
            col = width + np.arange(len(row)) - (np.cumsum(more) - more)[row]
            held = np.concatenate([held, np.full((len(live), wide), -1, np.int32)], 1)
            kept = np.concatenate([kept, np.full((len(live), wide), -np.inf, np.float32)], 1)
            gone = np.concatenate([gone, np.ones((len(live), wide), bool)], 1)
            held[row, col], kept[row, col], gone[row, col] = at, sim, False
            top = np.argpartition(kept, wide, axis=1)[:, wide:] + np.arange(len(live))[:, None] * (width + wide)
            held, kept, gone = held.take(top), kept.take(top), gone.take(top)
        ids[live], sims[live], done[live] = held, kept, gone | np.isneginf(kept)
        live = live[~done[live].all(1)]
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = ids[rows, order], sims[rows, order]
    return np.where(np.isneginf(sims), -1, ids), sims


def spread(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Neighbour lists out of candidates (best first): a candidate nearer to one already chosen than to the node waits; the nearest that wait fill up."""
    n, wide = ids.shape
    vectors = x.take(np.maximum(ids, 0), axis=0)
    among = vectors @ vectors.transpose(0, 2, 1)
    chosen, count, worst = np.zeros((n, wide), bool), np.zeros(n, int), np.full((n, wide), -np.inf, np.float32)
    valid = ids >= 0
    for e in range(wide):
        ok = valid[:, e] & (count < most) & (worst[:, e] < sims[:, e])
        chosen[ok, e] = True
        count[ok] += 1
        worst[ok] = np.maximum(worst[ok], among[ok, e])
    rank = np.where(chosen, 0, np.where(valid, 1, 2)) * wide + np.arange(wide)
    order = np.argsort(rank, axis=1)[:, :most]
    out = np.full((n, most), -1, np.int32)
    picked = ids[np.arange(n)[:, None], order]
    out[:, : picked.shape[1]] = picked
    return out


def _best(x: np.ndarray, ids: np.ndarray, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` most similar of the nodes ``ids`` for each query, by comparing all (used within one batch of insertions)."""
    sims = q @ x[ids].T
    k = min(width, len(ids))
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return ids[top].astype(np.int32), np.take_along_axis(sims, top, 1).astype(np.float32)


def _layer(x: np.ndarray, size: int, most: int, upper: list[np.ndarray], first: int = 256, batch: int = 256) -> np.ndarray:
    """The neighbour array of the layer of nodes 0..size-1, by inserting batches of nodes."""
    links = np.full((size, most), -1, np.int32)
    at = 0
    while at < size:
        end = min(size, max(first, at + min(at, 2_048)))
        new = np.arange(at, end)
        found = []
        for s in range(0, len(new), batch):
            some = new[s : s + batch]
            ids, sims = _best(x, new, x[some], min(BUILD, len(new)))
            if at:
                old_ids, old_sims = beam(x, links, at, x[some], _entries(x, upper, x[some], at), BUILD)
                ids, sims = np.concatenate([ids, old_ids], 1), np.concatenate([sims, old_sims], 1)
            sims = np.where(ids == some[:, None], -np.inf, sims)
            order = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD]
            ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
            ids = np.where(np.isneginf(sims), -1, ids)
            found.append(spread(x, ids, sims, max(most // 2, 1)))
        links[at:end, : found[0].shape[1]] = np.concatenate(found)
        _return_links(x, links, new, most, batch)
        at = end
    return links


def _return_links(x: np.ndarray, links: np.ndarray, new: np.ndarray, most: int, batch: int) -> None:
    """Link the neighbours of new nodes back to them; a list that grows beyond ``most`` is spread again."""
    source = np.repeat(new, links.shape[1])
    target = links[new].ravel()
    source, target = source[target >= 0], target[target >= 0]
    touched = np.unique(target)
    for s in range(0, len(touched), batch):
        some = touched[s : s + batch]
        mine = np.flatnonzero((target >= some[0]) & (target <= some[-1]))
        row = np.searchsorted(some, target[mine])
        sim = np.einsum("kd,kd->k", x[source[mine]], x[target[mine]])
        order = np.lexsort((-sim, row))
        row, incoming = row[order], source[mine][order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        fits = place < 2 * most
        extra = np.full((len(some), min(2 * most, int(place.max()) + 1)), -1, np.int32)
        extra[row[fits], place[fits]] = incoming[fits]
        ids = np.sort(np.concatenate([links[some], extra], 1), axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        sims = np.where(ids >= 0, np.einsum("bkd,bd->bk", x[np.maximum(ids, 0)], x[some]), -np.inf).astype(np.float32)
        order = np.argsort(-sims, axis=1, kind="stable")
        links[some] = spread(x, np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1), most)


def _entries(x: np.ndarray, upper: list[np.ndarray], q: np.ndarray, below: int, width: int = 8) -> np.ndarray:
    """Entry nodes of a layer: the best found on the way down through the layers above it (node 0 is the top's)."""
    entry = np.zeros((len(q), 1), np.int32)
    for links in upper:
        entry, _ = beam(x, links, len(links), q, entry, min(width, len(links)), step=2)
    entry = np.where(entry < below, entry, -1)
    return np.where((entry >= 0).any(1, keepdims=True), entry, 0)


def build(x: np.ndarray, links: int = LINKS) -> list[np.ndarray]:
    """The neighbour arrays of all layers, top first. ``x``: unit vectors, in random order."""
    sizes = [len(x)]
    while sizes[-1] > 4 * links:
        sizes.append(math.ceil(sizes[-1] / links))
    layers: list[np.ndarray] = []
    for size in sizes[::-1]:
        layers.append(_layer(x, size, 2 * links if size == len(x) else links, layers))
    return layers


def search(x: np.ndarray, layers: list[np.ndarray], q: np.ndarray, k: int, width: int = SEARCH, batch: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """Ids and similarities of the k best nodes found for each query."""
    out = [beam(x, layers[-1], len(x), q[s : s + batch], _entries(x, layers[:-1], q[s : s + batch], len(x)), min(max(width, k), len(x))) for s in range(0, len(q), batch)]
    ids, sims = (np.concatenate(y) for y in zip(*out))
    return ids[:, :k], sims[:, :k]


def centroids(sample: np.ndarray, count: int, rounds: int = 10) -> np.ndarray:
    """Unit centroids of spherical k-means; the sample stands in random order."""
    c = sample[:count].copy()
    for _ in range(rounds if count > 1 else 0):
        own = np.concatenate([(sample[s : s + 4_096] @ c.T).argmax(1) for s in range(0, len(sample), 4_096)])
        total = np.zeros_like(c)
        np.add.at(total, own, sample)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 0, total / np.where(size > 0, size, 1), c)
    return c


def _unit(batch: pa.RecordBatch, column: str) -> np.ndarray:
    x = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Router:
    """Two levels of centroids: the clusters nearest to a vector are looked for below the nearest upper ones."""

    def __init__(self, sample: np.ndarray, count: int):
        upper = math.ceil(math.sqrt(count)) if count > 1 else 1
        self.upper = centroids(sample, min(upper, len(sample)))
        own = np.concatenate([(sample[s : s + 4_096] @ self.upper.T).argmax(1) for s in range(0, len(sample), 4_096)])
        lower = []
        for u in range(len(self.upper)):
            some = sample[own == u]
            lower.append(centroids(some, min(len(some), max(1, round(count * len(some) / len(sample))))) if len(some) else self.upper[u : u + 1])
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in lower])])
        self.lower = np.concatenate(lower)

    def __len__(self) -> int:
        return len(self.lower)

    def nearest(self, x: np.ndarray, probes: int) -> np.ndarray:
        """The ``probes`` nearest clusters of each unit vector, nearest first."""
        wide, probes = min(len(self.upper), math.ceil(3 * len(self) ** 0.25)), min(probes, len(self))
        out = []
        step = max(64, 2**24 // len(self))
        for some in (x[s : s + step] for s in range(0, len(x), step)):
            above = some @ self.upper.T
            asked = np.argpartition(-above, wide - 1, axis=1)[:, :wide] if wide < len(self.upper) else np.tile(np.arange(wide), (len(some), 1))
            sims = np.full((len(some), len(self)), -np.inf, np.float32)
            for u in np.unique(asked).tolist():
                rows = np.flatnonzero((asked == u).any(1))
                sims[rows, self.first[u] : self.first[u + 1]] = some[rows] @ self.lower[self.first[u] : self.first[u + 1]].T
            top = np.argpartition(-sims, probes - 1, axis=1)[:, :probes]
            order = np.argsort(-np.take_along_axis(sims, top, 1), axis=1, kind="stable")
            out.append(np.take_along_axis(top, order, 1))
        return np.concatenate(out)


def _route(router: Router, parts: np.ndarray, probes: int):
    """Arrow kernel (id, embedding) -> + home (its shard) and asks (the shards of its nearest clusters). ``parts``: shards of each cluster."""
    first = np.concatenate([[0], np.cumsum(parts)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = router.nearest(_unit(batch, "embedding"), probes)
            home = [int(first[k] + h % parts[k]) for k, h in zip(near[:, 0].tolist(), batch.column("h").to_pylist())]
            asks = [[s for k in row for s in range(first[k], first[k + 1])] for row in near.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("embedding"), batch.column("h"), pa.array(home, pa.int32()), pa.array(asks, pa.list_(pa.int32()))], ["id", "embedding", "h", "home", "asks"])

    return run


_INDEX = "shard int, ids array<string>, vectors binary, layers array<binary>, widths array<int>"


def _indexer(links: int):
    """Arrow kernel over (shard, id, embedding) sorted by (shard, h): a row for each shard, with its graph as flat arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, raw = None, [], []

        def done() -> pa.RecordBatch:
            x = np.concatenate(raw)
            unit = (x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)).astype(np.float32)
            layers = build(unit, links)
            row = {"shard": shard, "ids": ids, "vectors": x.tobytes(), "layers": [y.tobytes() for y in layers], "widths": [y.shape[1] for y in layers]}
            kind = pa.schema([("shard", pa.int32()), ("ids", pa.list_(pa.string())), ("vectors", pa.binary()), ("layers", pa.list_(pa.binary())), ("widths", pa.list_(pa.int32()))])
            return pa.RecordBatch.from_pylist([row], kind)

        for batch in batches:
            of = batch.column("shard").to_numpy()
            for k in np.unique(of).tolist():
                if k != shard:
                    if shard is not None:
                        yield done()
                    shard, ids, raw = k, [], []
                own = batch.filter(pa.array(of == k))
                ids += own.column("id").to_pylist()
                raw.append(own.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(own.num_rows, -1))
        if shard is not None:
            yield done()

    return run


def _load(path: str, shard: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    fs, root = opened(f"{path}/shard={shard}")
    files = [f.path for f in fs.get_file_info(pafs.FileSelector(root)) if f.path.endswith(".parquet")]
    row = pq.read_table(files[0], filesystem=fs, partitioning=None).slice(0, 1).to_pylist()[0]
    ids = np.array(row["ids"], dtype=object)
    x = np.frombuffer(row["vectors"], np.float32).reshape(len(ids), -1).astype(np.float64)
    return ids, x / np.linalg.norm(x, axis=1, keepdims=True), [np.frombuffer(y, np.int32).reshape(-1, w) for y, w in zip(row["layers"], row["widths"])]


def _searcher(path: str, k: int, width: int):
    """Arrow kernel over (shard, id, embedding) sorted by shard -> id, found: the shard's k most similar other vectors, with exact cosines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, loaded = None, None
        for batch in batches:
            of = batch.column("shard").to_numpy()
            for s in np.unique(of).tolist():
                if s != shard:
                    shard, loaded = s, _load(path, s)
                    by_id = np.argsort(loaded[0])
                    rank = np.empty(len(by_id), np.int64)
                    rank[by_id] = np.arange(len(by_id))
                    names = pa.array(loaded[0].tolist(), pa.string())
                ids, x, layers = loaded
                own = batch.filter(pa.array(of == s))
                q = _unit(own, "embedding")
                at_home = own.column("at_home").to_numpy(zero_copy_only=False)
                found = np.full((len(q), k + 4), -1, np.int64)
                for here, wide in ((at_home, width), (~at_home, max(k + 4, width // 2))):  # most neighbours are in a vector's own shard
                    if here.any():
                        near, _ = search(x.astype(np.float32), layers, q[here].astype(np.float32), k + 4, wide)
                        found[here, : near.shape[1]] = near
                exact = np.where(found >= 0, np.einsum("bkd,bd->bk", x[np.maximum(found, 0)], q), -np.inf)
                me = np.searchsorted(ids, np.array(own.column("id").to_pylist(), dtype=object), sorter=by_id)
                itself = by_id[np.minimum(me, len(ids) - 1)][:, None] == found
                itself &= (ids[by_id[np.minimum(me, len(ids) - 1)]] == own.column("id").to_pylist())[:, None]
                exact[itself] = -np.inf
                # The most similar first, ties by id.
                order = np.lexsort((rank[np.maximum(found, 0)], -exact), axis=1)[:, :k]
                found, exact = np.take_along_axis(found, order, 1), np.take_along_axis(exact, order, 1)
                good = np.isfinite(exact)
                rows = pa.StructArray.from_arrays([pa.array(exact[good]), names.take(pa.array(found[good]))], ["similarity", "other"])
                out = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(good.sum(1))]), pa.int32()), rows)
                yield pa.RecordBatch.from_arrays([own.column("id"), out], ["id", "found"])

    return run


def valid(vectors: DataFrame, ident: str, embedding: str, dims: int) -> DataFrame:
    """(id, embedding): each id once (of differing rows the smallest vector), without null, short, long, zero and non-finite vectors."""
    e = F.col(embedding)
    ok = (F.size(e) == dims) & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0)
    return vectors.where(F.col(ident).isNotNull() & e.isNotNull() & ok).groupBy(F.col(ident).alias("id")).agg(F.min(e).alias("embedding"))


def probes_of(clusters: int) -> int:
    return max(PROBES, math.ceil(1.5 * math.sqrt(clusters)))


def neighbours(vectors: DataFrame, ident: str, embedding: str, dims: int, k: int = 5, shard_rows: int = SHARD_ROWS, probes: int | None = None, width: int = SEARCH, sample: int = SAMPLE) -> DataFrame:
    """(id, other, similarity, rank): the ``k`` most cosine-similar other vectors found for each valid vector, best first, ties by id.

    ``ident``: a string. Vectors that are null, all zero, not of ``dims`` values or not finite take no part; each id counts once. Equal vectors
    are neighbours like any others. Fewer rows come out where there are fewer vectors; none of an empty table. ``probes``: clusters each vector
    asks (by default as ``probes_of``); with the number of clusters no shard is left out.
    """
    spark = vectors.sparkSession
    rows = stored(valid(vectors, ident, embedding, dims).withColumn("h", F.abs(F.xxhash64("id") % 1_000_000_007)), "vectors")
    total = rows.count()
    clusters = max(1, math.ceil(total / shard_rows))
    taken = max(sample, 4 * clusters) if clusters > 1 else 1
    few = rows.where(F.col("h") < 1_000_000_007 * 1.5 * taken / max(total, 1)) if clusters > 1 else rows  # the smallest hashes, little more is sent
    some = np.array([r.embedding for r in few.orderBy("h", "id").limit(taken).collect()], np.float64).reshape(-1, dims)
    router = Router(some / np.linalg.norm(some, axis=1, keepdims=True) if len(some) else np.eye(1, dims), clusters)
    probes = probes_of(len(router)) if probes is None else probes
    kernel = "id string, embedding array<float>, h bigint, home int, asks array<int>"
    parts = np.ones(len(router), np.int64)
    if clusters > 1:
        sizes = rows.mapInArrow(_route(router, parts, 1), kernel).groupBy("home").agg(F.count("*").alias("n")).collect()  # one row for each cluster
        for r in sizes:
            parts[r.home] = math.ceil(r.n / (2 * shard_rows))
    routed = stored(rows.mapInArrow(_route(router, parts, probes), kernel), "routed")
    path = qualified(spark, new_path(spark, "graphs"))
    home = routed.select(F.col("home").alias("shard"), "id", "embedding", "h").repartition("shard").sortWithinPartitions("shard", "h", "id")
    home.mapInArrow(_indexer(LINKS), _INDEX).write.partitionBy("shard").parquet(path)
    shards = int(parts.sum())
    asked = routed.select(F.explode("asks").alias("shard"), "id", "embedding", "h", "home").withColumn("at_home", F.col("shard") == F.col("home"))
    # Several tasks may search one shard; each reads the shard's arrays from the shared folder.
    spread_out = asked.withColumn("block", F.col("h") % max(1, math.ceil(total * min(probes, shards) / shards / 4_096))).repartition("shard", "block").sortWithinPartitions("shard")
    found = spread_out.select("shard", "id", "embedding", "at_home").mapInArrow(_searcher(path, k, width), "id string, found array<struct<similarity:double,other:string>>")
    merged = found.groupBy("id").agg(F.array_sort(F.flatten(F.collect_list("found")), lambda a, b: F.when(a["similarity"] > b["similarity"], -1).when(a["similarity"] < b["similarity"], 1).when(a["other"] < b["other"], -1).when(a["other"] > b["other"], 1).otherwise(0)).alias("f"))
    best = merged.select("id", F.posexplode(F.slice("f", 1, k)).alias("at", "n"))
    return best.select(F.col("id").alias(ident), F.col("n.other").alias("other"), F.col("n.similarity").alias("similarity"), (F.col("at") + 1).alias("rank"))


def pairs(found: DataFrame, ident: str) -> DataFrame:
    """(a, b; a < b): the distinct unordered pairs of ``neighbours``."""
    return found.select(F.least(ident, "other").alias("a"), F.greatest(ident, "other").alias("b")).distinct()
