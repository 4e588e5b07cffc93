"""Problem 4: near-duplicate texts, all pairs above a similarity, without comparing all with all.

Texts with equal shingle sets form a class; only the smallest id of each class is compared. A class has a
signature (a bitmap of its shingles, and their number) and top nodes: the shingles that come first in one order of all shingles, rare
before frequent. A set of n shingles that is alike to another shares ceil(similarity * n) or more of them with it, so two alike sets meet below
ASKED shingles (or all they share) among the first n - ceil(similarity * n) + ASKED of each. That holds for any order: the order is
taken from a part of the texts, and decides how much is compared, never what is found.

Method: signature trees. The first shingles are the top nodes of one forest. Below one that few texts hold stands a single leaf, whose
pairs are tried by sizes and by the places of the shingle in both orders: what comes before it is not shared, or has been counted. Pairs
that meet often enough are candidates. Below one of many texts stands a tree whose nodes hold the OR of
the bitmaps below and the range of sizes; a dual traversal descends only into pairs of nodes whose greatest possible
overlap can still reach the similarity (a tree of up to LEAF texts is a single leaf). What is left is verified exactly on the
shingle sets, and classes are expanded to their members.

A tree of many texts has further top nodes, ranges of sizes and blocks of at most CELL texts, of which only pairs that sizes allow
are traversed, each in a task of its own. No text and no shingle is left out, however many texts hold it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import new_path, opened, qualified, stored
from quern.llm.grams import R, as_int64, mix, ngrams, offsets, word_hashes

FREQUENT, CELL, LEAF, SLICE = 200, 4_000, 16, 2_000
#: First shingles, and pairs that meet below them, that a task is given in the mean; the share of first shingles (one of so many) that the numbers of both are estimated from.
TOPS, MEETINGS, COUNT_EACH = 500_000, 2_000_000, 64
#: Shared first shingles that make a candidate (fewer where two sets need share fewer).
ASKED = 4
#: Most rows of ids that are broadcast.
BROADCAST = 1_000_000
#: The order of shingles: slots that their hashes are counted in, bits of a count, and every which text is counted.
SLOTS, COUNTED, EACH = 1 << 22, 16, 8
#: Most bits of the bitmaps that leaves are compared by (longer ones are folded).
DENSE = 2_048


def per_text(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text in ascending order, and their offsets."""
    h = h.copy()
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[off[:-1][np.diff(off) > 0]] = True
    return h[new], np.concatenate([[0], np.cumsum(new)])[off]


def slices(batch: pa.RecordBatch, rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def lists(values: np.ndarray, off: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), as_int64(values))


def shingle_sets(shingle: int) -> Callable:
    """Arrow kernel (id, words) -> (id, sets): the distinct shingle fingerprints of each text, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            values, off = per_text(*ngrams(*hashed_words(batch.column(1)), shingle))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(values, off)], ["id", "shingles"])

    return run


def widths(sizes: np.ndarray) -> np.ndarray:
    """Bits of the bitmaps of sets of these sizes: two or more for each shingle, a power of two, so that wider ones can be folded."""
    return np.clip(2 ** np.ceil(np.log2(np.maximum(sizes, 1) * 2)).astype(np.int64), 512, 65_536)


def bitmaps(values: np.ndarray, off: np.ndarray) -> list[bytes]:
    """The bitmap of each text."""
    sizes = np.diff(off)
    wide = widths(sizes)
    at = (values % np.repeat(wide, sizes).astype(np.uint64)).astype(np.int64)
    out: list[bytes] = [b""] * len(sizes)
    for w in np.unique(wide).tolist():
        rows = np.flatnonzero(wide == w)
        on = np.zeros((len(rows), w), bool)
        new = np.full(len(sizes), -1)
        new[rows] = np.arange(len(rows))
        text = np.repeat(new, sizes)
        on[text[text >= 0], at[text >= 0]] = True
        for r, packed in zip(rows.tolist(), np.packbits(on, axis=1)):
            out[r] = packed.tobytes()
    return out


class Signatures:
    """Bitmaps of several widths. A bitmap of width w is that of any smaller power of two, folded by OR."""

    def __init__(self, raw: list[bytes]):
        self.raw = np.array(raw, dtype=object)
        self.width = np.array([8 * len(r) for r in raw], np.int64)

    def at(self, rows: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros((len(rows), width // 64), np.uint64)
        for w in np.unique(self.width[rows]).tolist():
            some = np.flatnonzero(self.width[rows] == w)
            full = np.frombuffer(b"".join(self.raw[rows[some]]), np.uint8).view(np.uint64).reshape(len(some), w // width, width // 64)
            out[some] = np.bitwise_or.reduce(full, axis=1)
        return out


def _slot_counts(shingle: int) -> Callable:
    """Arrow kernel (id, words) -> (slot, c): in how many texts shingles of each slot stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in (s for b in batches for s in slices(b)):
            values, _ = per_text(*ngrams(*hashed_words(batch.column(1)), shingle))
            total += np.bincount((values % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "c"])

    return run


def _table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow kernel (slot, c), all rows in one task -> the counts of all slots in one row."""
    total = np.zeros(SLOTS, np.uint16)
    for batch in batches:
        total[batch.column(0).to_numpy()] = np.minimum(batch.column(1).to_numpy(), (1 << COUNTED) - 1)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])


def lay_order(path: str, docs: DataFrame, ident: str, text: str, shingle: int, least_words: int) -> None:
    """Write to ``path`` the counts of the shingles of every EACH-th text, by slots of their hashes (a fixed size): what the order of shingles is made of."""
    some = texts_of(docs.where(F.pmod(F.xxhash64(F.col(ident).cast("bigint")), F.lit(EACH)) == 0), ident, text, least_words)
    counts = some.mapInArrow(_slot_counts(shingle), "slot bigint, c bigint").groupBy("slot").agg(F.sum("c").alias("c"))
    counts.coalesce(1).mapInArrow(_table, "counts binary").write.mode("overwrite").parquet(path)


def order_at(path: str) -> np.ndarray:
    """The counts that ``lay_order`` has written, for kernels; none where it saw no text."""
    fs, root = opened(path)
    held = [pq.read_table(f.path, filesystem=fs) for f in fs.get_file_info(pafs.FileSelector(root)) if f.path.endswith(".parquet")]
    return next((np.frombuffer(t.column(0)[0].as_py(), np.uint16) for t in held if len(t)), np.zeros(SLOTS, np.uint16))


def first_shingles(values: np.ndarray, off: np.ndarray, counts: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each set (at most SLICE) the first n - ceil(similarity * n) + ASKED shingles, in the order of their counts and hashes, as 32 bits of these (equal bits of others only make more candidates); and their offsets."""
    sizes = np.diff(off)
    low = np.uint64(64 - COUNTED - 11)
    count = counts[(values % np.uint64(SLOTS)).astype(np.int64)].astype(np.uint64)
    place = (np.repeat(np.arange(len(sizes)), sizes).astype(np.uint64) << np.uint64(53)) | (count << low) | (mix(values) & ((np.uint64(1) << low) - np.uint64(1)))
    place.sort()
    most = np.minimum(sizes, sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64) + ASKED)
    kept = np.arange(off[-1]) - np.repeat(off[:-1], sizes) < np.repeat(most, sizes)
    return place[kept].astype(np.uint32).view(np.int32), np.concatenate([[0], np.cumsum(most)])


def _signatures(shingle: int, similarity: float, order: str) -> Callable:
    """Arrow kernel (id, words) -> id, set_hash, n, signature, tops: the first shingles in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = order_at(order)
        for batch in (s for b in batches for s in slices(b)):
            values, off = per_text(*ngrams(*hashed_words(batch.column(1)), shingle))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values), dtype=np.uint64)])
            tops, top_off = first_shingles(values, off, counts, similarity)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), as_int64(total[off[1:]] - total[off[:-1]]), pa.array(np.diff(off), pa.int32()), pa.array(bitmaps(values, off), pa.binary()), pa.ListArray.from_arrays(pa.array(top_off, pa.int32()), pa.array(tops))],
                ["id", "set_hash", "n", "signature", "tops"],
            )

    return run


class Tree:
    """A signature tree over rows that stand in order of size: levels of nodes, each the OR and the size range of ``fan`` nodes below."""

    def __init__(self, signs: np.ndarray, sizes: np.ndarray, leaf: int = LEAF, fan: int = 4):
        self.bits = np.bitwise_count(signs).sum(1, dtype=np.int64)
        low = [np.arange(0, len(sizes), leaf)]
        while len(low[-1]) > 1:
            low.append(low[-1][::fan])
        self.levels = [
            (a, np.append(a[1:], len(sizes)), np.bitwise_or.reduceat(signs, a, axis=0), np.minimum.reduceat(sizes, a), np.maximum.reduceat(sizes, a), np.minimum.reduceat(self.bits, a)) for a in low
        ]
        self.fan = fan


def overlap_needed(small: np.ndarray, large: np.ndarray, similarity: float) -> np.ndarray:
    """Least overlap with which sets of these sizes can reach the similarity."""
    return np.ceil(similarity * (small + large) / (1 + similarity) - 1e-9)


def tree_join(signs: np.ndarray, sizes: np.ndarray, similarity: float, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j of the leaves that a dual traversal of the signature tree over (signs, sizes; best in order of size) leaves over. ``side``: only pairs of different sides are wanted."""
    tree = Tree(signs, sizes)
    first_side = None if side is None else [np.minimum.reduceat(side, low[0]) for low in tree.levels]
    last_side = None if side is None else [np.maximum.reduceat(side, low[0]) for low in tree.levels]
    top = len(tree.levels) - 1
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for depth in range(top, -1, -1):
        _, _, union, low, high, bits = tree.levels[depth]
        common = np.bitwise_count(union[a] & union[b]).sum(1, dtype=np.int64)
        # A text of node a has at least bits[a] bits, of which at most `common` lie within node b; each other one is a shingle not shared.
        most = np.minimum(high[a] - np.maximum(0, bits[a] - common), high[b] - np.maximum(0, bits[b] - common))
        fits = (most >= overlap_needed(low[a], low[b], similarity)) & (high[a] >= similarity * low[b] - 1e-9) & (high[b] >= similarity * low[a] - 1e-9)
        if side is not None:  # two nodes of one and the same side
            fits &= (first_side[depth][a] != last_side[depth][b]) | (last_side[depth][a] != first_side[depth][b])
        a, b = a[fits], b[fits]
        if depth:
            below = len(tree.levels[depth - 1][0])
            step = np.arange(tree.fan)
            ca = (a[:, None, None] * tree.fan + step[None, :, None]).repeat(tree.fan, 2).reshape(-1)
            cb = (b[:, None, None] * tree.fan + step[None, None, :]).repeat(tree.fan, 1).reshape(-1)
            ok = (ca < below) & (cb < below) & (ca <= cb)
            a, b = ca[ok], cb[ok]
    first, last = tree.levels[0][0], tree.levels[0][1]
    if signs.shape[1] > DENSE // 64:
        signs = np.bitwise_or.reduce(signs.reshape(len(signs), -1, DENSE // 64), axis=1)
    on = np.unpackbits(signs.view(np.uint8), axis=1).astype(np.float32)
    bits = on.sum(1)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    starts = np.flatnonzero(np.diff(a, prepend=-1))
    for x, partners in zip(a[starts].tolist(), np.split(b, starts[1:])):
        # A leaf against all leaves left for it: the common bits of all their texts are one matrix product.
        i, j = np.arange(first[x], last[x]), np.concatenate([np.arange(first[y], last[y]) for y in partners.tolist()])
        most = np.minimum((sizes[i] - bits[i])[:, None], (sizes[j] - bits[j])[None, :]) + on[i] @ on[j].T
        fits = (most >= overlap_needed(sizes[i][:, None], sizes[j][None, :], similarity)) & (i[:, None] < j[None, :])
        at = np.nonzero(fits)
        left.append(i[at[0]])
        right.append(j[at[1]])
    return np.concatenate(left), np.concatenate(right)


def survivors(signs: Signatures, sizes: np.ndarray, i: np.ndarray, j: np.ndarray, similarity: float, step: int = 100_000) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of texts whose sizes and bitmaps leave room for the similarity."""
    fits = np.minimum(sizes[i], sizes[j]) >= similarity * np.maximum(sizes[i], sizes[j]) - 1e-9
    i, j = i[fits], j[fits]
    width = np.minimum(signs.width[i], signs.width[j])
    keep = np.zeros(len(i), bool)
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        rows, place = np.unique(np.concatenate([i[own], j[own]]), return_inverse=True)
        maps = signs.at(rows, w)
        bits = np.bitwise_count(maps).sum(1, dtype=np.int64)
        for at in range(0, len(own), step):
            some = own[at : at + step]
            x, y = place[at : at + len(some)], place[len(own) + at : len(own) + at + len(some)]
            common = np.bitwise_count(maps[x] & maps[y]).sum(1, dtype=np.int64)
            most = np.minimum(sizes[i[some]] - bits[x], sizes[j[some]] - bits[y]) + common
            keep[some] = most >= overlap_needed(sizes[i[some]], sizes[j[some]], similarity)
    return i[keep], j[keep]


def _group_kernel(similarity: float) -> Callable:
    """Arrow kernel over rows (g, side, id, n, signature) sorted by (g, side, n): the surviving pairs of each tree g, of different sides where it has sides (0, 1; -1: none)."""

    def pairs(side: np.ndarray, ids: np.ndarray, n: np.ndarray, raw: list[bytes], starts: np.ndarray) -> pa.RecordBatch:
        signs, sizes = Signatures(raw), np.diff(starts)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for size in np.unique(sizes[(sizes > 1) & (sizes <= LEAF)]).tolist():  # trees of a single leaf, all of one size at once
            one, other = np.triu_indices(size, 1)
            first = starts[:-1][sizes == size][:, None]
            found.append(((first + one).ravel(), (first + other).ravel()))
        for s, e in zip(starts[:-1][sizes > LEAF].tolist(), starts[1:][sizes > LEAF].tolist()):
            rows = np.arange(s, e)
            i, j = tree_join(signs.at(rows, int(signs.width[s:e].min())), n[s:e], similarity, side[s:e] if side[s] >= 0 else None)
            found.append((i + s, j + s))
        i, j = (np.concatenate(x) for x in zip(*found))
        wanted = (side[i] < 0) | (side[i] != side[j])
        i, j = survivors(signs, n, i[wanted], j[wanted], similarity)
        left, right = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
        if len(left):
            left, right = np.unique(np.stack([left, right]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = [batch.column(c).to_numpy().astype(np.int64) for c in range(4)]
            raw = batch.column(4).to_pylist()
            if held is not None:
                numbers = [np.concatenate([x, y]) for x, y in zip(held, numbers)]
                raw = held[4] + raw
            g = numbers[0]
            starts = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1])
            if len(starts) > 1:  # the last tree may go on in the next batch
                yield pairs(*numbers[1:], raw, starts)
            s = starts[-1]
            held = (*(x[s:] for x in numbers), raw[s:])
        if held is not None:
            yield pairs(*held[1:], np.array([0, len(held[0])]))

    return run


def meet(n: np.ndarray, rest: np.ndarray, m: np.ndarray, other: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether sets of ``n`` and ``m`` shingles that share one, from which on they have ``rest`` and ``other`` in the order, may be alike with this as one of the first ASKED shared; and how many of these they must share."""
    needed = overlap_needed(n, m, similarity)
    return np.minimum(rest, other) >= needed - (ASKED - 1), np.minimum(needed, ASKED)


def _packed(columns: list[np.ndarray]) -> bytes:
    """A block of rows: column after column, and of each its first bytes, its second and so on, as they compress best."""
    return b"".join(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in columns)


def _unpacked(blocks: list[bytes], kinds: list[type]) -> list[np.ndarray]:
    """The columns of all rows of these blocks."""
    width, out, at = sum(np.dtype(k).itemsize for k in kinds), [], 0
    for kind in kinds:
        size = np.dtype(kind).itemsize
        parts = [np.frombuffer(b, np.uint8, size * (len(b) // width), at * (len(b) // width)).reshape(size, -1).T for b in blocks]
        out.append(np.concatenate([np.zeros((0, size), np.uint8), *parts]).reshape(-1).view(kind))
        at += size
    return out


def _blocks(bucket: np.ndarray, columns: list[np.ndarray]) -> list[pa.Array]:
    """The buckets that occur, and the block of each one's rows in their order."""
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [x[order] for x in columns]
    starts = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
    ends = [*starts[1:].tolist(), len(bucket)]
    return [pa.array(bucket[starts].astype(np.int32)), pa.array([_packed([x[s:e] for x in columns]) for s, e in zip(starts.tolist(), ends)], pa.binary())]


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each 32-bit hash, in a type whose sort is fast."""
    return (h.astype(np.uint64) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16 if buckets <= 1 << 16 else np.int32)


#: Columns of a row of _top_blocks (id, top, n, rest) and of _meet_kernel (a, b, least).
TOP_ROW, MEETING = [np.int64, np.int32, np.int32, np.int32], [np.int64, np.int64, np.int8]


def _top_blocks(buckets: int) -> Callable:
    """Arrow kernel (id, n, tops) -> (bucket, block): the rows (id, top, n, rest) of each first shingle, those of a bucket of tops in one block. ``rest``: shingles of the text from the top on in the order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off = offsets(batch.column(2))
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(off, off[at] + TOPS, "right")) - 1)
                ids, n, tops = (batch.column(c).slice(at, end - at) for c in range(3))
                sizes, tops = np.diff(off[at : end + 1]), tops.flatten().to_numpy()
                rest = (np.repeat(n.to_numpy() + (off[at:end] - off[at]), sizes) - np.arange(len(tops))).astype(np.int32)
                made = _blocks(_bucket(tops.view(np.uint32), buckets), [np.repeat(ids.to_numpy(), sizes), tops, np.repeat(n.to_numpy(), sizes), rest])
                yield pa.RecordBatch.from_arrays(made, ["bucket", "block"])
                at = end

    return run


def pair_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a.view(np.uint64)) * R + b.view(np.uint64))


def _meet_kernel(similarity: float, buckets: int, step: int = 250_000) -> Callable:
    """Arrow kernel over (bucket, block) of ``_top_blocks``, all blocks of a bucket in one task -> (bucket, block): the (a, b, least) of each top that two texts meet below, those of a bucket of pairs in one block; (bucket, top) of each top with more than FREQUENT texts."""

    def pairs(ids: np.ndarray, n: np.ndarray, rest: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        sizes = np.diff(starts)
        for size in np.unique(sizes[(sizes > 1) & (sizes <= FREQUENT)]).tolist():
            one, other = np.triu_indices(size, 1)
            first = starts[:-1][sizes == size][:, None]
            for at in range(0, len(first), max(1, step // len(one))):
                some = first[at : at + max(1, step // len(one))]
                i, j = (some + one).ravel(), (some + other).ravel()
                fits, least = meet(n[i], rest[i], n[j], rest[j], similarity)
                fits &= ids[i] != ids[j]
                x, y = ids[i[fits]], ids[j[fits]]
                yield np.minimum(x, y), np.maximum(x, y), least[fits].astype(np.int8)

    def laid(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b, least = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(a)
        a, b, least = a[order], b[order], least[order]
        made = _blocks(_bucket(pair_hashes(a, b) >> np.uint64(32), buckets), [a, b, least])
        return pa.RecordBatch.from_arrays([*made, pa.nulls(len(made[0]), pa.int32())], ["bucket", "block", "top"])

    def by_top(rows: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """The rows in order of top, and where each top starts."""
        place = (rows[1].view(np.uint32).astype(np.uint64) << np.uint64(32)) | np.arange(len(rows[1]), dtype=np.uint64)
        place.sort()
        rows = [x[(place & np.uint64(0xFFFFFFFF)).astype(np.int64)] for x in rows]
        return rows, np.append(np.flatnonzero(np.diff(rows[1].astype(np.int64), prepend=1 << 32)), len(rows[1]))

    def thinned(rows: list[np.ndarray]) -> list[np.ndarray]:
        """Of a top that is known to be frequent no more rows are kept than tell so."""
        rows, starts = by_top(rows)
        kept = np.arange(starts[-1]) - np.repeat(starts[:-1], np.diff(starts)) <= FREQUENT
        return [x[kept] for x in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, blocks, waiting, bound = _unpacked([], TOP_ROW), [], 0, 4 * TOPS
        for batch in batches:
            for block in batch.column(1):
                blocks.append(block.as_py())
                waiting += len(blocks[-1]) // 20
                if len(held[0]) + waiting > bound:
                    held, blocks, waiting = thinned([np.concatenate(x) for x in zip(held, _unpacked(blocks, TOP_ROW))]), [], 0
                    bound = max(bound, 2 * len(held[0]))
        held, blocks = [np.concatenate(x) for x in zip(held, _unpacked(blocks, TOP_ROW))], []
        if not len(held[0]):
            return
        (ids, top, n, rest), starts = by_top(held)
        held = []
        tops = pa.array(top[starts[:-1][np.diff(starts) > FREQUENT]])
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(tops), np.int32)), pa.nulls(len(tops), pa.binary()), tops], ["bucket", "block", "top"])
        found, waiting = [], 0
        for some in pairs(ids, n, rest, starts):
            found.append(some)
            waiting += len(some[0])
            if waiting >= MEETINGS // 2:
                yield laid(found)
                found, waiting = [], 0
        if waiting:
            yield laid(found)

    return run


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow kernel over (bucket, block, top) of ``_meet_kernel``, all blocks of a bucket in one task -> (a, b) of the pairs that meet often enough, each once; (top, null) of each frequent top."""
    blocks = []
    for batch in batches:
        blocks += [b for b in batch.column(1).to_pylist() if b is not None]
        tops = batch.column(2).drop_null()
        yield pa.RecordBatch.from_arrays([tops.cast(pa.int64()), pa.nulls(len(tops), pa.int64())], ["a", "b"])
    a, b, least = _unpacked(blocks, MEETING)
    if not len(a):
        return
    h = pair_hashes(a, b)
    order = np.argsort(h)
    starts = np.flatnonzero(np.diff(h[order], prepend=~h[order[:1]]))
    sizes = np.diff(np.append(starts, len(h)))
    # Two pairs of one hash would count as one, and both come out: more candidates, never fewer.
    kept = order[np.repeat(sizes >= np.minimum.reduceat(least[order], starts), sizes)]
    left, right = np.unique(np.stack([a[kept], b[kept]]), axis=1)
    yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], ["a", "b"])


def texts_of(docs: DataFrame, ident: str, text: str, least_words: int) -> DataFrame:
    """(id, words) of the texts with at least ``least_words`` words, which are joined by blanks: a value for each text, not for each word, is made and goes to the kernels. They come out of a generator, below which Catalyst cannot push the filter: it would find the words twice."""
    joined = F.trim(F.lower(F.regexp_replace(F.col(text), r"\P{L}+", " ")))  # as ``words`` finds them
    found = docs.select(F.col(ident).cast("bigint").alias("id"), F.explode(F.array(joined)).alias("words"))
    blanks = F.octet_length("words") - F.octet_length(F.replace("words", F.lit(" "), F.lit("")))
    return found.where(F.when(F.col("words") == "", 0).otherwise(blanks + 1) >= least_words)


def hashed_words(joined: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of ``texts_of``, and the offsets of the texts in them."""
    apart = pc.split_pattern(joined, " ")
    return word_hashes(apart.flatten()), offsets(apart)


def _candidates(signed: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs of class representatives that share first shingles enough, or one that many hold and survive its tree."""
    tops = signed.select("id", "n", F.posexplode("tops").alias("_place", "top")).select("top", "id", "n", (F.col("n") - F.col("_place")).alias("rest"))
    # Neither first shingles nor meetings are shuffled or sorted as single rows: blocks of them are, a bucket to a task. How many there are is told from the tops of the lowest hashes.
    some = tops.where(F.col("top") < F.lit(-(1 << 31) + (1 << 32) // COUNT_EACH)).groupBy("top").agg(F.count("*").alias("c"))
    shingles, meetings = (x or 0 for x in some.agg(F.sum("c"), F.sum(F.when(F.col("c") <= FREQUENT, F.col("c") * (F.col("c") - 1) / 2))).first())
    of_tops, of_pairs = int(shingles * COUNT_EACH // TOPS) + 1, int(meetings * COUNT_EACH // MEETINGS) + 1
    laid = signed.select("id", "n", "tops").mapInArrow(_top_blocks(of_tops), "bucket int, block binary").repartitionById(of_tops, F.col("bucket"))
    met = laid.mapInArrow(_meet_kernel(similarity, of_pairs), "bucket int, block binary, top int").repartitionById(of_pairs, F.col("bucket"))
    met = stored(met.mapInArrow(_often, "a bigint, b bigint"), "met")
    frequent = met.where("b is null").select(F.col("a").cast("int").alias("top"))
    # Every text also takes part in the trees of all its frequent shingles: a pair that shares one of them need not meet elsewhere.
    size_class = F.when(F.col("c") > CELL, F.floor(F.log("n") / -float(np.log(similarity)))).otherwise(0) if similarity < 1 else F.lit(0)
    common = tops.join(frequent, "top")
    common = common.join(common.groupBy("top").agg(F.count("*").alias("c")), "top").select("id", "top", size_class.cast("int").alias("size"))
    blocks = stored(common.groupBy("top", "size").agg(F.ceil(F.count("*") / CELL).cast("int").alias("parts")), "top-blocks")
    placed = common.join(blocks, ["top", "size"]).withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int")).drop("parts")
    # Sets of this similarity lie in one class of sizes or in two that touch.
    near = placed.withColumn("_other", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)))
    near = near.join(blocks.select("top", F.col("size").alias("_other"), "parts"), ["top", "_other"]).withColumn("_at", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    own, other = F.struct("size", "part"), F.struct(F.col("_other").alias("size"), F.col("_at").alias("part"))
    cells = near.select(F.xxhash64("top", F.least(own, other), F.greatest(own, other)).alias("g"), F.when(own == other, -1).when(own < other, 0).otherwise(1).alias("side"), "id")
    rows = cells.join(signed.select("id", "n", "signature"), "id").select("g", "side", "id", "n", "signature").repartition("g").sortWithinPartitions("g", "side", "n", "id")
    return rows.mapInArrow(_group_kernel(similarity), "a bigint, b bigint").unionByName(met.where("b is not null")).distinct()


def _broadcast(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST else rows


def similar(docs: DataFrame, pairs: DataFrame, ident: str, text: str, shingle: int, similarity: float) -> DataFrame:
    """The (a, b) of ``pairs`` (distinct ids of ``docs``) whose shingle sets share at least ``similarity`` of their union."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("_n")).distinct()
    texts = texts_of(docs.join(_broadcast(stored(needed, "needed")), F.col(ident) == F.col("_n"), "left_semi"), ident, text, shingle)
    sets = stored(texts.mapInArrow(shingle_sets(shingle), "id bigint, shingles array<bigint>"), "shingles")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    shared = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("s"), (F.size("sa") + F.size("sb")).alias("t"))
    return shared.where(F.col("s") / (F.col("t") - F.col("s")) >= similarity).select("a", "b")


def alike(docs: DataFrame, ident: str, text: str, shingle: int = 5, similarity: float = 0.8, least_words: int = 40, runs: None = None) -> tuple[DataFrame, DataFrame]:
    """Links (a, b; a < b) between class representatives, and membership (id, class_id) of every text that takes part.

    Texts take part if they have ``least_words`` words (at least ``shingle``); null and empty texts do not. Equal shingle sets are one
    class, named by its smallest id; a repeated row is the same member. Other columns are ignored. ``runs`` once bounded the fingerprints
    of a text; nothing is bounded now, and only None is taken.
    """
    if runs is not None:
        raise ValueError("no number of runs bounds what is compared")
    least = max(least_words, shingle)
    order = qualified(docs.sparkSession, new_path(docs.sparkSession, "order"))
    lay_order(order, docs, ident, text, shingle, least)
    signed = stored(texts_of(docs, ident, text, least).mapInArrow(_signatures(shingle, similarity, order), "id bigint, set_hash bigint, n int, signature binary, tops array<int>").withColumn("row", F.monotonically_increasing_id()), "signatures")
    classes = signed.groupBy("set_hash", "n").agg(F.min("id").alias("class_id"))
    members = signed.select("id", "set_hash", "n").join(classes, ["set_hash", "n"]).select("id", "class_id").distinct()
    # Rows are told by number, so that nothing long is shuffled to find one row of each class and of each id.
    chosen = signed.groupBy("set_hash", "n").agg(F.min(F.struct("id", "row")).alias("f")).select("f.id", "f.row").groupBy("id").agg(F.min("row").alias("row")).select("row")
    first = signed.join(_broadcast(stored(chosen, "class-rows")), "row", "left_semi")
    pairs = stored(_candidates(first, similarity), "candidates")
    return similar(docs, pairs, ident, text, shingle, similarity), members


def alike_pairs(docs: DataFrame, ident: str, text: str, shingle: int = 5, similarity: float = 0.8, least_words: int = 40, runs: None = None) -> DataFrame:
    """(a, b; a < b): all pairs of alike texts, equal ones included, by ids. As many rows as there are such pairs."""
    links, members = alike(docs, ident, text, shingle, similarity, least_words, runs)
    left, right = members.select(F.col("id").alias("x"), F.col("class_id").alias("a")), members.select(F.col("id").alias("y"), F.col("class_id").alias("b"))
    within = left.join(right, F.col("a") == F.col("b")).where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    across = links.join(left, "a").join(right, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return within.unionByName(across)


def alike_classes(docs: DataFrame, ident: str, text: str, shingle: int = 5, similarity: float = 0.8, least_words: int = 40, runs: None = None) -> DataFrame:
    """(id, class_id, links): each text that takes part, its class of equal texts and the number of other classes alike to it."""
    links, members = alike(docs, ident, text, shingle, similarity, least_words, runs)
    counts = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("links"))
    return members.join(counts, "class_id", "left").select(F.col("id").alias(ident), "class_id", F.coalesce("links", F.lit(0)).alias("links"))
