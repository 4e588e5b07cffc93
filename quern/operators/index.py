"""The vector table: scalar metadata, incremental additions, exact nearest neighbours."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from quern.functions import text as T


def valid_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks whose text and id are non-blank strings."""
    return chunks.where((T.strip(F.col("text")) != "") & (T.strip(F.col("chunk_id")) != ""))


def window(chunks: DataFrame, order: list[str], offset: int = 0, limit: int | None = None) -> DataFrame:
    """Valid chunks from an offset on, which counts all rows, up to a limit, which counts valid ones only."""
    rest = chunks.orderBy(*order).offset(offset) if offset else chunks
    kept = valid_chunks(rest)
    return kept if limit is None else kept.orderBy(*order).limit(limit)


def metadata(chunks: DataFrame, skip: tuple[str, ...] = ("text",)) -> DataFrame:
    """All columns but ``skip`` as scalars: null becomes '', arrays, maps and structs become JSON text."""
    def scalar(f: Ty.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (Ty.ArrayType, Ty.MapType, Ty.StructType)):
            return F.coalesce(F.to_json(c), F.lit("")).alias(f.name)
        return F.coalesce(c.cast("string"), F.lit("")).alias(f.name) if isinstance(f.dataType, Ty.StringType) else c.alias(f.name)

    return chunks.select(*[scalar(f) for f in chunks.schema.fields if f.name not in skip])


def missing(chunks: DataFrame, index: DataFrame, ident: str = "chunk_id", index_id: str = "id") -> DataFrame:
    """Chunks that the index does not hold yet; the check stands below any embedding."""
    return chunks.join(index.select(F.col(index_id).alias("_id")), F.col(ident) == F.col("_id"), "left_anti")


def nearest(queries: DataFrame, vectors: DataFrame, k: int, by: list[str], ident: str, embedding: str = "embedding", block: int = 10_000) -> DataFrame:
    """The k nearest vectors of every query by cosine distance, exact, ties by id: the ``by`` columns, ``ident``, ``distance``, ``rank``.

    A stated set of queries is compared with all rows, in blocks of ``block`` queries: a block travels to the tasks as one matrix, and each
    task keeps its own k best (matrix products over Arrow batches), so at most k rows a query and task are shuffled.
    ``queries``: the ``by`` columns and q_embedding. Vectors of other lengths, null, zero and non-finite ones take no part. Distances are
    rounded to 12 decimals, so that the order of summation does not decide ties.
    """
    spark, key = queries.sparkSession, F.struct(*by)
    kind = vectors.schema[ident].dataType
    usable = vectors.where(F.col(embedding).isNotNull()).select(F.col(ident).alias("id"), F.col(embedding).alias("e"))
    parts = []
    for rows in _blocks(queries.select(key.alias("k"), "q_embedding"), block):
        if rows:
            asked = spark.createDataFrame([(i, r.k) for i, r in enumerate(rows)], Ty.StructType([Ty.StructField("q", Ty.IntegerType()), Ty.StructField("k", queries.select(key.alias("k")).schema["k"].dataType)]))
            found = usable.mapInArrow(_searcher(spark.sparkContext.broadcast([r.q_embedding for r in rows]), k), Ty.StructType([Ty.StructField("q", Ty.IntegerType()), Ty.StructField("id", kind), Ty.StructField("distance", Ty.DoubleType())]))
            parts.append(found.join(F.broadcast(asked), "q").select(*[F.col(f"k.`{c}`").alias(c) for c in by], F.col("id").alias(ident), "distance"))
    if not parts:
        return queries.limit(0).select(*by, F.lit(None).cast(kind).alias(ident), F.lit(0.0).alias("distance"), F.lit(0).alias("rank"))
    w = Window.partitionBy(*by).orderBy("distance", ident)
    return functools.reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _blocks(queries: DataFrame, block: int) -> Iterator[list]:
    """The queries in lists of about ``block`` rows, one at a time on the driver."""
    first = queries.limit(block + 1).collect()
    if len(first) <= block:
        yield first
        return
    count = -(-queries.count() // block)
    numbered = queries.withColumn("_block", F.pmod(F.xxhash64("k"), F.lit(count)))
    for b in range(count):
        yield numbered.where(F.col("_block") == b).drop("_block").collect()


def _searcher(queries, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in {len(v) for v in queries.value if v}:
            own = np.array([i for i, v in enumerate(queries.value) if v and len(v) == size])
            x = np.array([queries.value[i] for i in own], np.float64)
            by_size[size] = (own, x / np.linalg.norm(x, axis=1, keepdims=True))
        kept: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            ids, vectors = np.array(batch.column(0).to_pylist(), dtype=object), batch.column(1)
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
            for size, (own, q) in by_size.items():
                rows = np.flatnonzero(sizes == size)
                if not len(rows):
                    continue
                x = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), size)
                length = np.linalg.norm(x, axis=1)
                good = np.isfinite(length) & (length > 0)
                x, rows = x[good] / length[good, None], rows[good]
                for s in range(0, len(q) if len(rows) else 0, 256):
                    d = np.abs(np.round(1 - q[s : s + 256] @ x.T, 12))
                    last = np.partition(d, min(k, d.shape[1]) - 1, axis=1)[:, min(k, d.shape[1]) - 1]
                    at, col = np.nonzero(d <= last[:, None])  # ties of the last one too
                    new = (own[s + at], ids[rows[col]], d[at, col])
                    kept = new if kept is None else tuple(np.concatenate(y) for y in zip(kept, new))
            if kept is not None:
                kept = _best(*kept, k)
        if kept is not None:
            yield pa.RecordBatch.from_arrays([pa.array(kept[0].astype(np.int32)), pa.array(kept[1].tolist(), kind), pa.array(kept[2])], ["q", "id", "distance"])

    return run


def _best(q: np.ndarray, ids: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k first rows of each q by (d, id)."""
    place = np.unique(ids, return_inverse=True)[1]
    order = np.lexsort((place, d, q))
    q, ids, d = q[order], ids[order], d[order]
    first = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[first], ids[first], d[first]
