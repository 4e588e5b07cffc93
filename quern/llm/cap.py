"""Problem 1: cap the records of dominant contributors, keeping those of highest quality.

Method: radix selection. (score descending, identifier ascending) becomes 16 order-preserving bytes. Round
by round, records that still match a contributor's cutoff prefix are counted per contributor and next digit of
two bytes (partial aggregation before the shuffle, at most 65,536 counts for each contributor), the cutoff's next digit
is fixed, only the records that match it go into the next round, and in the end one comparison with the cutoff tells kept from dropped. No contributor's records
are ever sorted or gathered, so one that holds a third of all rows costs no more than any other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from quern.llm.common import stored

WIDTH, DIGIT = 16, 2


@F.pandas_udf(LongType())
def _descending(score: pd.Series) -> pd.Series:
    bits = (score.to_numpy(np.float64) + 0.0).view(np.int64)  # + 0.0: -0.0 equals 0.0
    # Of a negative number all bits but the sign are flipped, so that signed order is numeric order; ~ turns it round.
    return pd.Series(np.where(np.isnan(score.to_numpy(np.float64)), np.iinfo(np.int64).max, ~(bits ^ ((bits >> 63) & np.iinfo(np.int64).max))))


def order_key(score: Column, ident: Column) -> Column:
    """32 hex digits (16 bytes) whose text order is: score descending, null and NaN last, then identifier ascending."""
    unsigned = lambda c: F.lpad(F.hex(c.bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    return F.concat(unsigned(_descending(score.cast("double"))), unsigned(ident.cast("bigint")))


def cap(records: DataFrame, contributor: list[str], score: str, ident: str, limits: DataFrame, limit: str = "cap") -> DataFrame:
    """``records`` with ``kept``: true for the ``limit`` best of each contributor, false beyond it.

    ``contributor``: the columns that name one; ``limits``: one row for each contributor (any of those columns)
    with its limit (null: no limit). Best is the highest score, null and NaN below every number, and of equals the
    smaller ``ident`` (a bigint; repeated rows that share it stand or fall together, so their group may end
    above the limit). A null in ``contributor`` means unknown: such rows are kept. An empty table gives an
    empty result; other columns pass through, but one named ``kept`` is replaced.
    """
    keyed = records.withColumn("__key", order_key(F.col(score), F.col(ident)))
    known = F.lit(True)
    for c in contributor:
        known = known & F.col(c).isNotNull()
    by = [f"_g{i}" for i in range(len(contributor))]
    narrow = stored(keyed.where(known).select(*[F.col(c).alias(g) for c, g in zip(contributor, by)], "__key"), "cap-keys")
    renamed = limits.select(*[F.col(c).alias(g) for c, g in zip(contributor, by) if c in limits.columns], F.col(limit).cast("bigint").alias("_limit"))
    on = [g for g in by if g in renamed.columns]
    sizes = narrow.groupBy(*by).agg(F.count("*").alias("_n")).join(renamed, on, "left")
    cut = stored(sizes.where("_n > _limit").select(*by, F.lit("").alias("_cut"), F.when(F.col("_limit") > 0, F.col("_limit")).otherwise(-1).alias("_left")), "cap-cut")

    # A digit that is equal in all records needs no round.
    digits = range(0, 2 * WIDTH, 2 * DIGIT)
    part = lambda i: F.substring("__key", i + 1, 2 * DIGIT)
    spans = narrow.agg(*[F.min(part(i)).alias(f"a{i}") for i in digits], *[F.max(part(i)).alias(f"b{i}") for i in digits]).first()
    active = narrow
    for i in digits:
        if spans[f"a{i}"] == spans[f"b{i}"]:
            cut = cut.withColumn("_cut", F.when(F.col("_left") > 0, F.concat("_cut", F.lit(spans[f"a{i}"] or ""))).otherwise(F.col("_cut")))
            continue
        # Only the records that match their contributor's cutoff so far are read again.
        cut = stored(cut, "cap-cut")
        active = stored(active.join(cut.where("_left > 0").select(*by, "_cut"), by).where(F.col("__key").startswith(F.col("_cut"))).select(*by, "__key"), "cap-active")
        cut = stored(_round(active, cut, by, part(i)), "cap-cut")
        if cut.where("_left > 0").isEmpty():
            break
    # A contributor whose limit ended exactly at a digit has a shorter cutoff: all below it, whatever follows, are kept.
    bound = cut.select(*[F.col(g).alias(f"__{g}") for g in by], F.when(F.col("_left") < 0, "").otherwise(F.rpad("_cut", 2 * WIDTH, "g")).alias("__bound"))
    same = F.lit(True)
    for c, g in zip(contributor, by):
        same = same & (F.col(c) == F.col(f"__{g}"))
    out = keyed.join(bound, same, "left")
    return out.withColumn("kept", F.col("__bound").isNull() | (F.col("__key") <= F.col("__bound"))).drop("__key", "__bound", *[f"__{g}" for g in by])


def _round(active: DataFrame, cut: DataFrame, by: list[str], digit: Column) -> DataFrame:
    """Fix the next digit of every contributor's cutoff. ``_left``: how many of the rows that match the cutoff are still to be kept; 0 = the cutoff is final, -1 = none is kept."""
    done, open_ = cut.where("_left <= 0"), cut.where("_left > 0")
    counts = active.groupBy(*by, digit.alias("_digit")).agg(F.count("*").alias("_n")).join(open_, by)
    w = Window.partitionBy(*by).orderBy("_digit")
    total = counts.withColumn("_upto", F.sum("_n").over(w))
    # The cutoff's digit is the first with which the limit is reached.
    first = total.where((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_n") < F.col("_left")))
    left = F.col("_left") - (F.col("_upto") - F.col("_n"))
    fixed = first.select(*by, F.concat("_cut", "_digit").alias("_cut"), F.when(left == F.col("_n"), F.lit(0)).otherwise(left).alias("_left"))
    return fixed.unionByName(done)
