"""Layout of work over tasks."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type


def spread(df: DataFrame) -> DataFrame:
    """``df`` over as many tasks as there are cores, if its files give far fewer (one small file is one task); else as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 < cores else df


def arrow(kind: pa.DataType) -> Callable:
    """Decorator of an Arrow UDF (arrays in, an array out) whose result has an Arrow type; needs no session."""
    return F.arrow_udf(from_arrow_type(kind))
