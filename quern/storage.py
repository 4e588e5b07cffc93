"""Tables in the folder that all executors share: they cut lineage, survive lost executors, and keep what is read twice from being computed twice."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` where the session names one.

    Only where it is unset (tests, local mode) is a temporary folder chosen and set.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quern-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it is removed when the session's driver ends."""
    path = f"{shared_dir(spark)}/quern/{name}-{uuid.uuid4().hex[:12]}"
    _written.append((spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared folder with all that is in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            remove(spark, path)
        except Exception:  # the session is gone already
            return


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as a table in the shared folder (``options``: of the writer) and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
