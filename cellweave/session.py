"""Session and storage helpers shared by all operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, by Spark's own reader (works for any Hadoop path)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only where it is unset (tests, one machine) a new local one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = getattr(spark, "_cellweave_dir", None) or tempfile.mkdtemp(prefix="cellweave-")
        spark._cellweave_dir = path
    return path.rstrip("/")


#: Held while a table is cut: shuffle files go when the write has ended, and Arrow batches stay small.
_WHILE_CUT = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage in a form that outlives executors: the files are in shared storage, so a
    lost executor costs nothing but its running tasks. ``discard`` removes a table no longer read.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in _WHILE_CUT}
    try:
        for k, v in _WHILE_CUT.items():
            spark.conf.set(k, v)
        df.write.option("parquet.block.size", 16 << 20).parquet(path)  # small buffers in the writers
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete the files of tables made by ``cut``; nothing may read them afterwards. Others are ignored."""
    for t in tables:
        path = getattr(t, "_cut_path", None)
        if path:
            to = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            to.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(to, True)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
