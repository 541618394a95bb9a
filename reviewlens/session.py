"""Session-level helpers.

The library never builds the caller's session; it reads settings from the
session it is handed.  ``local_session`` exists for tests and ``bench.py``.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, or ``None``."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder from the session; a fresh temporary folder only in local mode.

    On a cluster a machine-local folder would not survive the loss of an
    executor, so a missing ``spark.checkpoint.dir`` is an error there.
    """
    found = checkpoint_dir(spark)
    if found:
        return found
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster is a cluster
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reviewlens-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame, name: str = "table", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder; read it back.

    Cuts the lineage of tables that feed many jobs (the feature table of a
    tuning run): a lost executor then costs a re-read of Parquet, not a
    re-run of the text pipeline.  One pass over the data, columnar, with
    pruning on later reads (of whole folders with ``partition_by``).
    """
    return written(df, shared_path(df.sparkSession, name), partition_by)


def written(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet at ``path``; read it back with the same columns.

    Zstandard: less disk than the default, and its buffers outside the heap are freed when a file
    is closed, not at some later garbage collection, which tells with very many small files.
    """
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the shared store has the file or folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of steps whose results are written tables by now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def in_threads(spark: SparkSession, function: Callable, items: Sequence, threads: int) -> list:
    """``function`` of each item, in order, from ``threads`` driver threads.

    A wrapped target holds one set of the session's local properties, among them the number of the query that runs.  Each item
    gets a target of its own: threads that shared one would take that number from each other.
    """
    calls = [inheritable_thread_target(spark)(partial(function, item)) for item in items]
    with ThreadPool(max(1, threads)) as pool:
        return pool.map(lambda call: call(), calls, chunksize=1)


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "reviewlens") -> SparkSession:
    """A ``local[cores]`` session for tests and the bench: no UI, AQE on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark
