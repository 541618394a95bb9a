"""Helpers shared by the operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Most rows and bytes of an Arrow batch: what a Python worker holds at once.
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20


#: Applications whose workers have the package.
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, as ``--py-files`` would; they may run where it is not on their path."""
    context = spark.sparkContext
    root = Path(__file__).resolve().parents[2]
    if context.applicationId in _SHIPPED or not (root / "reviewlens").is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="reviewlens-py-")) / "reviewlens.zip"  # Spark hands it out from the driver
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.glob("reviewlens/**/*.py")):
            z.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def small_batches(spark: SparkSession) -> None:
    """Ready the session for the operators' Python functions.

    The workers get the package, and Arrow batches are held to sizes that suit long texts
    (smaller settings stay).
    """
    ship_package(spark)
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = int(str(spark.conf.get(name)).rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(name, str(most))


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of steps whose results are written tables by now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return freed memory to the system: Python workers live on after their tasks, idle ones too."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
    if trim:
        trim(0)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until ``df`` has no such column (Spark's names ignore case)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
