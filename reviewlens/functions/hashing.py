"""Deterministic buckets from a key.

A bucket depends on the key and a seed only -- not on partitioning, row
order or the number of executors -- so splits and folds are reproducible and
the same rows land in the same bucket in any engine that has md5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Separates the columns of a content hash, and stands for a null one.
UNIT, NULL = "\x1f", "\x00"


def row_key(df: DataFrame, key: str) -> Column:
    """The key as text; a null key becomes the md5 of the row's other plain columns.

    So rows without a key spread over all buckets, and equal rows share one.  Columns
    that have no text form (vectors, arrays, maps, structs) do not count.
    """
    name = next((c for c in df.columns if c.lower() == key.lower()), key)
    nested = (T.ArrayType, T.MapType, T.StructType, T.UserDefinedType, T.BinaryType)
    plain = [f.name for f in df.schema.fields if f.name != name and not isinstance(f.dataType, nested)]
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL)) for c in plain]
    content = F.md5(F.concat_ws(UNIT, *parts)) if parts else F.lit(NULL)
    return F.coalesce(F.col(f"`{name}`").cast("string"), content)


def hash_bucket(key: Column | str, seed: int | str, buckets: int) -> Column:
    """``md5(key || ':' || seed)``, first 32 bits, modulo ``buckets``."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(buckets)).cast("int")
