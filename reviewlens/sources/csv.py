"""Review CSV in, Parquet landing table out.

Review texts hold newlines, commas and quotes, so the reader uses
``multiLine`` and ``escape='"'``.  Every file is read by its own header: files are
grouped by header line, each group is read with its columns, and the groups are united
by name (case-insensitively; files spell ``rating`` and ``Rating``).  Values are cast with
``try_cast``: a malformed value becomes null instead of failing the job under ANSI mode or
shifting columns.  A row with more or fewer fields than its header is kept, and its text
can be had in a ``_corrupt`` column.  Spark reads a ``multiLine`` file in one task; with ``split`` the
records are found over byte ranges (``split_csv``), so that one huge file is read by many.  Either
way a CSV is read once and landed as Parquet; later work reads that.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.schema import REVIEWS
from reviewlens.sources.split_csv import csv_records

CORRUPT = "_corrupt"
#: Name that a corrupt row's text has while reading.
_RAW = "__corrupt_row"

_READ_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "escape": '"',
    "quote": '"',
    "mode": "PERMISSIVE",
}

_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "quote": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _headers(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header; one line of each file is read."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found: dict[tuple[str, ...], list[str]] = {}
    for name in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream = path.getFileSystem(conf).open(path)
        try:
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()
        if line:  # an empty file has no rows
            header = next(csv.reader([line.lstrip("\ufeff")]))
            found.setdefault(tuple(header), []).append(name)
    return found


def _read_group(
    spark: SparkSession, header: tuple[str, ...], files: list[str], schema: T.StructType, multi_line: bool, extra: bool
) -> DataFrame:
    """Files with one header, in ``schema`` and ``_corrupt``, with the other columns as text if wanted."""
    names = [f"c{i}" for i in range(len(header))]
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RAW]])
    options = _READ_OPTIONS | {"multiLine": str(multi_line).lower(), "columnNameOfCorruptRecord": _RAW, "columnPruning": "false"}
    raw = spark.read.schema(text).options(**options).csv(files)
    return raw.select(*_in_schema(header, schema, extra), F.col(_RAW).alias(CORRUPT))


def _by_lower(header: tuple[str, ...]) -> dict[str, int]:
    """Places of the columns by lower-case name; the first of equal names counts."""
    found: dict[str, int] = {}
    for i, name in enumerate(header):
        found.setdefault(name.strip().lower(), i)
    return found


def _known(schema: T.StructType) -> set[str]:
    return {f.name.lower() for f in schema.fields}


def _in_schema(header: tuple[str, ...], schema: T.StructType, extra: bool, prefix: str = "") -> list[Column]:
    """The columns of ``schema`` from the text columns ``c0, c1, ...``, and the others as text if wanted."""
    by_lower = {name: f"{prefix}c{i}" for name, i in _by_lower(header).items()}
    cols = []
    for field in schema.fields:
        src = by_lower.get(field.name.lower())
        value = F.col(src) if src else F.lit(None).cast("string")
        cols.append((value if isinstance(field.dataType, T.StringType) else value.try_cast(field.dataType)).alias(field.name))
    if extra:
        cols += [F.col(c).alias(n) for n, c in by_lower.items() if n not in _known(schema)]
    return cols


def _read_split(spark: SparkSession, path: str, schema: T.StructType, extra: bool) -> list[DataFrame]:
    """Files in byte ranges, by header, in ``schema`` and ``_corrupt``; those that cannot be split as they were."""
    records, lines, left = csv_records(spark, path)
    headers = [tuple(next(csv.reader([line], strict=False), ())) for line, _ in lines]
    options = {k: v for k, v in _READ_OPTIONS.items() if k not in ("header", "multiLine")} | {"columnNameOfCorruptRecord": _RAW}
    rows, columns = [F.col("record")], {}
    for i, (header, (_, crlf)) in enumerate(zip(headers, lines)):  # one scan for all headers; a row is parsed by its own
        if header:
            fields = ", ".join(f"{n} string" for n in [*(f"c{j}" for j in range(len(header))), _RAW])
            record = F.regexp_replace("record", "\r\n", "\n") if crlf else F.col("record")  # as the whole-file reader has it
            rows.append(F.when(F.col("head") == i, F.from_csv(record, fields, options)).alias(f"row{i}"))
            names = [f.name for f in schema.fields] + [n for n in _by_lower(header) if extra and n not in _known(schema)]
            corrupt = F.when(F.col(f"row{i}.{_RAW}").isNotNull(), F.col("record"))
            for name, value in zip([*names, CORRUPT], [*_in_schema(header, schema, extra, f"row{i}."), corrupt]):
                columns.setdefault(name, []).append(value)
    parsed = [records.filter(" or ".join(f"head = {i}" for i, h in enumerate(headers) if h)).select(*rows)] if columns else []
    groups = [r.select(*[F.coalesce(*values).alias(name) for name, values in columns.items()]) for r in parsed]
    return groups + [_read_group(spark, h, fs, schema, True, extra) for h, fs in _headers(spark, left).items()]


def read_reviews_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = REVIEWS,
    multi_line: bool = True,
    corrupt: bool = False,
    extra: bool = False,
    split: bool = False,
) -> DataFrame:
    """Read review CSV file(s) into ``schema``.

    ``multi_line`` (the default) parses quoted newlines correctly but reads
    each file in one task; a source whose texts hold no newlines can pass
    ``False`` to have large files split across tasks.  ``split`` reads files with quoted newlines by
    many tasks too, and headers that hold them; it reads the files three times (states, records across
    ranges, records), so it is for files that are large.  ``corrupt`` adds the ``_corrupt``
    column: the text of a row that has more or fewer fields than its header, else null
    (``corrupt_rows`` counts them).  ``extra`` adds columns beyond the schema, as text,
    null for files without them.

    Columns absent from a file are null.  A ``review_id`` that is absent or no number
    becomes a 64-bit hash of the other review columns, so it does not depend on
    partitioning and exact duplicates share an id (and so always land on the same side
    of a split).
    """
    if split:
        groups = _read_split(spark, path, schema, extra)
    else:
        files = [f for f in spark.read.text(path).inputFiles()]
        groups = [_read_group(spark, h, fs, schema, multi_line, extra) for h, fs in _headers(spark, files).items()]
    if not groups:
        groups = [spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)
    if "review_id" in schema.names:
        others = [c for c in schema.names if c != "review_id"]
        df = df.withColumn("review_id", F.coalesce("review_id", F.xxhash64(*others)))
    last = [c for c in df.columns if c != CORRUPT]
    return df.select(*last, CORRUPT) if corrupt else df.select(*last)


def corrupt_rows(reviews: DataFrame) -> DataFrame:
    """One row: how many rows were read, and how many of them corrupt (``reviews`` with ``_corrupt``)."""
    # Spark reads the corrupt column only beside others: the hash, always above the least long, is of all of them
    read = F.xxhash64(*[c for c in reviews.columns if c != CORRUPT]) >= F.lit(-(1 << 63))
    return reviews.agg(
        F.count(F.when(read, 1)).alias("rows"), F.count(F.when(read & F.col(CORRUPT).isNotNull(), 1)).alias("corrupt")
    )


def write_reviews_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write reviews as CSV that ``read_reviews_csv`` reads back unchanged."""
    df.write.mode(mode).options(**_WRITE_OPTIONS).csv(path)


def land_parquet(df: DataFrame, path: str, mode: str = "error") -> DataFrame:
    """Write ``df`` as Parquet and return a reader over the written files.

    For each review text the table gets ``has_summary`` and ``has_detail``, so that later
    filters on their presence read no text.
    """
    for name in ("summary", "detail"):
        if f"review_{name}" in df.columns:
            df = df.withColumn(f"has_{name}", F.col(f"review_{name}").isNotNull())
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)
