"""Records of quoted CSV files with line ends inside, read by many tasks a file.

A byte range of such a file does not tell whether it begins inside a quoted value.  A line
is a function from that state (outside, inside) to the state after it; functions of
consecutive lines compose.  So three narrow steps find every record:

1. each range (``_metadata.file_path``, ``file_block_start``) reduces its lines to one row: the
   state at its end for either state at its start, whether the record that is open at
   its start ends in it, and, for a file's first range, the header;
2. a window over the ranges of a file composes these functions: one short row a range, no text;
3. each range, now knowing its start, puts its lines together into records.  A record that crosses
   ranges leaves a piece in each; only these pieces are shuffled, keyed by (file, range in which the
   record begins).

Most lines hold no quote and leave the state as it is.  An odd quote, a quote inside an unquoted value
and text after a closing quote are all cases of the same two patterns, so the records are those
that a reader of the whole file finds.

The ranges are those that Spark's text scan makes.  If they are others when the result is run than when
it was planned (changed files, or another ``spark.sql.files.maxPartitionBytes``), the run raises: the
state at an unknown range is not guessed.  Ranges in the table joined to the lines are counted:
up to ``MOST_RANGES`` (some 100 MB) it is broadcast; beyond, the join is Spark's, and ranges are put
into line order again after it.

Edge cases: an empty file has no records; blank lines are no records; a byte order mark is
dropped; a file whose first line ends in ``\\r\\n`` has that as its line end (records keep it inside values);
a quote that is never closed makes the rest of its file one record; a file that ends lines with ``\\r`` alone,
or whose header does not end in its first range, is left to a reader of whole files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlens.session import materialize

#: Most ranges whose states are broadcast.
MOST_RANGES = 1_000_000

# A quoted value's inside, then: what keeps a line open that begins outside, and inside, a quoted value.
_INSIDE = r'(?:[^"]++|"")*+'
_OPENS = rf'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|),)*+"{_INSIDE}\z'
OPEN_FROM = (rf"\A{_OPENS}", rf'\A{_INSIDE}(?:\z|"[^,]*+,{_OPENS})')

_RANGES = (
    "file string, start long, open0 boolean, open1 boolean, ends0 boolean, ends1 boolean, header binary, returns boolean"
)
_RECORDS = "file string, start long, begin long, head int, record binary"


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines in file order within a range: ``file, start, value, open0, open1``."""
    raw = spark.read.option("lineSep", "\n").text(paths)
    value = F.col("value")

    def opens(state: int) -> Column:
        return F.when(~F.contains(value, F.lit('"')), F.lit(bool(state))).otherwise(value.rlike(OPEN_FROM[state]))

    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        value.cast("binary").alias("value"),
        opens(0).alias("open0"),
        opens(1).alias("open1"),
    )


def _after(open0: np.ndarray, open1: np.ndarray, state: bool) -> np.ndarray:
    """The state after each line, from the state before the first."""
    flips = np.cumsum(open0 & ~open1)
    last = np.maximum.accumulate(np.where(open0 == open1, np.arange(len(open0)), -1))  # a line that fixes the state
    base = np.where(last >= 0, open0[last], state)
    return base ^ ((flips - np.where(last >= 0, flips[last], 0)) % 2 == 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """((file, start), its rows) of consecutive rows of one range."""
    if not batch.num_rows:
        return
    file, start = batch.column("file").dictionary_encode(), batch.column("start").to_numpy(zero_copy_only=False)
    code = file.indices.to_numpy()
    cuts = [0, *(np.flatnonzero((np.diff(code) != 0) | (np.diff(start) != 0)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield (file.dictionary[int(code[a])].as_py(), int(start[a])), batch.slice(a, b - a)


def _flags(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(rows.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("open0", "open1"))


def _reduce_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a range: see step 1."""
    names = ["file", "start", "open0", "open1", "ends0", "ends1", "header", "returns"]
    types = [pa.string(), pa.int64(), *[pa.bool_()] * 4, pa.binary(), pa.bool_()]
    key, state, ends, head, complete, returns = None, [False, True], [False, False], [], False, False

    def row() -> pa.RecordBatch:
        header = b"\n".join(head) if complete else None
        values = [*key, *state, *ends, header, returns]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    for batch in batches:
        for found, rows in _runs(batch):
            if found != key:
                if key:
                    yield row()
                key, state, ends, head, complete, returns = found, [False, True], [False, False], [], False, False
            flags = _flags(rows)
            after = [_after(*flags, state[s]) for s in (0, 1)]
            if key[1] == 0 and not complete:
                closed = np.flatnonzero(~after[0])
                lines = rows.column("first").slice(0, closed[0] + 1 if len(closed) else len(rows)).to_pylist()
                if not head:
                    returns = b"\r" in lines[0][:-1]
                head += lines
                complete = bool(len(closed))
            for s in (0, 1):
                ends[s] |= bool((~after[s]).any())
                state[s] = bool(after[s][-1])
    if key:
        yield row()


def _put_together(pieces: bool):
    """Step 3: the records that lie in one range, or (``pieces``) the parts of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, parts, joins, begin, head = None, False, [], False, 0, 0
        out: list[tuple] = []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 5
            types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, ["file", "start", "begin", "head", "record"])

        def leave() -> None:
            if pieces and parts:
                out.append((*key, begin if joins else key[1], head, b"\n".join(parts)))

        for batch in batches:
            for found, lines in _runs(batch):
                if found != key:
                    leave()
                    at = {c: lines.column(c)[0].as_py() for c in ("inside", "begin", "head")}
                    if at["inside"] is None:
                        raise RuntimeError(f"{found[0]} is split otherwise than when it was planned; read it again")
                    key, state, parts, joins, begin, head = found, at["inside"], [], at["inside"], at["begin"], at["head"]
                    skip = key[1] == 0  # the header
                values, a = lines.column("value").to_pylist(), 0
                after = _after(*_flags(lines), state)
                state = bool(after[-1])
                for end in np.flatnonzero(~after):
                    parts += values[a : end + 1]
                    a = end + 1
                    if joins == pieces and not skip:
                        out.append((*key, begin if joins else key[1], head, b"\n".join(parts)))
                    parts, joins, skip = [], False, False
                parts += values[a:]
            if out:
                yield rows()
        if key:
            leave()
        yield rows()

    return run


def _ranges(lines: DataFrame) -> DataFrame:
    """Steps 1 and 2: ``file, start, inside, begin, header, crlf, whole`` for each range."""
    first = lines.withColumn("first", F.when(F.col("start") == 0, F.col("value"))).drop("value")
    ranges = first.mapInArrow(_reduce_ranges, _RANGES)
    file = Window.partitionBy("file").orderBy("start")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    # a range that fixes the state at its end, and the changes of state since the last such range
    fixes = F.col("open0") == F.col("open1")
    flips = F.sum(F.when(~fixes & F.col("open0"), 1).otherwise(0)).over(file)
    ranges = ranges.withColumn("flips", flips)
    fixed = F.last(F.when(fixes, F.struct("open0", "flips")), ignorenulls=True).over(before)
    ranges = ranges.withColumn("fixed", fixed).withColumn("flipped", F.coalesce(F.lag("flips").over(file), F.lit(0)))
    since = F.col("flipped") - F.coalesce(F.col("fixed.flips"), F.lit(0))
    inside = F.coalesce(F.col("fixed.open0"), F.lit(False)) != (since % 2 == 1)
    ranges = ranges.withColumn("inside", inside)
    # a range begins the record open at its end unless it lies inside that record as a whole
    opens = F.when(F.col("inside"), F.col("open1") & F.col("ends1")).otherwise(F.col("open0"))
    begin = F.coalesce(F.last(F.when(opens, F.col("start")), ignorenulls=True).over(before), F.lit(0))
    whole_file = Window.partitionBy("file")
    text = F.max("header").over(whole_file).cast("string")
    return ranges.select(
        "file",
        "start",
        "inside",
        begin.alias("begin"),
        F.regexp_replace(F.rtrim(text, F.lit("\r")), "^﻿", "").alias("header"),
        F.endswith(text, F.lit("\r")).alias("crlf"),
        (text.isNull() | F.max("returns").over(whole_file)).alias("whole"),
    )


def csv_records(
    spark: SparkSession, paths: str | list[str], most_ranges: int = MOST_RANGES
) -> tuple[DataFrame, list[tuple[str, bool]], list[str]]:
    """(``head, record`` of every record, header lines by ``head`` and if ``\\r\\n`` ends them, files left to a reader of whole files).

    The driver gets the different header lines, and the names of the files left.
    """
    lines = _lines(spark, paths)
    ranges = materialize(_ranges(lines), "csv-starts")
    whole = [r["file"] for r in ranges.filter("whole").select("file").distinct().collect()]
    kept = ranges.filter("not whole")
    headers = sorted((r["header"], r["crlf"]) for r in kept.select("header", "crlf").distinct().collect())
    schema = "head int, header string, crlf boolean"
    numbers = spark.createDataFrame([(i, *h) for i, h in enumerate(headers)], schema)
    # files left to the other reader: known ranges of no header
    starts = ranges.join(F.broadcast(numbers), ["header", "crlf"], "left").select("file", "start", "inside", "begin", "head", "whole")
    small = ranges.count() <= most_ranges
    numbered = lines if small else lines.withColumn("line", F.monotonically_increasing_id())
    joined = numbered.join(F.broadcast(starts) if small else starts, ["file", "start"], "left")
    if not small:
        joined = joined.sortWithinPartitions("file", "start", "line")
    joined = joined.filter("whole is null or not whole").drop("whole", "line")

    inner = joined.mapInArrow(_put_together(False), _RECORDS).select("head", F.col("record").cast("string").alias("record"))
    pieces = materialize(joined.mapInArrow(_put_together(True), _RECORDS), "csv-pieces")
    piece = F.struct("start", F.col("record").cast("string").alias("text"))
    parts = F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["text"])
    crossing = pieces.groupBy("file", "begin", "head").agg(F.array_join(parts, "\n").alias("record")).select("head", "record")

    crlf = F.col("head").isin([i for i, h in enumerate(headers) if h[1]])
    records = inner.union(crossing)
    records = records.withColumn("record", F.when(crlf, F.regexp_replace("record", r"\r\z", "")).otherwise(F.col("record")))
    return records.filter("record != ''"), headers, whole
