"""CSV scan that reads one file in many tasks, line breaks within quotes included.

Whether a line break ends a record depends on the quotes before it, in the whole file.  So:

1. one native pass over the lines counts the quotes of every byte range that a task reads;
2. a running sum over a file's ranges says which ranges start inside quotes;
3. each task cuts its range into records, starting from that.  What a record that crosses
   a range's end leaves on either side is put together by file and record, and every record is
   parsed by ``from_csv``.

Quotes must be paired as the CSV sink writes them: a cell that holds a quote is quoted and
the quote doubled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.common import BROADCAST_MAX_BYTES, join_small, materialize, row_bytes
from ..session import ship_package

RANGE = ["file", "block"]
HEAD, WHOLE, TAIL, HEADER = 0, 1, 2, 3  # the end of an earlier record, a record, the begin of one that goes on


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _range_starts(lines: DataFrame) -> DataFrame:
    """``(file, block, number, inside)``: does a byte range start within quotes?  A row for each range."""
    odd = lines.groupBy(*RANGE).agg((F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2).alias("q"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return odd.select(*RANGE, (F.coalesce(F.sum("q").over(before), F.lit(0)) % 2).cast("int").alias("inside")).select(
        *RANGE, F.monotonically_increasing_id().alias("number"), "inside")


def _cut(batches):
    """Cut lines ``(value, number, begin, inside)``, in order within a range, into ``(number, kind, record)``.
    ``begin``: the range begins with a header, which isn't kept."""
    at, odd, kind, pending = None, 0, WHOLE, []  # of the record that is open: its kind and lines

    def rows(kind, records):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(records), at, np.int64)), pa.array(np.full(len(records), kind, np.int32)),
                                           pa.array(records, pa.string())], ["number", "kind", "record"])

    def rest():
        return [rows(HEAD if kind == HEAD else TAIL, ["\n".join(pending)])] if pending and kind != HEADER else []

    for batch in batches:
        if batch.column(1).null_count:
            raise ValueError("byte ranges were cut anew since their quotes were counted")
        lines, number, begin, inside = batch.column(0), *(batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.diff(number, prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if number[a] != at:
                yield from rest()
                at, odd, pending = int(number[a]), int(inside[a]), []
                kind = HEAD if odd else HEADER if begin[a] else WHOLE
            after = (odd + np.cumsum(quotes[a:b])) & 1
            odd, ends = int(after[-1]), np.flatnonzero(after == 0) + 1
            done = int(ends[-1]) if len(ends) else 0
            if done:
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), lines.slice(a, done))
                records = pc.binary_join(lists, "\n")
                if pending or kind != WHOLE:
                    if kind != HEADER:
                        yield rows(kind, ["\n".join([*pending, records[0].as_py()])])
                    kind, pending, records = WHOLE, [], records.slice(1)
                yield rows(WHOLE, records.filter(pc.not_equal(pc.utf8_rtrim(records, "\r"), "")))
            if done < b - a:
                pending.append("\n".join(lines.slice(a + done, b - a - done).to_pylist()))
    yield from rest()


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``(record)``: the text of every record of the CSV files, without headers and empty lines."""
    ship_package(spark)
    lines = _lines(spark, path)
    starts = materialize(_range_starts(lines), "csv-ranges")
    columns = ["value", "number", ((F.col("block") == 0) & F.lit(header)).alias("begin"), "inside"]
    if starts.count() * row_bytes(starts) <= BROADCAST_MAX_BYTES:
        ordered = lines.join(F.broadcast(starts), RANGE, "left").select(*columns)
    else:  # some 700,000 ranges or more: lines of a range are brought together in their order
        ordered = (lines.withColumn("line", F.monotonically_increasing_id()).join(starts, RANGE, "left")
                   .repartition("number").sortWithinPartitions("number", "line").select(*columns))
    cut = materialize(ordered.mapInArrow(_cut, "number long, kind int, record string"), "csv-records")
    # at most a head and a tail a range; a tail opens the record that the following heads go on with
    opened = F.sum((F.col("kind") == TAIL).cast("long")).over(Window.partitionBy("file").orderBy("block", "kind"))
    crossing = (join_small(cut.where(F.col("kind") != WHOLE), starts, "number").withColumn("nth", opened).groupBy("file", "nth")
                .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "kind", "record"))),
                                              lambda p: p["record"]), "\n").alias("record")))
    return cut.where(F.col("kind") == WHOLE).select("record").unionByName(crossing.select("record"))


def scan_csv(spark: SparkSession, path: str, schema: StructType, options: dict[str, str]) -> DataFrame:
    """The records of CSV files, parsed by ``from_csv`` with the given schema and options."""
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    parsed = csv_records(spark, path, options.get("header") == "true").select(
        F.from_csv(F.regexp_replace("record", r"\r\z", ""), ddl, {k: v for k, v in options.items() if k != "header"}).alias("r"))
    return parsed.select("r.*")
