"""ETL operators: filtered scans by key set, check-in summaries, JSON flattening,
CSV round trips."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ship_package
from ..sources import io


def semi_join(big: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``big`` whose key is in ``keys`` (the out-of-core filtered scan).

    A left-semi join: the planner broadcasts ``keys`` only when its measured
    size is under the broadcast threshold, otherwise both sides shuffle on the
    key (AQE splits a skewed key's partition).
    """
    return big.join(keys.select(on).distinct(), on, "left_semi")


def checkin_summary(checkin: DataFrame, business: DataFrame, key: str = "business_id",
                    date_col: str = "date") -> DataFrame:
    """Summary of raw check-in records (one comma-joined timestamp string per business).

    ``checkin_total`` = number of timestamps, ``checkin_first``/``checkin_last``
    = first/last entry (trimmed).  Right join: every business is kept; those
    without check-ins get nulls.
    """
    parts = F.split(F.col(date_col), ",")
    s = checkin.select(key, F.size(parts).alias("checkin_total"),
                       F.trim(F.element_at(parts, 1)).alias("checkin_first"),
                       F.trim(F.element_at(parts, -1)).alias("checkin_last"))
    return s.join(business.select(key), key, "right")


def checkin_summary_from_events(events: DataFrame, business: DataFrame, key: str = "business_id",
                                ts: str = "ts", date_col: str = "date") -> DataFrame:
    """The same summary straight from one-row-per-check-in events.

    ``count`` / ``min_by`` / ``max_by`` aggregate partially before the shuffle,
    so a business with a third of all check-ins costs one row per map task
    instead of one giant string in one task.
    """
    s = events.groupBy(key).agg(
        F.count(F.lit(1)).cast("int").alias("checkin_total"),
        F.min_by(F.col(date_col), F.struct(ts, "event_id")).alias("checkin_first"),
        F.max_by(F.col(date_col), F.struct(ts, "event_id")).alias("checkin_last"))
    return s.join(business.select(key), key, "right")


# ---------------------------------------------------------------- JSON flattening
#
# Records go through Python's parser in Arrow batches, once each: it keeps the last value of a
# repeated key, and a number's own text, which a variant doesn't.

class _Number(str):
    """A JSON number by its own text."""


def _record(line: str | None) -> dict:
    """The JSON object of a line; an empty one for anything else."""
    try:
        v = json.loads(line or "", parse_int=_Number, parse_float=_Number, parse_constant=_Number)
    except (ValueError, RecursionError):
        return {}
    return v if isinstance(v, dict) else {}


def _entries(record: dict) -> Iterator[tuple[str, object]]:
    """``(dotted name, value)`` of every entry at any depth, an object before what it holds."""
    levels = [("", iter(record.items()))]
    while levels:
        prefix, entries = levels[-1]
        for key, value in entries:
            name = prefix + key
            yield name, value
            if isinstance(value, dict):
                levels.append((f"{name}." if name else "", iter(value.items())))
                break
        else:
            levels.pop()


def _json_text(v) -> str:
    if isinstance(v, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_json_text(x)}" for k, x in v.items()) + "}"
    if isinstance(v, list):
        return "[" + ",".join(map(_json_text, v)) + "]"
    return v if isinstance(v, _Number) else json.dumps(v, ensure_ascii=False)


def _cell(v) -> str:
    text = "" if v is None else str(v) if isinstance(v, (str, bool)) else _json_text(v)
    return text if text.isascii() else text.encode("utf-8", "replace").decode()  # halves of a pair: "?"


def json_leaf_paths(json_lines: DataFrame, col: str = "value") -> DataFrame:
    """``(path)``: union over all records of the dotted leaf names of a JSON object column.

    An empty object yields no name; arrays, scalars, nulls and strings, whatever they hold,
    are leaves; of a repeated key the last value counts.  Lines that aren't JSON objects (or nest
    deeper than Python's parser goes) give no names.  A task sends each name once; one ``distinct``."""
    def names(batches):
        known: set[str] = set()  # as many as the data has columns
        for batch in batches:
            found = {_cell(name) for line in batch.column(0).to_pylist()
                     for name, value in _entries(_record(line)) if not isinstance(value, dict)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found - known), pa.string())], ["path"])
            known |= found

    ship_package(json_lines.sparkSession)
    return json_lines.select(col).mapInArrow(names, "path string").distinct()


def json_flatten(json_lines: DataFrame, paths: Sequence[str], col: str = "value") -> DataFrame:
    """One string column per dotted name, in the given order, one row per line; a missing name,
    a null and a line that isn't a JSON object -> ``''``; numbers keep their JSON text (``3.0``
    stays ``3.0``); booleans print ``True``/``False``; arrays and objects print as JSON text.

    Names are matched as ``json_leaf_paths`` makes them, so every name it gives finds its
    values, whatever quotes or dots the keys hold.  Each record is parsed once for all columns."""
    names = list(paths)

    def rows(batches):
        for batch in batches:
            cells = {name: [] for name in names}
            for line in batch.column(0).to_pylist():
                got = {name: value for name, value in ((_cell(n), v) for n, v in _entries(_record(line))) if name in cells}
                for name in names:
                    cells[name].append(_cell(got.get(name)))
            yield pa.RecordBatch.from_arrays([pa.array(cells[n], pa.string()) for n in names], names)

    ship_package(json_lines.sparkSession)
    return json_lines.select(col).mapInArrow(rows, string_columns(names)) if names else json_lines.select()


def string_columns(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def json_to_csv(json_lines: DataFrame, root: str, col: str = "value") -> tuple[str, StructType]:
    """Write JSON lines as CSV with a header: a column for every leaf name of any record, in
    order of name.  Returns the folder and the schema to read it back with.

    Two passes over the lines, one for names and one for values; the driver holds the names.  Names
    that differ by case alone need ``spark.sql.caseSensitive`` (Spark refuses them otherwise)."""
    schema = string_columns(sorted(r.path for r in json_leaf_paths(json_lines, col).toLocalIterator()))
    return io.write_csv(json_flatten(json_lines, schema.names, col), root), schema
