"""Normalisers for Python-literal strings found in raw business records.

Attribute values arrive as the text of Python literals: ``u'casual'``,
``'quiet'``, ``True``, ``None`` or a dict such as
``{'romantic': False, u'casual': True}``.  These functions turn them into plain
strings and ``map<string,string>`` with native regular expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col_of

# Fixed patterns.
# A scalar literal wrapped in quotes, with an optional u prefix.
SCALAR_QUOTED = r"^u?(['\"])(.*)\1$"
# One key/value pair of a dict literal: key in group 1 or 2, value in group
# 3 or 4 (quoted) or 5 (bare word: True, False, None or a number).
DICT_PAIR = (r"u?(?:\"([^\"]*)\"|'([^']*)')\s*:\s*"
             r"(?:u?\"([^\"]*)\"|u?'([^']*)'|([A-Za-z0-9_.+-]+))")
# Byte-string repr: b'abc' or b"abc".
BYTES_WRAPPED = r"^b(['\"])(.*)\1$"


def literal_scalar(c: str | Column) -> Column:
    """``str(literal_eval(x))`` for scalar literals: quotes and ``u`` prefix removed.

    Bare words (``True``, ``False``, ``None``, numbers) are kept as written;
    null stays null.
    """
    return F.regexp_replace(col_of(c), SCALAR_QUOTED, "$2")


def _pairs_group(c: Column, g: int) -> Column:
    return F.regexp_extract_all(c, F.lit(DICT_PAIR), F.lit(g))


def literal_dict_entries(c: str | Column) -> Column:
    """Array of ``struct(key, value, quoted)`` for a dict literal.

    ``quoted`` is true when the value was a quoted string (so ``'True'`` is
    text while bare ``True`` is a boolean).  Null, ``None`` or a non-dict give
    an empty array.
    """
    x = F.coalesce(col_of(c), F.lit(""))
    k1, k2 = _pairs_group(x, 1), _pairs_group(x, 2)
    v3, v4, v5 = _pairs_group(x, 3), _pairs_group(x, 4), _pairs_group(x, 5)
    entries = F.arrays_zip(k1.alias("k1"), k2.alias("k2"), v3.alias("v3"),
                           v4.alias("v4"), v5.alias("v5"))
    return F.transform(entries, lambda e: F.struct(
        F.when(e["k1"] != "", e["k1"]).otherwise(e["k2"]).alias("key"),
        F.when(e["v5"] != "", e["v5"]).when(e["v3"] != "", e["v3"]).otherwise(e["v4"]).alias("value"),
        (e["v5"] == "").alias("quoted")))


def literal_dict(c: str | Column) -> Column:
    """``literal_eval`` of a dict literal as ``map<string,string>``; null/None -> empty map.
    Of a repeated key the last value counts."""
    pairs = F.transform(literal_dict_entries(c), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    keys = F.array_distinct(F.transform(pairs, lambda e: e["key"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(
        k, F.element_at(F.filter(pairs, lambda e: e["key"] == k), -1)["value"])))


def unwrap_bytes(c: str | Column) -> Column:
    """``b'abc'`` -> ``abc``; values without the wrapper pass unchanged."""
    return F.regexp_replace(col_of(c), BYTES_WRAPPED, "$2")


def wrap_bytes(c: str | Column) -> Column:
    """``abc`` -> ``b'abc'`` (the repr of the utf-8 encoded value)."""
    return F.concat(F.lit("b'"), col_of(c), F.lit("'"))
