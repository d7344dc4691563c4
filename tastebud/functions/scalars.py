"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from built-in functions, so it runs
inside whole-stage codegen with no Python on the row path.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
CATEGORY_SEP = ", "                 # categories are split on exactly comma + blank
LIKE_THRESHOLD = 2.9                # content profile weight max(stars - 2.9, 0)
NORM_FLOOR = 0.01                   # item norm floor in the content score
RATING_MIN, RATING_MAX = 1.0, 5.0   # prediction clip range


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_categories(c: str | Column) -> Column:
    """``"a, b,c"`` -> ``["a", "b,c"]``; null stays null."""
    return F.split(col_of(c), CATEGORY_SEP)


def has_any_category(c: str | Column, keywords: Iterable[str]) -> Column:
    """True when any ``", "``-separated category is a keyword; null -> False."""
    kw = F.array(*[F.lit(k) for k in keywords])
    return F.coalesce(F.arrays_overlap(split_categories(c), kw), F.lit(False))


def clip_rating(c: str | Column, lo: float = RATING_MIN, hi: float = RATING_MAX) -> Column:
    return F.greatest(F.least(col_of(c), F.lit(hi)), F.lit(lo))


def like_weight(stars: str | Column, threshold: float = LIKE_THRESHOLD) -> Column:
    return F.greatest(col_of(stars) - F.lit(threshold), F.lit(0.0))


def md5_bucket(key: str | Column, buckets: int) -> Column:
    """Deterministic bucket in ``[0, buckets)`` from the first 32 bits of md5(key).

    The same integer is ``CAST('0x' || substr(md5(k), 1, 8) AS UBIGINT)`` in
    DuckDB, so splits and folds are reproducible across engines.
    """
    h = F.conv(F.substring(F.md5(col_of(key).cast("string")), 1, 8), 16, 10).cast("long")
    return (h % F.lit(buckets)).cast("int")


def r6(c: str | Column) -> Column:
    """Round a double to 6 places and erase negative zero (output hygiene)."""
    return F.round(col_of(c).cast("double"), 6) + F.lit(0.0)
