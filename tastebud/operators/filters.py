"""Business selection: category keywords, minimum review count, city, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import has_any_category

# Keyword groups for the category filter.
KEYWORD_GROUPS = {
    "restaurants": ["Restaurants", "Food"],
    "automotive": ["Automotive"],
    "shopping": ["Shopping"],
}
DEFAULT_MIN_REVIEWS = 5


def keywords_of(group: str | Sequence[str]) -> list[str]:
    """The keywords of a group by name, or the given keywords themselves."""
    if not isinstance(group, str):
        return list(group)
    if group not in KEYWORD_GROUPS:
        raise ValueError(f"unknown keyword group {group!r}; known: {', '.join(sorted(KEYWORD_GROUPS))}")
    return KEYWORD_GROUPS[group]


def category_filter(business: DataFrame, keywords: str | Sequence[str],
                    min_reviews: int | None = DEFAULT_MIN_REVIEWS) -> DataFrame:
    """Businesses with any keyword category and strictly more than ``min_reviews`` reviews;
    ``keywords`` are a list or the name of a keyword group."""
    cond = has_any_category("categories", keywords_of(keywords))
    if min_reviews is not None:
        cond = cond & (F.col("review_count") > F.lit(min_reviews))
    return business.filter(cond)


def filter_report(business: DataFrame, keywords: Sequence[str], min_reviews: int) -> DataFrame:
    """"Select x out of y businesses": counts before and after each filter, one pass."""
    in_cat = has_any_category("categories", keywords)
    return business.agg(
        F.count(F.lit(1)).alias("n_business"),
        F.count_if(in_cat).alias("n_category"),
        F.count_if(in_cat & (F.col("review_count") > F.lit(min_reviews))).alias("n_selected"),
    )


def group_report(business: DataFrame, groups: Mapping[str, Sequence[str]], min_reviews: int) -> DataFrame:
    """``(group_name, n_category, n_selected)`` of every keyword group, in one pass over the businesses."""
    enough = F.col("review_count") > F.lit(min_reviews)
    counts = business.agg(*[F.struct(
        F.lit(name).alias("group_name"), F.count_if(has_any_category("categories", words)).alias("n_category"),
        F.count_if(has_any_category("categories", words) & enough).alias("n_selected")).alias(f"g{i}")
        for i, (name, words) in enumerate(sorted(groups.items()))])
    return counts.select(F.inline(F.array(*counts.columns)))


def city_filter(business: DataFrame, city: str) -> DataFrame:
    return business.filter(F.col("city") == F.lit(city))
