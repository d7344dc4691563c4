"""Registered queries: profiling, ETL, nested records, literals, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import literals
from ..functions.scalars import r6
from ..operators import aggregates, etl, filters, ids, validation
from ..operators.common import materialize, scratch_dir
from ..sources import catalog, io
from . import base

CITY = "City_3"
PROFILE_COLUMNS = ["business_id", "name", "city", "latitude", "longitude", "is_open",
                   "review_count", "stars", "categories", "attr_NoiseLevel",
                   "attr_GoodForKids", "attr_Ambience"]


def q_rating_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = aggregates.rating_matrix(base.build(spark, sf_dir).triples)
    return m.select("uid", "iid", r6("rating").alias("rating"))


def q_matrix_sparsity(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = aggregates.matrix_sparsity(base.build(spark, sf_dir).triples)
    return s.select("n_users", "n_items", "n_cells", r6("sparsity").alias("sparsity"),
                    r6(F.col("sparsity") * 100).alias("sparsity_pct"))


def q_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.category_counts(catalog.business(spark, sf_dir))


def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = aggregates.null_profile(catalog.business(spark, sf_dir), PROFILE_COLUMNS)
    return p.select("column_name", "n_null", "n_nonnull", r6("frac_null").alias("frac_null"))


def q_filter_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_report(catalog.business(spark, sf_dir), base.KEYWORDS, base.MIN_REVIEWS)


def q_keyword_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter report of every keyword group by name: the fixed ones and the tables' own."""
    groups = filters.KEYWORD_GROUPS | {"parts": base.KEYWORDS}
    return filters.group_report(catalog.business(spark, sf_dir), groups, base.MIN_REVIEWS)


def q_city_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = filters.city_filter(catalog.business(spark, sf_dir), CITY)
    return b.select("business_id", "name", "city", "review_count", r6("stars").alias("stars"))


def q_stars_by_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = aggregates.stars_by_open(catalog.business(spark, sf_dir))
    return s.select(r6("stars_bin").alias("stars_bin"), "is_open", "n",
                    r6("avg_review_count").alias("avg_review_count"))


def q_geo_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = aggregates.geo_grid(catalog.business(spark, sf_dir))
    return g.select("lat_cell", "lon_cell", "n", r6("avg_stars").alias("avg_stars"))


def checkin_events_by_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = catalog.checkin_events(spark, sf_dir)
    return ev.withColumn("business_id", catalog.padded_key("b", "business_key"))


def q_checkin_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = etl.checkin_summary_from_events(checkin_events_by_business(spark, sf_dir),
                                        catalog.business(spark, sf_dir))
    # a count that is null for businesses without check-ins: reported as a double
    return s.select("business_id", F.col("checkin_total").cast("double").alias("checkin_total"),
                    "checkin_first", "checkin_last")


def _selected_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base.build(spark, sf_dir)
    return etl.semi_join(b.rating_rows, b.selected, "business_id")


def q_review_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected_reviews(spark, sf_dir).select("review_id", "user_id", "business_id", "stars")


def q_user_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = etl.semi_join(catalog.users(spark, sf_dir), _selected_reviews(spark, sf_dir), "user_id")
    return u.select("user_id", "name")


def q_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base.build(spark, sf_dir)
    return (b.umap.select(F.lit("user").alias("kind"), F.col("user_id").alias("raw_id"),
                          F.col("uid").alias("id"))
            .unionByName(b.imap.select(F.lit("item").alias("kind"),
                                       F.col("business_id").alias("raw_id"),
                                       F.col("iid").alias("id"))))


def q_string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rr = catalog.ratings(spark, sf_dir)
    u = ids.string_index(rr, "user_id", "idx").select(
        F.lit("user").alias("kind"), F.col("user_id").alias("raw_id"), "idx")
    i = ids.string_index(rr, "business_id", "idx").select(
        F.lit("item").alias("kind"), F.col("business_id").alias("raw_id"), "idx")
    return u.unionByName(i)


def _keyed_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base.build(spark, sf_dir)
    return materialize(ids.rating_triples(b.rating_rows, b.umap, b.imap, keep=("review_id",)), "keyed-triples")


def q_holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = validation.holdout_split(_keyed_triples(spark, sf_dir), "review_id", 80)
    return t.select("review_id", "uid", "iid", "split")


def q_fold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = validation.assign_folds(_keyed_triples(spark, sf_dir), "review_id", 5)
    return t.select("review_id", "uid", "iid", "fold")


def labelled_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.reviews(spark, sf_dir).where(F.col("stars").isNotNull())


def q_ordered_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = labelled_reviews(spark, sf_dir).select("review_id", "stars")
    s = validation.ordered_split(r, [F.col("review_id").asc()], 0.8)
    return s.select("review_id", "pos", "split")


# ----------------------------------------------------------------- nested records

def business_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The business table as nested records (the shape of the raw JSON lines)."""
    b = catalog.business(spark, sf_dir)
    return b.select(
        "business_id", "name",
        F.struct("city", "latitude", "longitude").alias("location"),
        F.round("stars", 2).alias("stars"), "review_count",
        (F.col("is_open") == 1).alias("is_open"),
        "attributes",
        F.split("categories", ", ").alias("categories"))


def business_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested JSON lines for the business table (``value`` column), built with
    ``to_json``; null fields are omitted, as in the raw records."""
    return business_records(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))


def q_json_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = business_json(spark, sf_dir).unionByName(
        catalog.table(spark, sf_dir, "events").select(F.col("props").alias("value")))
    return etl.json_leaf_paths(lines).select(F.col("path").alias("column_name"))


def q_json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-lines sink, then the dynamic-schema scan: raw lines, leaf-path
    discovery, one string column per path."""
    path = io.write_json_lines(business_records(spark, sf_dir), f"{scratch_dir(spark)}/json")
    lines = io.read_json_lines(spark, path)
    paths = sorted(r[0] for r in etl.json_leaf_paths(lines).collect())  # schema width only
    return etl.json_flatten(lines, paths)


def q_json_to_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON to CSV job: business records as JSON lines, written as CSV and read back."""
    path = io.write_json_lines(business_records(spark, sf_dir), f"{scratch_dir(spark)}/json")
    out, schema = etl.json_to_csv(io.read_json_lines(spark, path), f"{scratch_dir(spark)}/json-csv")
    return io.read_csv(spark, out, schema)


def q_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines read with the schema of business records: typed columns, only the named ones parsed."""
    records = business_records(spark, sf_dir)
    path = io.write_json_lines(records, f"{scratch_dir(spark)}/json")
    b = io.read_json_lines(spark, path, io.schema_of(records))
    return b.select("business_id", "name", F.col("location.city").alias("city"), "is_open", "review_count",
                    r6("stars").alias("stars"), F.size("categories").cast("double").alias("n_categories"))


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = catalog.business(spark, sf_dir).select("business_id", "name", "categories",
                                               "review_count", "stars")
    path = io.write_csv(b, f"{scratch_dir(spark)}/csv")
    back = io.read_csv(spark, path, io.schema_of(b))
    return back.select("business_id", "name", "categories", "review_count",
                       r6("stars").alias("stars"))


def q_literal_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = catalog.business(spark, sf_dir)
    return b.select("business_id",
                    literals.literal_scalar("attr_NoiseLevel").alias("NoiseLevel"),
                    literals.literal_scalar("attr_GoodForKids").alias("GoodForKids"))


def q_literal_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = catalog.business(spark, sf_dir)
    return b.select("business_id", F.explode(literals.literal_dict("attr_Ambience"))
                    .alias("key", "value"))


def q_byte_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rr = catalog.ratings(spark, sf_dir)
    w = rr.select("review_id", literals.wrap_bytes("user_id").alias("wrapped_user_id"),
                  "business_id")
    return w.select("review_id", "wrapped_user_id",
                    literals.unwrap_bytes("wrapped_user_id").alias("user_id"),
                    literals.unwrap_bytes("business_id").alias("business_id"))


__all__ = [n for n in dir() if n.startswith("q_")] + ["materialize"]
