"""Named tables and the adapter views over the driver's parquet tables.

The recommender works on five logical tables (ratings, business, reviews,
users, check-ins).  ``catalog`` reads the driver's parquet tables with column
pruning left to Catalyst and derives those views declaratively, so every query
that uses them reads the full input and grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table (pushdown and pruning happen at planning time)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def padded_key(prefix: str, c: str) -> Column:
    """Prefix and key, padded to 7 digits; a longer key stays whole."""
    text = F.col(c).cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(7), F.length(text)), F.lit("0")))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating rows ``(uid, iid, stars, user_id, business_id, review_id, l_orderkey, l_linenumber)``.

    One rating per line item: the customer of the order rates the part.
    Duplicate (user, item) pairs are kept, as in a review table.
    """
    return rating_keys(rating_numbers(spark, sf_dir))


def rating_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``lineitem`` and ``orders`` that make up a rating, joined."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity",
                                                   "l_linenumber")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).drop("o_orderkey")


def rating_keys(numbers: DataFrame) -> DataFrame:
    """:func:`ratings` of the rows of :func:`rating_numbers`."""
    return (numbers
            .select(F.col("o_custkey").alias("uid"),
                    F.col("l_partkey").alias("iid"),
                    (F.lit(1) + F.col("l_quantity").cast("int") % 5).cast("double").alias("stars"),
                    padded_key("u", "o_custkey").alias("user_id"),
                    padded_key("b", "l_partkey").alias("business_id"),
                    F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                F.col("l_linenumber").cast("string")).alias("review_id"),
                    "l_orderkey", "l_linenumber"))


def item_rating_stats(r: DataFrame) -> DataFrame:
    """``(k, review_count, stars)`` per item: partial aggregation before the shuffle."""
    return r.groupBy(F.col("iid").alias("k")).agg(
        F.count(F.lit(1)).alias("review_count"), F.avg("stars").alias("stars"))


def business(spark: SparkSession, sf_dir: str, rating_rows: DataFrame | None = None) -> DataFrame:
    """Business table derived from ``part`` plus rating statistics.

    ``attributes`` is a map of Python-literal strings, ``categories`` a
    ``", "``-separated string, as in the raw business records.
    """
    r = rating_rows if rating_rows is not None else ratings(spark, sf_dir)
    stats = item_rating_stats(r)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    b = part.join(stats, part.p_partkey == stats.k, "left")
    q = "chr(39)"
    noise = F.expr(
        f"CASE WHEN p_size % 5 = 0 THEN NULL ELSE concat('u', {q}, "
        "CASE p_size % 4 WHEN 0 THEN 'loud' WHEN 1 THEN 'quiet' ELSE 'average' END, "
        f"{q}) END")
    kids = F.expr("CASE p_size % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' ELSE 'None' END")
    ambience = F.expr(
        "CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 7 = 1 THEN 'None' ELSE concat("
        f"'{{', {q}, 'romantic', {q}, ': ', "
        "CASE WHEN p_partkey % 2 = 0 THEN 'True' ELSE 'False' END, "
        f"', u', {q}, 'casual', {q}, ': ', "
        "CASE WHEN p_partkey % 3 = 0 THEN 'True' ELSE 'False' END, '}') END")
    return b.select(
        padded_key("b", "p_partkey").alias("business_id"),
        F.col("p_partkey").alias("iid"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("City_"), (F.col("p_partkey") % 5).cast("string")).alias("city"),
        # double arithmetic (as in the SQL oracle), so grid cells agree exactly
        (F.lit(40.0) + (F.col("p_partkey") % 100).cast("double") / F.lit(200.0)).alias("latitude"),
        (F.lit(-80.0) + (F.col("p_partkey") % 70).cast("double") / F.lit(100.0)).alias("longitude"),
        F.when(F.col("p_size") % 4 == 0, 0).otherwise(1).alias("is_open"),
        F.coalesce(F.col("review_count"), F.lit(0).cast("long")).alias("review_count"),
        F.col("stars"),
        F.when(F.col("p_size") % 11 == 0, F.lit(None).cast("string")).otherwise(
            F.concat_ws(", ", "p_type", F.split_part("p_name", F.lit(" "), F.lit(2)), "p_brand")
        ).alias("categories"),
        noise.alias("attr_NoiseLevel"),
        kids.alias("attr_GoodForKids"),
        ambience.alias("attr_Ambience"),
    ).withColumn(
        "attributes",
        F.map_filter(F.create_map(F.lit("NoiseLevel"), F.col("attr_NoiseLevel"),
                                  F.lit("GoodForKids"), F.col("attr_GoodForKids"),
                                  F.lit("Ambience"), F.col("attr_Ambience")),
                     lambda k, v: v.isNotNull()))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review texts ``(review_id, business_id, lang, text, stars)``; stars null when unlabelled."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (d.join(lab, "doc_id", "left")
            .select(F.col("doc_id").alias("review_id"), F.col("source").alias("business_id"),
                    "lang", "text",
                    (F.lit(1) + F.lit(4) * F.col("quality")).cast("double").alias("stars")))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return c.select(padded_key("u", "c_custkey").alias("user_id"),
                    F.col("c_custkey").alias("uid"), F.col("c_name").alias("name"))


def checkin_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check-in events ``(business_key, ts, event_id, date)``, one row per check-in."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return ev.select(F.col("user_id").alias("business_key"), "ts", "event_id",
                     F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"))
