"""Marketplace tables derived from a TPC-H style star schema.

Parts are listings, their lead supplier is the host, order lines are calendar days, and
returned or accepted lines are reviews.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.functions.numbers import money
from roomledger.plans.market import Market

# Column types of the tables, so that reading one starts no job.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "pages": "page_id bigint, url string, html string",
}

SUPERHOST_BALANCE = 5000
RESPONSE_TIMES = ("within an hour", "within a few hours", "within a day", "a few days or more")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("listing_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_linestatus") == "O").alias("available"),
        money("l_extendedprice").alias("price"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_returnflag") != "N")
        .select(
            F.col("l_partkey").alias("listing_id"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_shipdate").cast("date").alias("date"),
        )
    )


def _hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(
        "n_nationkey", "n_regionkey", F.col("n_name").alias("host_city")
    )
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("host_state")
    )
    response = F.element_at(
        F.array(*[F.lit(t) for t in RESPONSE_TIMES], F.lit(None)),
        (F.col("s_suppkey") % 5 + 1).cast("int"),
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, "n_regionkey")
        .select(
            F.col("s_suppkey").alias("host_id"),
            "host_city",
            "host_state",
            F.when(F.col("s_acctbal") > SUPERHOST_BALANCE, "t").otherwise("f").alias("host_is_superhost"),
            (F.col("s_nationkey") % 2 == 0).alias("host_identity_verified"),
            response.alias("host_response_time"),
        )
    )


def listings(spark: SparkSession, sf_dir: str, hosts: bool = True) -> DataFrame:
    """Listings; ``hosts=False`` leaves out the columns that need the host tables."""
    lead = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("id"))
        .agg(F.min("l_suppkey").alias("host_id"))
    )
    size = F.col("p_size").cast("double")
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("neighbourhood"),
        F.col("p_name").alias("property_type"),
        F.col("p_type").alias("room_type"),
        money("p_retailprice").alias("price"),
        F.col("p_size").alias("n_amenities"),
        F.when(F.col("p_size") % 17 != 0, size / 10).alias("review_scores_rating"),
        *[
            ((F.col("p_size") % modulus).cast("double") / 2).alias(f"review_scores_{score}")
            for score, modulus in (
                ("cleanliness", 7), ("checkin", 11), ("communication", 9), ("location", 8), ("value", 6),
            )
        ],
        (F.substring("p_brand", 7, 10).cast("int") % 6).alias("__group"),
    )
    groups = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("__group"), F.col("r_name").alias("neighbourhood_group")
    )
    result = parts.join(lead, "id").join(groups, "__group", "left").drop("__group")
    return result.join(_hosts(spark, sf_dir), "host_id") if hosts else result


def market(spark: SparkSession, sf_dir: str, hosts: bool = True) -> Market:
    return Market(
        listings(spark, sf_dir, hosts), calendar(spark, sf_dir), reviews(spark, sf_dir)
    )


def _price_text(cents: Column) -> Column:
    """Cents below a million dollars as ``$1,234.50``."""
    return F.concat(
        F.when(cents >= 100_000, F.concat(F.lit("$"), F.floor(cents / 100_000), F.lit(","))).otherwise("$"),
        F.when(cents >= 100_000, F.lpad(F.floor(cents / 100 % 1000).cast("string"), 3, "0")).otherwise(
            F.floor(cents / 100).cast("string")
        ),
        F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings as an export would hold them: text prices, flags, rates and lists."""
    key, size = F.col("id"), F.col("n_amenities")
    base = listings(spark, sf_dir)
    words = F.split("property_type", " ")
    flag = lambda modulus: (
        F.when(key % modulus == 0, F.lit(None)).when(key % 3 == 0, " f ").otherwise("t")
    )
    price = _price_text((F.col("price") * 200).cast("bigint") - size * 2000)
    return base.select(
        "id",
        "host_id",
        F.when(key % 10 == 0, F.lit(None)).when(key % 11 == 0, "N/A").otherwise(price).alias("price"),
        F.concat(F.lit(' A "'), "property_type", F.lit('"<br/>in '), "neighbourhood", F.lit("\r")).alias("description"),
        F.when(key % 4 == 0, "N/A").otherwise(F.concat(F.lit('near ""'), "host_city", F.lit('""'))).alias("neighborhood_overview"),
        F.when(key % 7 == 0, F.lit(None)).when(key % 5 == 0, F.col("host_city"))
        .otherwise(F.concat_ws(", ", "host_city", "host_state", "room_type")).alias("host_location"),
        F.when(key % 9 == 0, "[]").otherwise("['email', 'phone']").alias("host_verifications"),
        F.when(key % 13 == 0, F.lit(None)).when(key % 8 == 0, "[]")
        .when(key % 2 == 0, F.concat(F.lit("['"), F.concat_ws("', '", words), F.lit("']")))
        .otherwise(F.concat(F.lit('["'), F.concat_ws('", "', words), F.lit('", "TV, cable"]'))).alias("amenities"),
        flag(5).alias("has_availability"),
        flag(7).alias("host_has_profile_pic"),
        flag(11).alias("host_identity_verified"),
        flag(13).alias("instant_bookable"),
        F.when(key % 6 == 0, "N/A").otherwise(F.concat(size * 2, F.lit("%"))).alias("host_response_rate"),
        F.when(key % 5 == 0, F.lit(None)).otherwise(F.concat(size, F.lit(".5%"))).alias("host_acceptance_rate"),
        F.lit("about the area").alias("neighbourhood"),
        F.col("neighbourhood").alias("neighbourhood_cleansed"),
        F.col("neighbourhood_group").alias("neighbourhood_group_cleansed"),
        F.col("n_amenities").alias("minimum_nights"),
        F.lit(365).alias("maximum_nights"),
        F.lit(1.5).cast("float").alias("reviews_per_month"),
    )


def raw_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar days as an export would hold them."""
    day = F.col("l_linenumber")
    price = _price_text((money("l_extendedprice") * 100).cast("bigint") % 250_000)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("listing_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.when(day == 7, F.lit(None)).when(F.col("l_linestatus") == "O", "t").otherwise(" f").alias("available"),
        F.when(day == 6, F.lit(None)).otherwise(price).alias("price"),
        F.lit(None).cast("string").alias("adjusted_price"),
        F.col("l_quantity").cast("int").alias("minimum_nights"),
        F.lit(365).alias("maximum_nights"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as review comments, with text ids and dates."""
    page = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        page.cast("string").alias("listing_id"),
        (page * 3).cast("string").alias("id"),
        F.when(page % 9 == 0, "unknown")
        .otherwise(F.date_add(F.lit("2020-01-01").cast("date"), (page % 1000).cast("int")).cast("string"))
        .alias("date"),
        page.alias("reviewer_id"),
        F.col("url").alias("reviewer_name"),
        F.concat(F.lit('\r "'), "html").alias("comments"),
    )
