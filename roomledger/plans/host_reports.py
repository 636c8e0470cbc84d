"""Reports on hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.functions.numbers import mean_money, mean_of, money, rounded
from roomledger.operators.comparing import few_values, segment_compare
from roomledger.operators.joins import null_safe_join, split_join
from roomledger.operators.metrics import occupancy, revenue
from roomledger.operators.quantiles import exact_median, fixed_bin
from roomledger.operators.ranking import asc, desc, global_dense_rank, top_n_per_group
from roomledger.operators.sketches import merged_distinct_sketch, sketched_count
from roomledger.plans.market import Market, as_report

# Fixed values of the reports.
TOP_HOSTS = 5
HOST_TIERS = {"Small": (1, 5), "Medium": (6, 15)}
LARGEST_TIER = "Large"


def _host_listing_prices(market: Market) -> DataFrame:
    """Listings per host, and the mean price of those that have a calendar."""
    in_calendar = market.totals_per_listing().selectExpr("listing_id", "TRUE AS __listed")
    listings = market.listings.select(
        "host_id", F.col("id").alias("listing_id"), money("price").alias("price")
    )
    listed = F.col("__listed")
    return (
        listings.join(in_calendar, "listing_id", "left")
        .groupBy("host_id")
        .agg(
            F.count_distinct("listing_id").alias("n_properties"),
            rounded(mean_money(F.when(listed, F.col("price")))).alias("avg_price"),
            F.count_if(listed).alias("__n_listed"),
        )
    )


def top_host_averages(market: Market) -> DataFrame:
    """Mean listing price of the hosts with the five highest listing counts, ties kept."""
    hosts = _host_listing_prices(market)
    top = top_n_per_group(hosts, [], [desc("n_properties")], TOP_HOSTS)
    kept = top.filter(F.col("host_id").isNotNull() & (F.col("__n_listed") > 0))
    return as_report(kept, "host_id", "avg_price")


def top_host_averages_exact(market: Market) -> DataFrame:
    """Exactly five hosts, with their number of listings; ties by host id."""
    hosts = _host_listing_prices(market).filter(F.col("host_id").isNotNull())
    top = top_n_per_group(
        hosts, [], [desc("n_properties"), asc("host_id")], TOP_HOSTS, method="row_number"
    )
    return as_report(top, "host_id", "n_properties", "avg_price")


def most_diverse_hosts(market: Market) -> DataFrame:
    """Listings per property type of the five hosts with most types, ties by host id."""
    listings = market.listings.select("host_id", "property_type")
    hosts = (
        listings.groupBy("host_id")
        .agg(F.count_distinct("property_type").alias("__types"))
        .orderBy(F.desc("__types"), "host_id")
        .limit(TOP_HOSTS)
        .select("host_id")
    )
    return (
        listings.join(F.broadcast(hosts), "host_id")
        .groupBy("host_id", "property_type")
        .agg(F.count("property_type").alias("n_properties"))
    )


# The scores compared between superhosts and others.
SUPERHOST_SCORES = ("rating", "cleanliness", "communication", "value")


def superhosts_and_others(market: Market) -> DataFrame:
    """Scores, occupancy and prices of superhost listings next to the others."""
    listings = market.listings.select(
        "id", "host_is_superhost", money("price").alias("price"),
        *[f"review_scores_{s}" for s in SUPERHOST_SCORES],
    )
    rates = market.occupancy_per_listing()
    joined = listings.join(rates, F.col("id") == F.col("listing_id"))
    means = {f"avg_review_score_{s}": f"review_scores_{s}" for s in SUPERHOST_SCORES}
    means |= {"avg_occupancy_rate": "occupancy_rate", "avg_price": "price"}
    stats = segment_compare(joined, "host_is_superhost", means, counts={"n_listings": "listing_id"})
    medians = exact_median(joined, "price", "median_price", ["host_is_superhost"]).withColumn(
        "median_price", rounded("median_price")
    )
    return as_report(
        null_safe_join(stats, medians, ["host_is_superhost"], "left"),
        "host_is_superhost", *means, "median_price", "n_listings",
    )


def _responding_listings(market: Market) -> DataFrame:
    listings = market.listings.filter(F.col("host_response_time").isNotNull()).select(
        F.col("id").alias("listing_id"), "host_response_time", "review_scores_rating"
    )
    return listings.join(market.occupancy_per_listing(), "listing_id")


def _response_stats(market: Market, weight: str | None, sketched: bool = False) -> DataFrame:
    rated = _responding_listings(market)
    # Counted once: for the weights, and to find the listings whose reviews are split.
    known = F.col("listing_id").isNotNull()
    counts = market.reviews_per_listing(sketched).filter(known)
    means = {"avg_occupancy_rate": "occupancy_rate", "avg_review_score_rating": "review_scores_rating"}
    ids = sketched_count(merged_distinct_sketch("review_ids"))
    stats = segment_compare(
        rated.join(counts, "listing_id", "inner" if weight else "left"),
        "host_response_time",
        means,
        weight=weight,
        counts={"n_properties": "listing_id"},
        also={"n_reviews": ids} if sketched else None,
    )
    if not sketched:
        reviews = _reviews_per_response(market, rated, counts, known)
        stats = stats.join(reviews, "host_response_time", "left")
    return as_report(
        stats.fillna(0, ["n_reviews"]), "host_response_time", *means, "n_properties", "n_reviews"
    )


def _reviews_per_response(market: Market, rated: DataFrame, counts: DataFrame, known: Column) -> DataFrame:
    """Different review ids need the reviews themselves; a listing may own very many."""
    segments = rated.groupBy("listing_id").agg(
        F.collect_set("host_response_time").alias("__segments")
    )
    reviews = market.reviews.filter(known).select("listing_id", "id")
    counts = counts.withColumnRenamed("n_reviews", "__n")
    return (
        split_join(reviews, segments, ["listing_id"], counts=counts)
        .select(F.explode("__segments").alias("host_response_time"), "id")
        .groupBy("host_response_time")
        .agg(F.count_distinct("id").alias("n_reviews"))
    )


def host_response_stats(market: Market) -> DataFrame:
    """Occupancy and rating by response time, each listing counted once per review."""
    return _response_stats(market, weight="n_reviews")


def host_response_stats_sketched(market: Market) -> DataFrame:
    """The same with ``n_reviews`` merged from sketches, one of bounded size per listing.

    The reviews are read once, or not at all if the listings' sketches have been prepared. The
    count is within ``DISTINCT_ERROR`` of the exact one; all other columns are exact.
    """
    return _response_stats(market, weight="n_reviews", sketched=True)


def host_response_stats_per_listing(market: Market) -> DataFrame:
    """Occupancy and rating by response time, each listing counted once."""
    return _response_stats(market, weight=None)


def verification_performance(market: Market, month_grain: str = "name") -> DataFrame:
    """Monthly occupancy, revenue and bookings of every host and whether it is verified."""
    monthly = market.totals_per_month(month_grain).withColumns(
        {"occupancy_rate": occupancy(), "revenue": revenue()}
    )
    per_listing = monthly.groupBy("listing_id").agg(
        F.sum("occupancy_rate").alias("__occupancy"),
        F.sum("revenue").alias("__revenue"),
        F.count("revenue").alias("__revenue_months"),
        F.sum("n_booked").alias("__bookings"),
        F.count(F.lit(1)).alias("__months"),
    )
    listings = market.listings.select("id", "host_id", "host_identity_verified", "review_scores_rating")
    zero = F.lit(0).cast("decimal(18,2)")
    hosts = (
        listings.filter(F.col("host_id").isNotNull())
        .join(per_listing, F.col("id") == F.col("listing_id"), "left")
        .groupBy("host_id")
        .agg(
            F.when(F.bool_or("host_identity_verified"), "Verified")
            .otherwise("Not Verified")
            .alias("is_verified"),
            rounded(mean_of(F.sum("__occupancy"), F.sum("__months")), 0).alias("avg_monthly_occ_rate"),
            rounded(
                F.coalesce(mean_of(F.sum("__revenue"), F.sum("__revenue_months")), zero)
            ).alias("avg_monthly_revenue"),
            rounded(mean_of(F.sum("__bookings"), F.sum("__months")), 0).alias("average_monthly_bookings"),
            F.coalesce(rounded(F.avg("review_scores_rating")), zero).alias("avg_review_score_rating"),
            F.sum("__months").alias("__months"),
        )
        .filter(F.col("__months") > 0)
    )
    return as_report(
        hosts,
        "host_id", "is_verified", "avg_monthly_occ_rate", "avg_monthly_revenue",
        "average_monthly_bookings", "avg_review_score_rating",
    )


def _tiered_hosts(market: Market) -> DataFrame:
    per_listing = market.totals_per_listing().select(
        "listing_id", revenue().alias("revenue"), occupancy().alias("occupancy_rate")
    )
    zero = F.lit(0).cast("decimal(18,2)")
    return (
        market.listings.filter(F.col("host_id").isNotNull())
        .select("id", "host_id", "review_scores_rating", "room_type", "property_type", "neighbourhood")
        .join(per_listing, F.col("id") == F.col("listing_id"), "left")
        .groupBy("host_id")
        .agg(
            F.count_distinct("id").alias("n_properties"),
            F.coalesce(rounded(F.avg("review_scores_rating")), zero).alias("avg_review_score_rating"),
            few_values("room_type").cast("long").alias("n_room_types"),
            few_values("property_type").cast("long").alias("n_property_types"),
            few_values("neighbourhood").cast("long").alias("n_neighbourhoods"),
            F.sum("revenue").alias("total_revenue"),
            rounded(F.avg("occupancy_rate")).alias("avg_occupancy_rate"),
            F.count("listing_id").alias("__listed"),
        )
        .filter(F.col("__listed") > 0)
        .withColumn("n_listings_bin", fixed_bin("n_properties", HOST_TIERS, LARGEST_TIER))
    )


TIER_ORDER = (desc("total_revenue"), desc("n_properties"))
TIER_COLUMNS = (
    "host_id", "n_properties", "avg_review_score_rating", "n_room_types", "n_property_types",
    "n_neighbourhoods", "n_listings_bin", "total_revenue", "avg_occupancy_rate", "rnk",
)


def host_tier_revenue(market: Market) -> DataFrame:
    """Every host with its size tier, revenue and diversity, ranked by revenue."""
    hosts = _tiered_hosts(market)
    return as_report(global_dense_rank(hosts, TIER_ORDER), *TIER_COLUMNS)


def host_tier_revenue_within_tier(market: Market) -> DataFrame:
    """The same with the rank counted within the tier."""
    hosts = _tiered_hosts(market)
    ranked = global_dense_rank(hosts, TIER_ORDER, by=["n_listings_bin"])
    return as_report(ranked, *TIER_COLUMNS)
