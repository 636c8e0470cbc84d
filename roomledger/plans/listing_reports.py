"""Reports on single listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.functions.numbers import mean_of, money, rounded, six_digits
from roomledger.operators.comparing import segment_compare
from roomledger.operators.joins import null_safe_join
from roomledger.operators.metrics import change_count, mean_price, occupancy, revenue
from roomledger.operators.quantiles import tercile_bin
from roomledger.operators.ranking import (
    asc,
    desc,
    global_dense_rank,
    rank_sum_bottom_k,
    top_n_per_group,
)
from roomledger.plans.market import Market, as_report

# Fixed values of the reports.
TOP_PRICED = 5
TOP_OCCUPIED = 10
TOP_REVIEWED = 10
TOP_CHANGING = 5
REVIEWS_TO_RANK = 20
REVIEWS_TO_SCORE = 10
LOWEST_LISTED = 10
DAYS_PER_YEAR = 365

# An occupancy rate is a percentage with two digits; a calendar spans far fewer months.
OCCUPANCY_VALUES = 10_001
MAX_MONTHS = 2_400


def _placed(top: DataFrame, places: DataFrame) -> DataFrame:
    """The winners with what is known of their listings.

    Null-safe, so that no filter of the join reaches the input of ``top``: it is read by two
    branches, and only if both are planned alike their shuffle runs once.
    """
    return null_safe_join(top, places.filter("listing_id IS NOT NULL"), ["listing_id"])


def _priced_and_reviewed(market: Market, grain: str) -> DataFrame:
    prices = market.totals_per_month(grain).select(
        "listing_id", "month", mean_price().alias("avg_price")
    )
    reviews = market.reviews_per_month(F.count_distinct("id").alias("n_reviews"), grain=grain)
    return prices.join(reviews, ["listing_id", "month"], "left").fillna(0, ["avg_price", "n_reviews"])


def top_listings_by_price(market: Market, month_grain: str = "name") -> DataFrame:
    """Listings with the five highest mean prices of each month, ties by review count.

    Every listing that shares a top value is kept.
    """
    top = top_n_per_group(
        _priced_and_reviewed(market, month_grain),
        ["month"],
        [desc("avg_price"), desc("n_reviews")],
        TOP_PRICED,
        max_groups=MAX_MONTHS,
    )
    places = market.listings.select(F.col("id").alias("listing_id"), "neighbourhood")
    found = _placed(top, places).withColumn("avg_price", six_digits("avg_price"))
    return as_report(
        found, "listing_id", "month", "avg_price", "n_reviews", "rnk", "neighbourhood"
    )


def top_listings_by_price_exact(market: Market, month_grain: str = "name") -> DataFrame:
    """Exactly five listings per month, remaining ties by listing id."""
    top = top_n_per_group(
        _priced_and_reviewed(market, month_grain),
        ["month"],
        [desc("avg_price"), desc("n_reviews"), asc("listing_id")],
        TOP_PRICED,
        method="row_number",
    )
    places = market.listings.select(F.col("id").alias("listing_id"), "neighbourhood")
    found = top.join(places, "listing_id").withColumn("avg_price", six_digits("avg_price"))
    return as_report(
        found, "listing_id", "month", "avg_price", "n_reviews", "rnk", "neighbourhood"
    )


def occupancy_per_month(market: Market, month_grain: str = "name") -> DataFrame:
    """Listings with the ten highest occupancy rates of each month, all ties kept."""
    rates = market.totals_per_month(month_grain).select(
        "listing_id", "month", occupancy().alias("occupancy_rate")
    )
    top = top_n_per_group(
        rates,
        ["month"],
        [desc("occupancy_rate")],
        TOP_OCCUPIED,
        max_groups=MAX_MONTHS,
    )
    places = market.listings.select(
        F.col("id").alias("listing_id"), "host_city", "host_state", "neighbourhood"
    )
    return as_report(
        _placed(top, places),
        "listing_id", "month", "occupancy_rate", "host_city", "host_state", "neighbourhood",
    )


def occupancy_per_month_exact(market: Market, month_grain: str = "name") -> DataFrame:
    """Exactly ten listings per month, ties by listing id, with the month's revenue."""
    rates = market.totals_per_month(month_grain).select(
        "listing_id", "month", occupancy().alias("occupancy_rate"), revenue().alias("monthly_revenue")
    )
    top = top_n_per_group(
        rates,
        ["month"],
        [desc("occupancy_rate"), asc("listing_id")],
        TOP_OCCUPIED,
        method="row_number",
    )
    places = market.listings.select(
        F.col("id").alias("listing_id"), "host_city", "host_state", "neighbourhood"
    )
    return as_report(
        top.join(places, "listing_id"),
        "listing_id", "month", "occupancy_rate", "monthly_revenue", "host_city", "host_state",
        "neighbourhood",
    )


def _monthly_counts_of_reviewed(market: Market, enough: Column, month_grain: str) -> DataFrame:
    """Monthly review counts of the listings whose ``total`` is enough."""
    # The total of a listing is the sum over its months, so reviews are read once.
    year = Window.partitionBy("listing_id")
    return (
        market.reviews_per_month(
            F.count("id").alias("review_count"), F.count(F.lit(1)).alias("__rows"), grain=month_grain
        )
        .withColumn("total", F.sum("__rows").over(year))
        .filter(enough)
        .select("listing_id", "month", "review_count")
    )


def most_reviewed_listings(market: Market, month_grain: str = "name") -> DataFrame:
    """The ten highest review counts of each month among listings with over 20 reviews."""
    top = top_n_per_group(
        _monthly_counts_of_reviewed(market, F.col("total") > REVIEWS_TO_RANK, month_grain),
        ["month"],
        [desc("review_count")],
        TOP_REVIEWED,
        max_groups=MAX_MONTHS,
    )
    places = market.listings.select(F.col("id").alias("listing_id"), "neighbourhood", "property_type")
    return _placed(top, places).select(
        "listing_id", "month", "review_count", "rnk", "neighbourhood", "property_type"
    )


def most_reviewed_listings_exact(market: Market, month_grain: str = "name") -> DataFrame:
    """Exactly ten listings per month among those with at least 20 reviews."""
    top = top_n_per_group(
        _monthly_counts_of_reviewed(market, F.col("total") >= REVIEWS_TO_RANK, month_grain),
        ["month"],
        [desc("review_count"), asc("listing_id")],
        TOP_REVIEWED,
        method="row_number",
    )
    places = market.listings.select(F.col("id").alias("listing_id"), "neighbourhood", "property_type")
    return top.join(places, "listing_id").select(
        "listing_id", "month", "review_count", "rnk", "neighbourhood", "property_type"
    )


def _lowest(market: Market) -> DataFrame:
    reviewed = market.reviews_per_listing().filter(F.col("n_reviews") >= REVIEWS_TO_SCORE)
    rates = market.occupancy_per_listing()
    places = market.listings.select(
        F.col("id").alias("listing_id"), "review_scores_rating", "neighbourhood", "host_id"
    )
    candidates = (
        places.join(reviewed, "listing_id", "left_semi")
        .join(rates, "listing_id")
        # Seven digits tell apart any two single-precision scores from 0 to 5.
        .withColumn("__rating", F.col("review_scores_rating").cast("decimal(18,7)"))
    )
    return rank_sum_bottom_k(
        candidates,
        [asc("occupancy_rate", OCCUPANCY_VALUES), asc("__rating")],
        LOWEST_LISTED,
        ["listing_id"],
    )


def lowest_occupancy_and_scores(market: Market) -> DataFrame:
    """Ten listings with the lowest occupancy and rating ranks taken together."""
    return as_report(
        _lowest(market), "review_scores_rating", "neighbourhood", "host_id", "occupancy_rate"
    )


def lowest_occupancy_and_scores_with_id(market: Market) -> DataFrame:
    """The same listings with their ids."""
    return as_report(
        _lowest(market),
        "listing_id", "review_scores_rating", "neighbourhood", "host_id", "occupancy_rate",
    )


def review_distribution(market: Market) -> DataFrame:
    """Review count of every listing and its rank among all listings."""
    counts = market.reviews_per_listing()
    places = market.listings.select(
        F.col("id").alias("listing_id"), "neighbourhood", "review_scores_rating", "neighbourhood_group"
    )
    ranked = global_dense_rank(counts.join(places, "listing_id"), [desc("n_reviews")])
    return ranked.select(
        "listing_id", "n_reviews", "neighbourhood", "review_scores_rating", "neighbourhood_group", "rnk"
    )


# The score columns of the price-bin report and their output names.
BIN_SCORES = ("rating", "cleanliness", "checkin", "communication", "location")


def _priced_listings(market: Market) -> tuple[DataFrame, DataFrame]:
    totals = market.totals_per_listing().select(
        "listing_id", mean_price().alias("avg_price"), occupancy().alias("occupancy_rate")
    )
    scores = market.listings.select(
        F.col("id").alias("listing_id"), *[f"review_scores_{s}" for s in BIN_SCORES]
    )
    return totals, scores


def listing_stats_by_price(market: Market) -> DataFrame:
    """Occupancy and scores of the listings that share a mean calendar price."""
    totals, scores = _priced_listings(market)
    means = {"avg_occupancy_rate": "occupancy_rate"}
    means |= {f"average_review_score_{s}": f"review_scores_{s}" for s in BIN_SCORES}
    stats = segment_compare(totals.join(scores, "listing_id"), "avg_price", means)
    return as_report(stats.withColumn("avg_price", six_digits("avg_price")), "avg_price", *means)


def listing_stats_by_price_bin(market: Market) -> DataFrame:
    """Number of listings, occupancy and scores of the three price bins."""
    totals, scores = _priced_listings(market)
    binned = tercile_bin(totals.withColumn("avg_price", six_digits("avg_price")), "avg_price", "avg_price_bin")
    means = {"avg_occupancy_rate": "occupancy_rate"}
    means |= {f"average_review_score_{s}": f"review_scores_{s}" for s in BIN_SCORES}
    stats = segment_compare(
        binned.join(scores, "listing_id"), "avg_price_bin", means, counts={"n_listings": "listing_id"}
    )
    return as_report(stats, "avg_price_bin", "n_listings", *means)


def _price_changes(market: Market, days: Column) -> DataFrame:
    calendar = market.calendar.withColumn("price", money("price"))
    changes = change_count(calendar, "listing_id", "date", "price", "n_price_changes")
    return changes.filter(F.col("n_price_changes") > 0).select(
        "listing_id",
        "n_price_changes",
        rounded(F.col("n_price_changes") / days * 100, 0).alias("pct_of_daily_price_diffs"),
        rounded(mean_of("value_sum", "n_values")).alias("avg_price"),
    )


def daily_price_changes(market: Market) -> DataFrame:
    """Listings with the five highest numbers of price changes, all ties kept."""
    changes = _price_changes(market, F.lit(DAYS_PER_YEAR))
    top = top_n_per_group(changes, [], [desc("n_price_changes")], TOP_CHANGING).drop("rnk")
    places = market.listings.select(
        "id", F.col("id").alias("listing_id"), "neighbourhood", "review_scores_rating"
    )
    return as_report(
        _placed(top, places),
        "listing_id", "n_price_changes", "pct_of_daily_price_diffs", "avg_price", "id",
        "neighbourhood", "review_scores_rating",
    )


def daily_price_changes_exact(market: Market) -> DataFrame:
    """Exactly five listings, with changes relative to the days on record."""
    top = top_n_per_group(
        _price_changes(market, F.col("n_rows")),
        [],
        [desc("n_price_changes"), asc("listing_id")],
        TOP_CHANGING,
        method="row_number",
    )
    places = market.listings.select(F.col("id").alias("listing_id"), "neighbourhood", "review_scores_rating")
    return as_report(
        top.join(places, "listing_id"),
        "listing_id", "n_price_changes", "pct_of_daily_price_diffs", "avg_price", "rnk",
        "neighbourhood", "review_scores_rating",
    )
