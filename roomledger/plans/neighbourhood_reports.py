"""Reports on neighbourhoods, room types and property types."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomledger.functions.dates import season_of
from roomledger.functions.numbers import mean_money, mean_of, money, percent, rounded
from roomledger.operators.comparing import (
    deviation_from_mean,
    diff_from_reference_group,
    few_values,
    segment_compare,
    spread_by_group,
    weighted_score_ratio,
)
from roomledger.operators.joins import null_safe_join
from roomledger.operators.metrics import calendar_totals, mean_price, occupancy, revenue
from roomledger.operators.quantiles import quantile_bin, tercile_bin
from roomledger.operators.ranking import desc, global_dense_rank
from roomledger.plans.market import Market, as_report

# Fixed values of the reports.
MONTHS_PER_YEAR = 12
SCORE_WEIGHTS = {"avg_review_score_rating": "0.6", "avg_occupancy_rate": "0.4"}
GROUP_SCORES = ("rating", "cleanliness", "checkin", "communication")


def average_price(market: Market) -> DataFrame:
    """Mean listing price per neighbourhood, highest first."""
    prices = market.listings.groupBy("neighbourhood").agg(
        rounded(mean_money("price")).alias("average_price")
    )
    return as_report(prices, "neighbourhood", "average_price").orderBy(F.desc("average_price"))


def _is_superhost():
    return F.coalesce(F.col("host_is_superhost").try_cast("boolean"), F.lit(False))


def _active_hosts(market: Market) -> DataFrame:
    """Hosts and listings per neighbourhood; superhosts as listings and as hosts.

    Grouped by host first, so that the hosts are counted by rows.
    """
    listings = market.listings.select("neighbourhood", "host_id", "id", _is_superhost().alias("__super"))
    hosts = (
        listings.groupBy("neighbourhood", "host_id")
        .agg(F.count_if("__super").alias("__super"))
        .groupBy("neighbourhood")
        .agg(
            F.count("host_id").alias("n_hosts"),
            F.sum("__super").alias("__superhost_listings"),
            F.count_if((F.col("__super") > 0) & F.col("host_id").isNotNull()).alias("__superhosts"),
        )
    )
    ids = listings.groupBy("neighbourhood").agg(F.count_distinct("id").alias("n_properties"))
    return null_safe_join(hosts, ids, ["neighbourhood"])


def _with_shares(counts: DataFrame, superhosts: str) -> DataFrame:
    shares = counts.withColumns(
        {
            "percentage_of_superhosts": percent(F.col(superhosts), F.col("n_hosts")),
            "average_properties_per_host": rounded(F.try_divide("n_properties", "n_hosts")),
        }
    )
    return as_report(
        shares,
        "neighbourhood", "n_hosts", "n_properties", "percentage_of_superhosts",
        "average_properties_per_host",
    )


def most_active_hosts(market: Market) -> DataFrame:
    """Hosts and listings per neighbourhood, and superhost listings per 100 hosts."""
    return _with_shares(_active_hosts(market), "__superhost_listings")


def most_active_hosts_by_host(market: Market) -> DataFrame:
    """The same with the share of hosts that are superhosts, most hosts first."""
    shares = _with_shares(_active_hosts(market), "__superhosts")
    return shares.orderBy(F.desc("n_hosts"), "neighbourhood")


def _monthly_revenue(market: Market, month_grain: str = "name") -> DataFrame:
    """Booked revenue per neighbourhood and month."""
    booked = market.totals_per_month(month_grain).filter("n_booked > 0")
    places = market.listings.filter(F.col("neighbourhood").isNotNull()).select("id", "neighbourhood")
    return (
        booked.join(places, F.col("listing_id") == F.col("id"))
        .groupBy("neighbourhood", "month")
        .agg(F.sum("booked_price_sum").alias("total_revenue"))
    )


def monthly_revenue(market: Market, month_grain: str = "name") -> DataFrame:
    """Revenue per neighbourhood and month with the neighbourhood's variance figure.

    The figure is the squared gap between the sum and the mean of the monthly revenues,
    divided by twelve.
    """
    year = Window.partitionBy("neighbourhood")
    revenue = F.col("total_revenue").cast("double")
    total = F.sum("total_revenue").over(year).cast("double")
    mean = total / F.count("total_revenue").over(year)
    return (
        _monthly_revenue(market, month_grain)
        .withColumn("__gap", total - mean)
        .select(
            "neighbourhood",
            "month",
            revenue.alias("total_revenue"),
            F.round(F.col("__gap") * F.col("__gap") / MONTHS_PER_YEAR, 2).alias("yearly_variance"),
        )
    )


def monthly_revenue_deviation(market: Market, month_grain: str = "name") -> DataFrame:
    """Revenue per neighbourhood and month, its distance from the neighbourhood's mean
    month, and the variance of the months."""
    year = Window.partitionBy("neighbourhood")
    months = F.count("total_revenue").over(year)
    cents = (F.col("total_revenue") * 100).cast("decimal(18,0)")
    squares = F.sum((cents * cents).cast("decimal(38,0)")).over(year)
    total = F.sum(cents).over(year).cast("decimal(18,0)")
    # Exact until the division: months * squares - total ** 2, in square cents.
    spread = (squares * months).cast("decimal(38,0)") - (total * total).cast("decimal(38,0)")
    deviations = deviation_from_mean(
        _monthly_revenue(market, month_grain), "neighbourhood", "total_revenue", "deviation_from_mean"
    )
    return as_report(
        deviations.withColumn(
            "yearly_variance", F.round(spread.cast("double") / (months * months * 10_000), 2)
        ),
        "neighbourhood", "month", "total_revenue", "deviation_from_mean", "yearly_variance",
    )


def review_distribution_by_neighbourhood(market: Market) -> DataFrame:
    """Reviews per neighbourhood and the neighbourhood's rank by them."""
    counts = market.reviews_per_listing()
    places = market.listings.select("id", "neighbourhood")
    totals = (
        counts.join(places, F.col("listing_id") == F.col("id"))
        .groupBy("neighbourhood")
        .agg(F.sum("n_reviews").alias("n_reviews"), F.count_distinct("id").alias("n_listings"))
    )
    ranked = global_dense_rank(totals, [desc("n_reviews")])
    return ranked.select(
        "neighbourhood", "n_listings", "n_reviews", "rnk"
    )


def _amenity_totals(market: Market) -> DataFrame:
    price = money("price")
    totals = market.listings.groupBy("neighbourhood").agg(
        rounded(F.avg("n_amenities")).alias("avg_amenities"),
        F.sum(price).alias("__price"),
        F.count(price).alias("__prices"),
        F.count(F.lit(1)).alias("__listings"),
    )
    return totals


def amenity_clusters(market: Market) -> DataFrame:
    """Mean price and listings by amenity level of the neighbourhood."""
    binned = quantile_bin(_amenity_totals(market), "avg_amenities")
    clusters = (
        binned.filter(F.col("neighbourhood").isNotNull())
        .groupBy("avg_amenities_bin")
        .agg(
            rounded(mean_of(F.sum("__price"), F.sum("__prices"))).alias("avg_price"),
            F.sum("__listings").alias("n_neighbourhoods"),
        )
    )
    compared = diff_from_reference_group(
        clusters, "avg_amenities_bin", "avg_price", "Low", "price_diff_from_low"
    )
    return as_report(
        compared, "avg_amenities_bin", "avg_price", "n_neighbourhoods", "price_diff_from_low"
    )


def amenity_clusters_by_thirds(market: Market) -> DataFrame:
    """Mean price and neighbourhoods in three equal amenity clusters."""
    known = _amenity_totals(market).filter(F.col("neighbourhood").isNotNull())
    clusters = (
        tercile_bin(known, "avg_amenities")
        .groupBy("avg_amenities_bin")
        .agg(
            rounded(mean_of(F.sum("__price"), F.sum("__prices"))).alias("avg_price"),
            F.count(F.lit(1)).alias("n_neighbourhoods"),
        )
    )
    compared = diff_from_reference_group(
        clusters, "avg_amenities_bin", "avg_price", "Low", "price_diff_from_low"
    )
    return as_report(
        compared, "avg_amenities_bin", "avg_price", "n_neighbourhoods", "price_diff_from_low"
    )


def room_type_seasons(market: Market) -> DataFrame:
    """Mean price per room type and season, and the spread over the seasons."""
    seasonal = calendar_totals(market.calendar, "listing_id", season_of("date").alias("season"))
    rooms = market.listings.select("id", "room_type")
    prices = (
        seasonal.join(rooms, F.col("listing_id") == F.col("id"))
        .groupBy("room_type", "season")
        .agg(rounded(mean_of(F.sum("price_sum"), F.sum("n_prices"))).alias("avg_price"))
    )
    spread = spread_by_group(prices, "room_type", "avg_price", "seasonal_price_diff")
    return as_report(spread, "room_type", "season", "avg_price", "seasonal_price_diff")


def neighbourhood_group_performance(market: Market) -> DataFrame:
    """Revenue, occupancy, scores and diversity per neighbourhood group, ranked by revenue."""
    per_listing = market.totals_per_listing().select(
        "listing_id", revenue().alias("revenue"), occupancy().alias("occupancy_rate")
    )
    listings = market.listings.filter(F.col("neighbourhood_group").isNotNull()).select(
        "id", "neighbourhood_group", "room_type", "property_type",
        *[f"review_scores_{s}" for s in GROUP_SCORES],
    )
    groups = (
        listings.join(per_listing, F.col("id") == F.col("listing_id"))
        .groupBy("neighbourhood_group")
        .agg(
            rounded(F.avg("occupancy_rate")).alias("avg_occupancy_rate"),
            F.sum("revenue").alias("total_revenue"),
            *[
                rounded(F.avg(f"review_scores_{s}"), 0).alias(f"avg_review_score_{s}")
                for s in GROUP_SCORES
            ],
            few_values("room_type").cast("long").alias("n_unique_room_types"),
            few_values("property_type").cast("long").alias("n_unique_property_types"),
        )
    )
    ranked = global_dense_rank(
        groups, [desc("total_revenue")], "revenue_rank"
    )
    return as_report(
        ranked,
        "neighbourhood_group", "avg_occupancy_rate", "total_revenue",
        *[f"avg_review_score_{s}" for s in GROUP_SCORES],
        "n_unique_room_types", "n_unique_property_types", "revenue_rank",
    )


def property_type_trends(market: Market) -> DataFrame:
    """Price per unit of a score made of rating and occupancy, per property type."""
    per_listing = market.totals_per_listing().select(
        "listing_id",
        occupancy().alias("occupancy_rate"),
        rounded(mean_price()).alias("listing_price"),
    )
    listings = market.listings.select("id", "property_type", "review_scores_rating")
    means = {
        "avg_review_score_rating": "review_scores_rating",
        "avg_occupancy_rate": "occupancy_rate",
        "avg_price": "listing_price",
    }
    types = segment_compare(
        listings.join(per_listing, F.col("id") == F.col("listing_id")), "property_type", means
    )
    scored = weighted_score_ratio(
        types, "avg_price", SCORE_WEIGHTS, "performance_score", "price_to_performance_ratio"
    )
    ranked = global_dense_rank(
        scored, [desc("price_to_performance_ratio")], "rank"
    )
    return as_report(
        ranked, "property_type", *means, "performance_score", "price_to_performance_ratio", "rank"
    )
