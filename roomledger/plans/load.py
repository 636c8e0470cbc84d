"""From the files of an export to cleaned tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from roomledger.operators.cleaning import clean_calendar, clean_listings, clean_reviews
from roomledger.plans.market import Market
from roomledger.sources.readers import read_calendar, read_listings, read_reviews


def load_market(
    spark: SparkSession,
    listings: str,
    calendar: str,
    reviews: str,
    partitions: int | None = None,
    strict: bool = False,
) -> Market:
    """Read and clean the three tables; each path may be a glob over many cities' files.

    ``partitions`` spreads tables whose files Spark cannot split. ``strict`` is explained
    in :mod:`roomledger.operators.cleaning`.
    """
    days = clean_calendar(read_calendar(spark, calendar, partitions), strict)
    raw = read_listings(spark, listings, partitions)
    return Market(
        listings=clean_listings(raw, days, strict),
        calendar=days,
        reviews=clean_reviews(read_reviews(spark, reviews, partitions)),
        listings_from=lambda calendar: clean_listings(raw, calendar, strict),
    )
