"""The tables a report works on."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.functions.dates import month_key, month_label
from roomledger.operators.joins import null_safe_join
from roomledger.operators.metrics import calendar_totals, merge_totals, occupancy
from roomledger.operators.sketches import distinct_sketch


@dataclass(frozen=True)
class Market:
    """Cleaned listings, calendar and reviews.

    ``month_totals`` may hold the calendar totals per listing and month name, prepared
    once for many reports. It has at most twelve rows per listing instead of one per day.
    ``listing_totals`` may hold one row per listing: its calendar totals, the number of its
    reviews and, if a report merges them, a sketch of its review ids.
    ``listings_from`` may make the listings from a calendar that is already prepared, so
    that a full run does not read the raw calendar once more for their prices.
    """

    listings: DataFrame
    calendar: DataFrame
    reviews: DataFrame
    month_totals: DataFrame | None = None
    listing_totals: DataFrame | None = None
    listings_from: Callable[[DataFrame], DataFrame] | None = None

    def totals_per_listing(self) -> DataFrame:
        if self.listing_totals is not None:
            days = self.listing_totals.filter("n_days IS NOT NULL")
            return days.drop("n_reviews", "review_ids")
        if self.month_totals is None:
            return calendar_totals(self.calendar, "listing_id")
        return merge_totals(self.month_totals, "listing_id")

    def totals_per_month(self, grain: str = "name") -> DataFrame:
        if self.month_totals is not None and grain == "name":
            return self.month_totals
        key = month_key("date", grain).alias("month")
        totals = calendar_totals(self.calendar, "listing_id", key)
        return totals.withColumn("month", month_label("month", grain))

    def reviews_per_month(self, *counts: Column, grain: str = "name") -> DataFrame:
        """The given aggregates of the reviews per listing and month."""
        key = month_key("date", grain).alias("month")
        grouped = self.reviews.groupBy("listing_id", key).agg(*counts)
        return grouped.withColumn("month", month_label("month", grain))

    def reviews_per_listing(self, sketches: bool = False) -> DataFrame:
        """``n_reviews`` of each listing that has any; with ``sketches`` also ``review_ids``."""
        columns = ["listing_id", "n_reviews", *(["review_ids"] if sketches else [])]
        if self.listing_totals is not None and set(columns) <= set(self.listing_totals.columns):
            return self.listing_totals.filter("n_reviews IS NOT NULL").select(*columns)
        counts = [F.count(F.lit(1)).alias("n_reviews")]
        if sketches:
            counts.append(distinct_sketch("id").alias("review_ids"))
        return self.reviews.groupBy("listing_id").agg(*counts)

    def make_listing_totals(self, sketches: bool = False) -> DataFrame:
        """What ``listing_totals`` holds: listings of the calendar, of the reviews, or of both."""
        days, reviews = self.totals_per_listing(), self.reviews_per_listing(sketches)
        return null_safe_join(
            days.select("listing_id").unionByName(reviews.select("listing_id")).distinct(), days, ["listing_id"], "left"
        ).transform(null_safe_join, reviews, ["listing_id"], "left")

    def occupancy_per_listing(self) -> DataFrame:
        return self.totals_per_listing().select("listing_id", occupancy().alias("occupancy_rate"))


def as_report(df: DataFrame, *columns: str) -> DataFrame:
    """The report columns in order, decimals as doubles."""
    decimals = {f.name for f in df.schema.fields if f.dataType.typeName() == "decimal"}
    return df.select(*[df[c].cast("double").alias(c) if c in decimals else c for c in columns])
