"""Report names, and the job that writes them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.plans import host_reports as hosts
from roomledger.plans import listing_reports as listings
from roomledger.plans import neighbourhood_reports as places
from roomledger.plans.market import Market
from roomledger.sources.scratch import remove
from roomledger.sources.writers import write_report


# Middle tables that several reports share; a run makes those that its reports use.
MONTHS = "month_totals"
LISTINGS = "listing_totals"
SKETCHES = "review_sketches"  # a column of the listing totals


@dataclass(frozen=True)
class Report:
    """How to build a report, whether its size is bounded whatever the data, and what it uses."""

    build: Callable[[Market], DataFrame]
    bounded: bool = False
    uses: tuple[str, ...] = ()


# The reports of a full run, by output name.
REPORTS: dict[str, Report] = {
    "top_5_listings_by_avg_price": Report(listings.top_listings_by_price, uses=(MONTHS,)),
    "occupancy_rate_per_month": Report(listings.occupancy_per_month, uses=(MONTHS,)),
    "most_reviewed_listings": Report(listings.most_reviewed_listings),
    "top_five_host_avgs": Report(hosts.top_host_averages, uses=(LISTINGS,)),
    "most_active_hosts_per_neighbourhood": Report(places.most_active_hosts),
    "monthly_revenue_per_neighbourhood": Report(places.monthly_revenue, uses=(MONTHS,)),
    "lowest_occupancy_rate_and_review_scores": Report(listings.lowest_occupancy_and_scores, bounded=True, uses=(LISTINGS,)),
    "review_distribution_per_neighbourhood": Report(listings.review_distribution, uses=(LISTINGS,)),
    "neighbourhood_amenity_clusters": Report(places.amenity_clusters, bounded=True),
    "room_type_seasonal_trends": Report(places.room_type_seasons),
    "most_diverse_hosts_by_property_type": Report(hosts.most_diverse_hosts),
    "super_hosts_vs_regular_hosts": Report(hosts.superhosts_and_others, bounded=True, uses=(LISTINGS,)),
    "host_response_times_stats": Report(hosts.host_response_stats, uses=(LISTINGS,)),
    "listing_stats_by_price_bin": Report(listings.listing_stats_by_price, uses=(LISTINGS,)),
    "daily_price_changes": Report(listings.daily_price_changes),
    "host_verification_performance": Report(hosts.verification_performance, uses=(MONTHS,)),
    "host_tier_revenue_trends": Report(hosts.host_tier_revenue, uses=(LISTINGS,)),
    "neighbourhood_group_performance": Report(places.neighbourhood_group_performance, uses=(LISTINGS,)),
    "property_type_trends": Report(places.property_type_trends, uses=(LISTINGS,)),
}

# Further reports, built on request: a plain price overview, and the reports above in
# the form their descriptions ask for where that differs.
EXTRA_REPORTS: dict[str, Report] = {
    "avg_price_by_neighbourhood": Report(places.average_price),
    "top_5_listings_by_avg_price_intended": Report(listings.top_listings_by_price_exact, uses=(MONTHS,)),
    "occupancy_rate_per_month_intended": Report(listings.occupancy_per_month_exact, uses=(MONTHS,)),
    "occupancy_rate_per_year_month": Report(lambda m: listings.occupancy_per_month(m, "year_month")),
    "top_5_listings_by_avg_price_per_year_month": Report(
        lambda m: listings.top_listings_by_price(m, "year_month")
    ),
    "most_reviewed_listings_per_year_month": Report(
        lambda m: listings.most_reviewed_listings(m, "year_month")
    ),
    "monthly_revenue_per_neighbourhood_and_year_month": Report(
        lambda m: places.monthly_revenue(m, "year_month")
    ),
    "host_verification_performance_per_year_month": Report(
        lambda m: hosts.verification_performance(m, "year_month")
    ),
    "most_reviewed_listings_intended": Report(listings.most_reviewed_listings_exact),
    "top_five_host_avgs_intended": Report(hosts.top_host_averages_exact, bounded=True, uses=(LISTINGS,)),
    "most_active_hosts_per_neighbourhood_intended": Report(places.most_active_hosts_by_host),
    "monthly_revenue_per_neighbourhood_intended": Report(places.monthly_revenue_deviation, uses=(MONTHS,)),
    "lowest_occupancy_rate_and_review_scores_intended": Report(
        listings.lowest_occupancy_and_scores_with_id, bounded=True, uses=(LISTINGS,)
    ),
    "review_distribution_per_neighbourhood_intended": Report(places.review_distribution_by_neighbourhood, uses=(LISTINGS,)),
    "neighbourhood_amenity_clusters_intended": Report(places.amenity_clusters_by_thirds, bounded=True),
    "host_response_times_stats_sketched": Report(hosts.host_response_stats_sketched, uses=(LISTINGS, SKETCHES)),
    "host_response_times_stats_intended": Report(hosts.host_response_stats_per_listing, uses=(LISTINGS,)),
    "listing_stats_by_price_bin_intended": Report(listings.listing_stats_by_price_bin, bounded=True, uses=(LISTINGS,)),
    "daily_price_changes_intended": Report(listings.daily_price_changes_exact, bounded=True),
    "host_tier_revenue_trends_intended": Report(hosts.host_tier_revenue_within_tier, uses=(LISTINGS,)),
}

ALL_REPORTS = REPORTS | EXTRA_REPORTS


def run_reports(
    market: Market,
    out_uri: str,
    names: Iterable[str] | None = None,
    format: str = "csv",
    mode: str = "overwrite",
    staging_uri: str | None = None,
    version: str | None = None,
) -> list[str]:
    """Write the named reports (by default all of :data:`REPORTS`) under ``out_uri``.

    The cleaned inputs are prepared once, and of the totals per listing and month and per
    listing (with the review counts) those that the named reports use; they serve every
    report until the last one is written. With ``staging_uri`` they become Parquet tables
    there, which survive the loss of executors and let each report read only its columns, and
    which are removed at the end; otherwise they are persisted. Bounded reports are one file
    each. Returns the locations of the reports.

    ``version`` names the state of the inputs. Every finished report is then marked with it,
    and so is every staged table. A run of the same version goes on after the marks: it
    neither writes a finished report again nor prepares a table that is there. A table or
    report is marked only after its write has succeeded.
    """
    chosen = list(REPORTS) if names is None else list(names)
    unknown = [n for n in chosen if n not in ALL_REPORTS]
    if unknown:
        raise KeyError(f"unknown reports: {', '.join(unknown)}")
    targets = {name: f"{out_uri}/{name}" for name in chosen}
    # Without any report there is nothing to prepare and no session to ask.
    spark = market.calendar.sparkSession if market is not None else None
    finished = Marks(spark, f"{out_uri}/_finished", version)
    staged = Marks(spark, f"{staging_uri}/_finished", version if staging_uri else None)
    open_names = [n for n in chosen if n not in finished.names]
    held: list[DataFrame] = []

    def prepared(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if staging_uri is None:
            held.append(make().persist(StorageLevel.MEMORY_AND_DISK))
            return held[-1]
        if name not in staged.names:
            make().write.mode("overwrite").parquet(f"{staging_uri}/{name}")
            staged.add(name)
        return spark.read.parquet(f"{staging_uri}/{name}")

    try:
        if open_names:
            ready = _ready(market, prepared, {use for n in open_names for use in ALL_REPORTS[n].uses})
        for name in open_names:
            report = ALL_REPORTS[name]
            write_report(report.build(ready), targets[name], format, mode, single_file=report.bounded)
            finished.add(name)
    finally:
        for df in held:
            df.unpersist()
    if staging_uri is not None:
        remove(spark, staging_uri)
    return list(targets.values())


def _ready(market: Market, prepared: Callable[[str, Callable[[], DataFrame]], DataFrame], uses: set[str]) -> Market:
    # The calendar first: the prices of the listings may be filled from it.
    calendar = prepared("calendar", lambda: market.calendar)
    filled = market.listings_from
    listings = prepared("listings", lambda: market.listings if filled is None else filled(calendar))
    ready = Market(listings, calendar, prepared("reviews", lambda: market.reviews))
    if MONTHS in uses:
        ready = replace(ready, month_totals=prepared(MONTHS, ready.totals_per_month))
    if LISTINGS in uses:
        sketches = SKETCHES in uses
        name = f"{LISTINGS}_with_{SKETCHES}" if sketches else LISTINGS
        ready = replace(ready, listing_totals=prepared(name, lambda: ready.make_listing_totals(sketches)))
    return ready


class Marks:
    """Names of what is finished, for one version of the inputs, in a small table at ``uri``.

    Without a version nothing is marked and nothing is finished.
    """

    def __init__(self, spark: SparkSession | None, uri: str, version: str | None):
        self.spark, self.uri, self.version = spark, uri, version
        self.names: set[str] = set()
        if version is not None:
            try:
                rows = spark.read.schema("name string, version string").parquet(uri)
                self.names = {r.name for r in rows.filter(F.col("version") == version).select("name").distinct().collect()}
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise

    def add(self, name: str) -> None:
        self.names.add(name)
        if self.version is not None:
            row = self.spark.createDataFrame([(name, self.version)], "name string, version string")
            row.coalesce(1).write.mode("append").parquet(self.uri)
