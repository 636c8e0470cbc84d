"""Every operator and report as a query on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roomledger import bindings, schemas
from roomledger.bindings import table
from roomledger.functions.dates import month_key, month_label, season_of
from roomledger.functions.numbers import mean_money, mean_of, money, rounded, six_digits
from roomledger.functions.text import clean_text, list_size
from roomledger.operators import cleaning, comparing, metrics, quantiles, ranking, sketches
from roomledger.operators.ranking import asc, desc
from roomledger.plans.market import Market, as_report
from roomledger.plans.registry import ALL_REPORTS, run_reports
from roomledger.sources import readers
from roomledger.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

# Reports that read host attributes.
HOST_REPORTS = {
    "occupancy_rate_per_month",
    "occupancy_rate_per_month_intended",
    "occupancy_rate_per_year_month",
    "most_active_hosts_per_neighbourhood",
    "most_active_hosts_per_neighbourhood_intended",
    "super_hosts_vs_regular_hosts",
    "host_response_times_stats",
    "host_response_times_stats_intended",
    "host_response_times_stats_sketched",
    "host_verification_performance",
    "host_verification_performance_per_year_month",
}


def _report(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        market = bindings.market(spark, sf_dir, hosts=name in HOST_REPORTS)
        return ALL_REPORTS[name].build(market)

    return query


def _text_date(name: str):
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def _items(name: str):
    return F.array_join(name, "|").alias(name)


# Cleaning


def _clean_price(strict: bool) -> Query:
    def query(spark, sf_dir):
        calendar = bindings.raw_calendar(spark, sf_dir).withColumn("raw_price", F.col("price"))
        cleaned = cleaning.clean_price(calendar, strict)
        return as_report(cleaned, "listing_id", "raw_price", "price")

    return query


def _flag_to_bool(strict: bool) -> Query:
    def query(spark, sf_dir):
        raw = bindings.raw_listings(spark, sf_dir)
        flags = [*cleaning.LISTING_FLAG_COLUMNS, "has_availability", "no_such_flag"]
        return cleaning.flags_to_bool(raw, flags, strict).select("id", *cleaning.LISTING_FLAG_COLUMNS)

    return query


def _parse_list(strict: bool) -> Query:
    def query(spark, sf_dir):
        raw = bindings.raw_listings(spark, sf_dir)
        parsed = cleaning.parse_lists(raw, cleaning.LISTING_LIST_COLUMNS, strict)
        return parsed.select("id", *[_items(c) for c in cleaning.LISTING_LIST_COLUMNS])

    return query


def _list_size(strict: bool) -> Query:
    def query(spark, sf_dir):
        raw = bindings.raw_listings(spark, sf_dir)
        parsed = cleaning.parse_lists(raw, ["amenities"], strict)
        size = list_size("amenities", null_size=None if strict else -1)
        return parsed.select("id", size.alias("n_amenities"))

    return query


def split_location(spark, sf_dir):
    raw = bindings.raw_listings(spark, sf_dir)
    return cleaning.split_location(raw).select("id", "host_city", "host_state")


def na_to_null(spark, sf_dir):
    raw = bindings.raw_listings(spark, sf_dir)
    return cleaning.nulls_for_na(raw).select(
        "id", "price", "neighborhood_overview", "host_response_rate"
    )


def clean_page_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", clean_text("html").alias("text"))


def parse_percent(spark, sf_dir):
    raw = bindings.raw_listings(spark, sf_dir)
    return cleaning.parse_percents(raw).select("id", "host_response_rate", "host_acceptance_rate")


def columns_containing(spark, sf_dir):
    return cleaning.columns_containing(bindings.raw_listings(spark, sf_dir), "N/A")


def _clean_listings(strict: bool) -> Query:
    def query(spark, sf_dir):
        calendar = cleaning.clean_calendar(bindings.raw_calendar(spark, sf_dir), strict)
        raw = bindings.raw_listings(spark, sf_dir)
        cleaned = cleaning.clean_listings(raw, calendar, strict)
        lists = cleaning.LISTING_LIST_COLUMNS
        joined = cleaned.withColumns({c: _items(c) for c in lists})
        return as_report(joined, *joined.columns)

    return query


def _clean_calendar(strict: bool) -> Query:
    def query(spark, sf_dir):
        cleaned = cleaning.clean_calendar(bindings.raw_calendar(spark, sf_dir), strict)
        texts = cleaned.withColumn("date", _text_date("date"))
        return as_report(texts, *texts.columns)

    return query


def clean_reviews(spark, sf_dir):
    cleaned = cleaning.clean_reviews(bindings.raw_reviews(spark, sf_dir))
    return cleaned.withColumn("date", _text_date("date"))


def _impute_price(strict: bool) -> Query:
    """Accounts as listings; the events of their users as calendar."""

    def query(spark, sf_dir):
        balance = money("c_acctbal")
        accounts = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_mktsegment").alias("segment"),
            F.when(balance >= 0, balance).alias("price"),
        )
        events = table(spark, sf_dir, "events").select(
            F.col("user_id").alias("listing_id"), F.col("value").alias("price")
        )
        return as_report(
            metrics.impute_prices(accounts, events, keep_unmatched=strict), "id", "segment", "price"
        )

    return query


# Metrics and operators


def median_price(spark, sf_dir):
    medians = metrics.median_prices(bindings.calendar(spark, sf_dir))
    return as_report(medians, "listing_id", "median_price")


def occupancy_rate(spark, sf_dir):
    rates = metrics.occupancy_rate(bindings.calendar(spark, sf_dir), "listing_id")
    return as_report(rates, "listing_id", "occupancy_rate")


def _quantile_bin(bin_values) -> Query:
    def query(spark, sf_dir):
        totals = metrics.calendar_totals(bindings.calendar(spark, sf_dir), "listing_id")
        prices = totals.select("listing_id", six_digits(metrics.mean_price()).alias("avg_price"))
        return as_report(bin_values(prices, "avg_price"), "listing_id", "avg_price", "avg_price_bin")

    return query


def exact_median(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", money("l_extendedprice").alias("price"))
    medians = quantiles.exact_median(lines, "price", "median_price", ["l_returnflag"])
    return medians.select("l_returnflag", rounded("median_price").cast("double").alias("median_price"))


def top_n_per_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("day")
    )
    top = ranking.top_n_per_group(orders, ["o_orderpriority"], [desc("day")], 3)
    return top.select("o_orderkey", "o_orderpriority", "rnk")


def global_dense_rank(spark, sf_dir):
    lines = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", money("o_totalprice").alias("o_totalprice")
    )
    ranked = ranking.global_dense_rank(lines, [desc("o_custkey"), asc("o_totalprice")])
    return as_report(ranked, "o_orderkey", "o_custkey", "o_totalprice", "rnk")


def fixed_bin(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    tiers = {"Small": (1, 5), "Medium": (6, 15)}
    return counts.withColumn("tier", quantiles.fixed_bin("n_orders", tiers, "Large"))


def season(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", season_of("o_orderdate").alias("season"))


def change_count(spark, sf_dir):
    changes = metrics.change_count(bindings.calendar(spark, sf_dir), "listing_id", "date", "price")
    return changes.select(
        "listing_id",
        "n_changes",
        rounded(mean_of("value_sum", "n_values")).cast("double").alias("avg_price"),
    )


def spread_by_group(spark, sf_dir):
    prices = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority", "o_orderstatus")
        .agg(rounded(mean_money("o_totalprice")).alias("avg_price"))
    )
    spread = comparing.spread_by_group(prices, "o_orderpriority", "avg_price", "price_spread")
    return as_report(spread, "o_orderpriority", "o_orderstatus", "avg_price", "price_spread")


def deviation_from_mean(spark, sf_dir):
    revenue = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority", month_key("o_orderdate").alias("month"))
        .agg(F.sum(money("o_totalprice")).alias("revenue"))
        .withColumn("month", month_label("month"))
    )
    compared = comparing.deviation_from_mean(revenue, "o_orderpriority", "revenue", "deviation")
    return as_report(compared, "o_orderpriority", "month", "revenue", "deviation")


def rank_sum_bottom_k(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", money("c_acctbal").alias("c_acctbal"))
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    joined = customers.join(counts, F.col("c_custkey") == F.col("o_custkey"))
    lowest = ranking.rank_sum_bottom_k(joined, [asc("c_acctbal"), asc("n_orders")], 10, ["c_custkey"])
    return as_report(lowest, "c_custkey", "c_acctbal", "n_orders")


def diff_from_reference_group(spark, sf_dir):
    balances = (
        table(spark, sf_dir, "customer")
        .groupBy("c_mktsegment")
        .agg(rounded(mean_money("c_acctbal")).alias("avg_balance"))
    )
    compared = comparing.diff_from_reference_group(
        balances, "c_mktsegment", "avg_balance", "BUILDING", "diff_from_building"
    )
    return as_report(compared, "c_mktsegment", "avg_balance", "diff_from_building")


def weighted_score_ratio(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        rounded(F.avg("l_quantity")).alias("avg_quantity"),
        rounded(F.avg(F.col("l_discount") * 100)).alias("avg_discount"),
        rounded(mean_money("l_extendedprice")).alias("avg_price"),
    )
    weights = {"avg_quantity": "0.6", "avg_discount": "0.4"}
    scored = comparing.weighted_score_ratio(lines, "avg_price", weights, "score", "price_per_score")
    return as_report(scored, *scored.columns)


def impute_from_group_median(spark, sf_dir):
    price = money("p_retailprice")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", F.when(F.col("p_size") > 25, price).alias("price")
    )
    sold = bindings.calendar(spark, sf_dir)
    filled = metrics.impute_from_group_median(parts, "p_partkey", "price", metrics.median_prices(sold))
    return as_report(filled, "p_partkey", "p_brand", "price")


def segment_compare(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    customers = table(spark, sf_dir, "customer").join(counts, F.col("c_custkey") == F.col("o_custkey"))
    compared = comparing.segment_compare(
        customers.withColumn("c_acctbal", money("c_acctbal")),
        "c_mktsegment",
        {"order_weighted_balance": "c_acctbal"},
        weight="n_orders",
        counts={"n_nations": "c_nationkey"},
    )
    return as_report(compared, "c_mktsegment", "order_weighted_balance", "n_nations")


# Files: the tables as an export, written and read back


def _exported(df: DataFrame, schema: str, name: str) -> str:
    """Write gzip CSV with the columns of the export in order; a new folder every time."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    columns = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in StructType.fromDDL(schema).fields
    ]
    df.select(*columns).write.csv(path, header=True, quote='"', escape='"', compression="gzip")
    return path


def _whole_listings(raw: DataFrame) -> DataFrame:
    """All columns of the export; those that the raw listings lack are made from id and place."""
    key = F.col("id")
    made = {}
    for place, field in enumerate(StructType.fromDDL(schemas.LISTINGS).fields):
        if field.name not in raw.columns:
            made[field.name] = {
                "bigint": key * 1_000_003 + place,
                "int": (key % 97 + place).cast("int"),
                "float": ((key % 50) / 4 + place).cast("float"),
                "date": F.date_add(F.lit("2020-01-01").cast("date"), (key % 1000 + place).cast("int")),
                "string": F.concat(F.lit(f"{field.name} "), key),
            }[field.dataType.simpleString()]
    return raw.withColumns(made)


def read_listings_csv(spark, sf_dir):
    """All 75 columns as read, and the parts of the location."""
    path = _exported(_whole_listings(bindings.raw_listings(spark, sf_dir)), schemas.LISTINGS, "listings")
    raw = readers.read_listings(spark, path, partitions=8)
    shown = []
    for field in raw.schema.fields:
        name, kind = field.name, field.dataType.simpleString()
        if name in cleaning.LISTING_PROSE_COLUMNS:
            shown.append(clean_text(name).alias(name))
        else:
            as_is = {"date": _text_date(name), "float": F.col(name).cast("double"), "string": F.trim(name)}
            shown.append(as_is.get(kind, F.col(name)).alias(name))
    parts = cleaning.split_location(raw).select(F.col("id").alias("__id"), "host_city", "host_state")
    return raw.select(*shown).join(parts, F.col("id") == F.col("__id")).drop("__id")


def rejected_cells(spark, sf_dir):
    """Calendar days with cells that do not fit, by listing and by what does not fit."""
    listing = F.col("listing_id")
    raw = bindings.raw_calendar(spark, sf_dir).withColumns(
        {
            "date": F.when(listing % 21 == 0, "someday").otherwise(F.col("date").cast("string")),
            "minimum_nights": F.when(listing % 10 == 0, "x").otherwise(F.col("minimum_nights").cast("string")),
            "maximum_nights": F.when(listing % 15 == 0, "1.5").otherwise(F.col("maximum_nights").cast("string")),
        }
    )
    texts = schemas.CALENDAR.replace(" date,", " string,").replace(" int", " string")
    path = _exported(raw, texts, "rejected")
    found = readers.rejected_records(spark, path, "calendar")
    return found.groupBy(
        F.element_at(F.split("record", ","), 1).cast("bigint").alias("listing_id"),
        F.array_join("columns", "|").alias("columns"),
    ).agg(F.count(F.lit(1)).alias("n_records"))


def read_calendar_csv(spark, sf_dir):
    path = _exported(bindings.raw_calendar(spark, sf_dir), schemas.CALENDAR, "calendar")
    cleaned = cleaning.clean_calendar(readers.read_calendar(spark, path))
    texts = cleaned.withColumn("date", _text_date("date"))
    return as_report(texts, *texts.columns)


def read_reviews_csv(spark, sf_dir):
    raw = bindings.raw_reviews(spark, sf_dir).withColumn("date", F.col("date").try_cast("date"))
    path = _exported(raw, schemas.REVIEWS, "reviews")
    cleaned = cleaning.clean_reviews(readers.read_reviews(spark, path, partitions=8))
    return cleaned.withColumn("date", _text_date("date"))


def written_report(spark, sf_dir):
    """A report as a full run writes it: staged tables, totals per listing, CSV, read back."""
    folder = scratch_path(spark, "run")
    market = bindings.market(spark, sf_dir)
    (target,) = run_reports(market, f"{folder}/out", ["property_type_trends"], staging_uri=f"{folder}/staging", version="1")
    columns = ALL_REPORTS["property_type_trends"].build(market).schema
    return spark.read.csv(target, schema=columns, header=True)


# Sketches, held against the exact operators


def approx_quantiles(spark, sf_dir):
    """Exact quantiles, and whether those of the sketches stand near enough."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", money("l_extendedprice").alias("price"))
    fractions = {"low": 0.25, "middle": 0.5, "high": 0.9}
    exact = quantiles.exact_quantiles(lines, "price", fractions, ["l_returnflag"])
    rough = sketches.approximate_quantiles(lines, "price", fractions, ["l_returnflag"])
    rough = rough.withColumnsRenamed({name: f"__{name}" for name in fractions})
    price, n = F.col("price").cast("double"), F.count("price")
    near = [
        (F.count_if(price < F.col(f"__{name}")) / n <= fraction + sketches.RANK_ERROR)
        & (F.count_if(price <= F.col(f"__{name}")) / n >= fraction - sketches.RANK_ERROR)
        for name, fraction in fractions.items()
    ]
    checked = lines.join(rough, "l_returnflag").groupBy("l_returnflag").agg((near[0] & near[1] & near[2]).alias("within_error"))
    return as_report(exact.join(checked, "l_returnflag"), "l_returnflag", *fractions, "within_error")


def host_response_times_stats_sketched(spark, sf_dir):
    """The exact report, and whether the one from sketches is near enough and else the same."""
    exact = _report("host_response_times_stats")(spark, sf_dir)
    rough = _report("host_response_times_stats_sketched")(spark, sf_dir)
    rough = rough.select(*[F.col(c).alias(f"__{c}") for c in rough.columns])
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in exact.columns if c != "n_reviews"]
    near = F.abs(F.col("__n_reviews") - F.col("n_reviews")) <= F.col("n_reviews") * sketches.DISTINCT_ERROR
    joined = exact.join(rough, F.col("host_response_time") == F.col("__host_response_time"), "left")
    within = F.coalesce(near & same[0] & same[1] & same[2] & same[3], F.lit(False))
    return joined.select(*exact.columns, within.alias("within_error"))


QUERIES: dict[str, Query] = {
    **{name: _report(name) for name in ALL_REPORTS},
    "host_response_times_stats_sketched": host_response_times_stats_sketched,
    "approx_quantiles": approx_quantiles,
    "rejected_cells": rejected_cells,
    "written_report": written_report,
    "clean_price": _clean_price(False),
    "clean_price_intended": _clean_price(True),
    "flag_to_bool": _flag_to_bool(False),
    "flag_to_bool_intended": _flag_to_bool(True),
    "parse_list": _parse_list(False),
    "parse_list_intended": _parse_list(True),
    "list_size": _list_size(False),
    "list_size_intended": _list_size(True),
    "split_location": split_location,
    "na_to_null": na_to_null,
    "clean_text": clean_page_text,
    "parse_percent": parse_percent,
    "columns_containing": columns_containing,
    "impute_price": _impute_price(False),
    "impute_price_intended": _impute_price(True),
    "clean_listings": _clean_listings(False),
    "clean_listings_intended": _clean_listings(True),
    "clean_calendar": _clean_calendar(False),
    "clean_calendar_intended": _clean_calendar(True),
    "clean_reviews": clean_reviews,
    "median_price": median_price,
    "occupancy_rate": occupancy_rate,
    "quantile_bin": _quantile_bin(quantiles.quantile_bin),
    "quantile_bin_intended": _quantile_bin(quantiles.tercile_bin),
    "exact_median": exact_median,
    "top_n_per_group": top_n_per_group,
    "global_dense_rank": global_dense_rank,
    "fixed_bin": fixed_bin,
    "season_of": season,
    "change_count": change_count,
    "spread_by_group": spread_by_group,
    "deviation_from_mean": deviation_from_mean,
    "rank_sum_bottom_k": rank_sum_bottom_k,
    "diff_from_reference_group": diff_from_reference_group,
    "weighted_score_ratio": weighted_score_ratio,
    "impute_from_group_median": impute_from_group_median,
    "segment_compare": segment_compare,
    "read_listings_csv": read_listings_csv,
    "read_calendar_csv": read_calendar_csv,
    "read_reviews_csv": read_reviews_csv,
}
