"""Occupancy, prices and revenue from a daily calendar.

The calendar has one row per listing and day and is by far the largest table. Every
metric is a mergeable aggregate of it, so map-side combining shrinks even a listing
that owns most of the rows, and joins happen after the aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.functions.numbers import mean_of, money, percent, rounded


def calendar_totals(calendar: DataFrame, *keys: Column | str) -> DataFrame:
    """Days, booked days and price sums per group, in one pass."""
    booked = ~F.col("available")
    price = money("price")
    return calendar.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.count_if(booked).alias("n_booked"),
        F.sum(F.when(booked, price)).alias("booked_price_sum"),
        F.sum(price).alias("price_sum"),
        F.count(price).alias("n_prices"),
    )


def merge_totals(totals: DataFrame, *keys: str) -> DataFrame:
    """Totals of coarser groups from those of finer ones."""
    sums = ("n_days", "n_booked", "booked_price_sum", "price_sum", "n_prices")
    return totals.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def revenue() -> Column:
    """Booked revenue of a row of :func:`calendar_totals`.

    Null only when every day is booked and none has a price.
    """
    return F.expr(
        "CASE WHEN n_booked < n_days THEN coalesce(booked_price_sum, 0) ELSE booked_price_sum END"
    )


def occupancy() -> Column:
    """Occupancy rate, in percent, of a row of :func:`calendar_totals`."""
    return percent(F.col("n_booked"), F.col("n_days"))


def mean_price() -> Column:
    """Mean price of a row of :func:`calendar_totals`."""
    return mean_of("price_sum", "n_prices")


def occupancy_rate(calendar: DataFrame, *keys: Column | str) -> DataFrame:
    """Share of unavailable days per group, in percent with two digits."""
    totals = calendar_totals(calendar, *keys)
    names = totals.columns[: len(keys)]
    return totals.select(*names, occupancy().alias("occupancy_rate"))


def median_prices(calendar: DataFrame) -> DataFrame:
    """Median calendar price per listing, rounded to cents.

    The aggregation buffer counts equal prices and is combined map-side, so its size is
    the number of different prices of a listing, not its number of rows.
    """
    return calendar.groupBy("listing_id").agg(
        rounded(F.median(money("price"))).cast("decimal(18,2)").alias("median_price")
    )


def impute_from_group_median(
    df: DataFrame, key: str, value: str, medians: DataFrame, keep_unmatched: bool = False
) -> DataFrame:
    """Fill missing values with the median of the row's group; the value moves to the end.

    Values that are there stay as they are, in a type that holds both.

    ``medians`` has a key and a median column. Rows without a group are dropped unless
    ``keep_unmatched`` is set.
    """
    group, median = medians.columns
    known = medians.select(F.col(group).alias("__group"), F.col(median).alias("__median"))
    how = "left" if keep_unmatched else "inner"
    return (
        df.join(known, F.col(key) == F.col("__group"), how)
        .withColumn("__value", F.coalesce(F.col(value), F.col("__median")))
        .drop(value, "__group", "__median")
        .withColumnRenamed("__value", value)
    )


def impute_prices(
    listings: DataFrame,
    calendar: DataFrame,
    keep_unmatched: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Fill missing listing prices from the listing's calendar; the night limits go.

    ``columns`` chooses the listing columns to keep; id and price must be among them. Medians
    are taken only of listings without a price: a semi join holds back all other days before
    they are grouped. Unless ``keep_unmatched`` is set, listings that the calendar does not
    know go, with a price or not; that takes the ids of the calendar alone.
    """
    listings = listings.withColumn("price", money("price"))
    if columns is not None:
        listings = listings.select(*columns)
    unpriced = listings.filter("price IS NULL AND id IS NOT NULL").select(F.col("id").alias("listing_id")).distinct()
    medians = median_prices(calendar.join(unpriced, "listing_id", "left_semi"))
    filled = impute_from_group_median(listings, "id", "price", medians, keep_unmatched=True)
    if not keep_unmatched:
        known = calendar.select(F.col("listing_id").alias("id")).distinct()
        filled = filled.join(known, "id", "left_semi").select(*filled.columns)
    return filled.drop("adjusted_price", "minimum_nights", "maximum_nights")


def change_count(
    df: DataFrame, entity: str, date: str, value: str, out: str = "n_changes"
) -> DataFrame:
    """How often the value differs from the one before it, per entity in date order.

    Rows of one date are ordered by value; a change from or to null does not count.
    The different (date, value) pairs of an entity and month are gathered, merged before they
    are sent, so a month is at most 31 times the values of a day, however many copies there are.
    Changes are counted within them, and the seams between months are added from each month's
    first and last pair: no task sees a whole series. ``value_sum`` and ``n_values`` come along.
    """
    points = df.select(
        entity,
        F.trunc(date, "MM").alias("__month"),
        F.struct(F.col(date).alias("d"), F.col(value).alias("v")).alias("__point"),
        F.col(value).alias("__value"),
    )
    months = points.groupBy(entity, "__month").agg(
        F.sort_array(F.collect_set("__point")).alias("__points"),
        F.sum("__value").alias("__sum"),
        F.count("__value").alias("__count"),
        F.count(F.lit(1)).alias("__rows"),
    )
    values = "transform(__points, p -> p.v)"
    changed = f"size(filter(zip_with({values}, slice({values}, 2, size(__points)), (a, b) -> a <> b), c -> c))"
    months = months.select(
        entity,
        "__month",
        F.expr(changed).alias("__inside"),
        F.expr("__points[0].v").alias("__first"),
        F.expr("element_at(__points, -1).v").alias("__last"),
        "__sum",
        "__count",
        "__rows",
    )
    across = Window.partitionBy(entity).orderBy("__month")
    seam = F.col("__first") != F.col("__before")
    return (
        months.withColumn("__before", F.lag("__last").over(across))
        .groupBy(entity)
        .agg(
            (F.sum("__inside") + F.count_if(seam)).alias(out),
            F.sum("__sum").alias("value_sum"),
            F.sum("__count").alias("n_values"),
            F.sum("__rows").alias("n_rows"),
        )
    )
