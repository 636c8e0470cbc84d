"""Cleaning of the raw listings, calendar and reviews tables.

``strict=False`` follows the established rules of the export (a price with a thousands
sign is unreadable, an unknown flag is true, list elements stay untrimmed, listings
without calendar rows are dropped). ``strict=True`` reads every value for what it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.functions.text import (
    clean_comment,
    clean_text,
    list_size,
    na_to_null,
    nth_part,
    parse_flag,
    parse_list,
    parse_list_strict,
    parse_percent,
    parse_price,
    parse_whole_number,
)
from roomledger.operators.metrics import impute_prices

# The columns of the export that hold each kind of text.
LISTING_FLAG_COLUMNS = (
    "has_availability",
    "host_has_profile_pic",
    "host_identity_verified",
    "instant_bookable",
)
LISTING_PROSE_COLUMNS = ("description", "neighborhood_overview")
LISTING_LIST_COLUMNS = ("host_verifications", "amenities")
PERCENT_SUFFIX = "rate"
ID_MARK = "id"


def clean_price(df: DataFrame, strict: bool = False) -> DataFrame:
    return df.withColumn("price", parse_price("price", thousands=strict))


def flags_to_bool(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """Parse the flag columns that exist."""
    present = [c for c in dict.fromkeys(columns) if c in df.columns]
    return df.withColumns({c: parse_flag(c, keep_unknown=strict) for c in present})


def parse_lists(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    parse = parse_list_strict if strict else parse_list
    return df.withColumns({c: parse(c) for c in columns})


def split_location(df: DataFrame) -> DataFrame:
    """``host_location`` as ``host_city`` and ``host_state``."""
    return df.withColumns(
        {"host_city": nth_part("host_location", 1), "host_state": nth_part("host_location", 2)}
    ).drop("host_location")


def nulls_for_na(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null for "N/A" in the given text columns, by default in all of them.

    Looking for the columns that hold the marker first would read the table once more
    and change nothing: the others have no value to replace.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    chosen = text if columns is None else [c for c in columns if c in text]
    return df.withColumns({c: na_to_null(c) for c in chosen})


def clean_prose(df: DataFrame, columns: Sequence[str] = LISTING_PROSE_COLUMNS) -> DataFrame:
    return df.withColumns({c: clean_text(c) for c in columns})


def parse_percents(df: DataFrame) -> DataFrame:
    """Every column whose name ends in "rate" as a whole number."""
    rates = [c for c in df.columns if c.endswith(PERCENT_SUFFIX)]
    return df.withColumns({c: parse_percent(c) for c in rates})


def rename_neighbourhoods(df: DataFrame) -> DataFrame:
    """The cleansed neighbourhood columns take the place of the raw one."""
    return df.drop("neighbourhood").withColumnsRenamed(
        {
            "neighbourhood_cleansed": "neighbourhood",
            "neighbourhood_group_cleansed": "neighbourhood_group",
        }
    )


def columns_containing(df: DataFrame, text: str) -> DataFrame:
    """Names of the columns with a value that contains the text, one per row.

    One aggregation finds them all.
    """
    hits = df.agg(
        *[
            F.coalesce(F.bool_or(F.contains(F.col(c).cast("string"), F.lit(text))), F.lit(False)).alias(c)
            for c in df.columns
        ]
    )
    return (
        hits.unpivot([], list(df.columns), "column_name", "found")
        .filter("found")
        .select("column_name")
    )


def clean_listings(listings: DataFrame, calendar: DataFrame, strict: bool = False) -> DataFrame:
    """Typed listings with prices imputed from a cleaned calendar."""
    listings = (
        listings.transform(clean_prose)
        .transform(parse_percents)
        .transform(rename_neighbourhoods)
        .transform(clean_price, strict)
        .transform(nulls_for_na)
        .transform(parse_lists, LISTING_LIST_COLUMNS, strict)
        .transform(split_location)
        .transform(flags_to_bool, LISTING_FLAG_COLUMNS, strict)
        .drop("reviews_per_month")
    )
    size = list_size("amenities", null_size=None if strict else -1)
    return impute_prices(
        listings.withColumn("n_amenities", size), calendar, keep_unmatched=strict
    )


def clean_calendar(calendar: DataFrame, strict: bool = False) -> DataFrame:
    return calendar.transform(clean_price, strict).transform(flags_to_bool, ["available"], strict)


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """Long ids, a date, and comments as one line of text."""
    ids = [
        f.name
        for f in reviews.schema.fields
        if ID_MARK in f.name and not isinstance(f.dataType, T.LongType)
    ]
    return reviews.withColumns({c: parse_whole_number(c) for c in ids}).withColumns(
        {"date": F.col("date").try_cast("date"), "comments": clean_comment("comments")}
    )
