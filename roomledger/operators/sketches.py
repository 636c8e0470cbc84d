"""Mergeable sketches: approximate quantiles and distinct counts in bounded memory.

The exact operators are the default everywhere. A sketch is for tables that are kept and merged:
one per listing and month answers for any listing, group or period without the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of a quantile sketch. A quantile is off by at most RANK_ERROR of the rows, in 99 of 100.
QUANTILE_SIZE = 800
RANK_ERROR = 0.005
# Logarithm of the registers of a distinct sketch (16 kB); three standard errors of the count.
DISTINCT_SIZE = 14
DISTINCT_ERROR = 0.025


def quantile_sketch(value: Column | str) -> Column:
    """Aggregate: a KLL sketch of the non-null values, as doubles."""
    column = F.col(value) if isinstance(value, str) else value
    return F.kll_sketch_agg_double(column.cast("double"), QUANTILE_SIZE)


def merged_quantile_sketch(sketch: Column | str) -> Column:
    """Aggregate: the sketch of all values of the given sketches."""
    return F.kll_merge_agg_double(sketch, QUANTILE_SIZE)


def sketched_quantile(sketch: Column | str, fraction: float) -> Column:
    """The value of a sketch at a fraction; null if it holds no value."""
    column = F.col(sketch) if isinstance(sketch, str) else sketch
    holds = F.kll_sketch_get_n_double(column) > 0
    return F.when(holds, F.kll_sketch_get_quantile_double(column, F.lit(float(fraction))))


def approximate_quantiles(
    df: DataFrame, value: str, fractions: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Named quantiles per group from one mergeable sketch of each group.

    A task holds one sketch of bounded size for each of its groups, however many rows or equal
    values they have, and sends it instead of them. The value found stands within
    ``RANK_ERROR`` of the rows from the asked position; of few rows it is exact. Null values
    are left out; a group without values has null quantiles.
    """
    sketches = df.groupBy(*by).agg(quantile_sketch(value).alias("__sketch"))
    return sketches.select(*by, *[sketched_quantile("__sketch", f).alias(name) for name, f in fractions.items()])


def distinct_sketch(value: Column | str) -> Column:
    """Aggregate: a HyperLogLog sketch of the different non-null values."""
    return F.hll_sketch_agg(value, DISTINCT_SIZE)


def merged_distinct_sketch(sketch: Column | str) -> Column:
    """Aggregate: the sketch of the values of all given sketches."""
    return F.hll_union_agg(sketch)


def sketched_count(sketch: Column | str) -> Column:
    """How many different values a sketch has seen, within ``DISTINCT_ERROR`` of the number."""
    return F.hll_sketch_estimate(sketch)
