"""Comparisons between groups of an already aggregated table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.functions.numbers import exact_mean, rounded
from roomledger.operators.joins import null_safe_join


def spread_by_group(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Largest minus smallest value within the group, on every row; null groups go."""
    window = Window.partitionBy(group)
    spread = F.max(value).over(window) - F.min(value).over(window)
    return df.filter(F.col(group).isNotNull()).withColumn(out, rounded(spread))


def deviation_from_mean(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Value minus the mean of its group, of values of any scale."""
    window = Window.partitionBy(group)
    mean = exact_mean(F.sum(value).over(window), F.count(value).over(window))
    return df.withColumn(out, rounded(F.col(value) - mean))


def diff_from_reference_group(
    df: DataFrame, group: str, value: str, reference: str, out: str
) -> DataFrame:
    """Value minus the value of the reference group, null when there is no such group."""
    base = df.filter(F.col(group) == reference).agg(F.max(value).alias("base")).scalar()
    return df.withColumn(out, rounded(F.col(value) - base))


def weighted_score_ratio(
    df: DataFrame, value: str, weights: Mapping[str, str], score_col: str, ratio_col: str
) -> DataFrame:
    """A weighted sum of columns, and the value per unit of that score.

    Weights are decimal literals such as ``"0.6"``, so the score is exact. The ratio is
    null where the score is zero or null.
    """
    terms = [F.col(c) * F.lit(w).cast("decimal(4,2)") for c, w in weights.items()]
    score: Column = terms[0]
    for term in terms[1:]:
        score = score + term
    return df.withColumn(score_col, rounded(score)).withColumn(
        ratio_col, rounded(F.try_divide(F.col(value), F.col(score_col)))
    )


def few_values(column: Column | str) -> Column:
    """Aggregate: how many different non-null values there are, for attributes of a small domain.

    The buffer holds the values, so it is bounded by the domain (room types, neighbourhoods);
    several of them stand in one aggregation without repeating its rows.
    """
    return F.size(F.collect_set(column))


def distinct_counts(df: DataFrame, by: Sequence[str], counts: Mapping[str, str]) -> DataFrame:
    """Different non-null values of several columns per group, whatever their number.

    The rows are reduced once to the different combinations of all columns; each count then
    groups those by its own column and adds up, so no row is repeated and equal values are
    merged before they are sent. ``counts`` maps output names to columns.
    """
    by = list(by)
    finest = df.groupBy(*by, *dict.fromkeys(counts.values())).agg(F.count(F.lit(1)).alias("__n"))
    finest = finest.filter("__n > 0")
    found = None
    for out, column in counts.items():
        values = finest.groupBy(*by, column).agg(F.sum("__n").alias("__n"))
        one = values.groupBy(*by).agg(F.count(column).alias(out))
        found = one if found is None else null_safe_join(found, one, by)
    return found


def segment_compare(
    df: DataFrame,
    segment: str,
    means: Mapping[str, str],
    digits: int = 2,
    weight: str | None = None,
    counts: Mapping[str, str] | None = None,
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rounded means, optionally weighted, and distinct counts per segment.

    ``means`` and ``counts`` map output names to input columns, ``also`` to further aggregates. A weighted mean equals the
    plain mean of the rows repeated ``weight`` times, without repeating them.
    """
    exact = {f.name for f in df.schema.fields if f.dataType.typeName() == "decimal"}
    aggregates = []
    for out, column in means.items():
        if weight is None and column in exact:
            mean = exact_mean(F.sum(column), F.count(column))
        elif weight is None:
            mean = F.avg(column)
        else:
            known = F.when(F.col(column).isNotNull(), F.col(weight))
            mean = F.try_divide(F.sum(F.col(column) * F.col(weight)), F.sum(known))
        aggregates.append(rounded(mean, digits).alias(out))
    for out, column in (counts or {}).items():
        aggregates.append(F.count_distinct(column).alias(out))
    aggregates += [aggregate.alias(out) for out, aggregate in (also or {}).items()]
    return df.groupBy(segment).agg(*aggregates)
