"""Exact quantiles without a sort of all values, and binning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.operators.blocks import with_blocks
from roomledger.operators.joins import null_safe_join
from roomledger.operators.ranking import distinct_keys


def _values_at_ranks(
    df: DataFrame, value: str, by: Sequence[str], ranks: Mapping[str, str], block_keys: int | None = None
) -> DataFrame:
    """Values at given positions among the sorted non-null values, one row per group.

    ``ranks`` maps an output name to a position, as SQL in terms of ``__total``, the
    number of values. Equal values are counted once; the distinct ones are cut into ordered
    blocks. The counts of blocks find the block that holds a position, and only its values
    are added up one by one.
    """
    by = list(by)
    groups = [f"__g{i}" for i in range(len(by))]
    key = [*[F.col(f"`{c}`").alias(g) for c, g in zip(by, groups)], F.col(f"`{value}`").alias("__value")]
    known = df.filter(F.col(value).isNotNull()).withColumn("__key", F.struct(*key))
    keys = distinct_keys(known, ["__key"])
    cut, _ = with_blocks(keys, "__key", [False] * (len(by) + 1), "__rows", block_keys)
    counts = cut.select("__key.*", "__block", F.col("__rows").alias("__n"))
    wanted = ", ".join(
        f"struct('{name}' AS name, CAST({rank} AS BIGINT) AS rank)" for name, rank in ranks.items()
    )
    group = f"PARTITION BY {', '.join(groups)}" if by else ""
    holders = (
        counts.groupBy(*groups, "__block")
        .agg(F.sum("__n").alias("__n"))
        .selectExpr(
            "*",
            f"sum(__n) OVER ({group} ORDER BY __block) AS __through",
            f"sum(__n) OVER ({group}) AS __total",
        )
        .selectExpr("*", f"explode(array({wanted})) AS __wanted")
        .filter("__wanted.rank > __through - __n AND __wanted.rank <= __through")
        .selectExpr(
            *groups,
            "__block",
            "__wanted.name AS __name",
            "__wanted.rank - __through + __n AS __rank",
        )
    )
    if by:
        found = null_safe_join(counts, holders, [*groups, "__block"])
    else:  # one holder per wanted rank
        found = counts.join(F.broadcast(holders), "__block")
    parent = ", ".join([*groups, "__name"])
    return (
        found.selectExpr("*", f"sum(__n) OVER (PARTITION BY {parent} ORDER BY __value) AS __through")
        .filter("__rank > __through - __n AND __rank <= __through")
        .groupBy(*groups)
        .agg(*[F.expr(f"max(CASE WHEN __name = '{n}' THEN __value END)").alias(n) for n in ranks])
        .withColumnsRenamed(dict(zip(groups, by)))
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    fractions: Mapping[str, float],
    by: Sequence[str] = (),
    block_keys: int | None = None,
) -> DataFrame:
    """Named quantiles as elements of the data: the smallest value at or past each fraction.

    Of any type that Spark orders. One row per group, or one row in all when ``by`` is empty.
    A task sorts the values of about ``block_keys`` different ones. ``sketches`` has the
    approximate form.
    """
    ranks = {
        name: f"greatest(ceil(__total * {fraction!r}D), 1)" for name, fraction in fractions.items()
    }
    return _values_at_ranks(df, value, by, ranks, block_keys)


def exact_median(df: DataFrame, value: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """Median per group: the middle value, or the mean of the two middle values.

    For groups too large to hold their distinct values in one aggregation buffer;
    ``F.median`` is the cheaper choice for many small groups.
    """
    ranks = {"__below": "(__total + 1) DIV 2", "__above": "(__total + 2) DIV 2"}
    middle = (F.col("__below") + F.col("__above")) / 2
    return _values_at_ranks(df, value, by, ranks).select(*by, middle.alias(out))


def quantile_bin(df: DataFrame, value: str, out: str | None = None) -> DataFrame:
    """Low up to the first quartile, Medium from one above it up to the median, else High.

    Values between the first quartile and one above it, and nulls, fall into High.
    """
    cuts = _cuts(df, value, {"low": 0.25, "middle": 0.5})
    v = F.col(value)
    label = (
        F.when(v <= cuts["low"], "Low")
        .when(v.between(cuts["low"] + 1, cuts["middle"]), "Medium")
        .otherwise("High")
    )
    return df.withColumn(out or f"{value}_bin", label)


def tercile_bin(df: DataFrame, value: str, out: str | None = None) -> DataFrame:
    """Low, Medium and High thirds of the values; null stays null."""
    cuts = _cuts(df, value, {"low": 1 / 3, "middle": 2 / 3})
    v = F.col(value)
    label = (
        F.when(v <= cuts["low"], "Low")
        .when(v <= cuts["middle"], "Medium")
        .when(v.isNotNull(), "High")
    )
    return df.withColumn(out or f"{value}_bin", label)


def _cuts(df: DataFrame, value: str, fractions: Mapping[str, float]) -> dict[str, Column]:
    # One scalar subquery for all cuts, so the quantiles are computed once.
    row = exact_quantiles(df, value, fractions).select(F.struct(*fractions)).scalar()
    return {name: row.getField(name) for name in fractions}


def fixed_bin(
    value: Column | str, ranges: Mapping[str, tuple[int, int]], otherwise: str | None = None
) -> Column:
    """Label of the inclusive range that holds the value."""
    v = F.col(value) if isinstance(value, str) else value
    label = F.lit(otherwise)
    for name, (low, high) in reversed(ranges.items()):
        label = F.when(v.between(low, high), name).otherwise(label)
    return label
