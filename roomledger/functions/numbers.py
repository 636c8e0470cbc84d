"""Money, exact ratios and rounding.

Sums and means of money are exact decimals, so results do not depend on the order in
which partitions are merged. Percentages are rounded once, in whole numbers. Means of
floating-point scores are cut to ten digits before the final rounding, which takes away
the summation noise and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: Column | str) -> Column:
    return _column(value).cast("decimal(18,2)")


def rounded(value: Column | str, digits: int = 2) -> Column:
    """Half-up rounding; the result is a decimal, so equal values compare equal."""
    return F.round(_column(value).cast("decimal(28,10)"), digits)


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` of two counts with two digits, half up; null without a whole."""
    whole = F.when(whole != 0, whole)
    hundredths = F.call_function("div", part * 20_000 + whole, whole * 2)
    return (hundredths.cast("decimal(16,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(18,2)")


def mean_of(total: Column | str, count: Column | str) -> Column:
    """Mean from a sum and a count, to fifteen digits; null for an empty group.

    Two different means of cent amounts lie at least ``0.01 / (n * m)`` apart, so fifteen
    digits order the means of groups of up to three million rows as their exact values would.
    """
    return F.try_divide(_column(total).cast("decimal(20,2)"), _column(count).cast("decimal(12,0)"))


def exact_mean(total: Column, count: Column) -> Column:
    """Mean from a sum and a count at the scale that the sum has; null for an empty group."""
    return F.try_divide(total, count.cast("decimal(12,0)"))


def mean_money(value: Column | str) -> Column:
    """Aggregate: the mean of amounts in cents, to fifteen digits."""
    return mean_of(F.sum(money(value)), F.count(money(value)))


def six_digits(value: Column | str) -> Column:
    """A mean to six digits: what a report shows, and what fits a sort key of bins."""
    return F.round(_column(value), 6).cast("decimal(22,6)")


def as_double(value: Column | str) -> Column:
    return _column(value).cast("double")
