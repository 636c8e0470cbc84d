"""Joins that stay even when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/limit of all rows, so there are fewer than that many
# hot keys whatever the data looks like. The limit follows the number of shuffle partitions:
# a key that is not hot is a quarter of an even partition at most.
HOT_KEY_LIMIT = 1024


def hot_key_limit(df: DataFrame) -> int:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(HOT_KEY_LIMIT, 4 * partitions)


def null_safe_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join on which null keys match; the key columns come from ``left``."""
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(renamed, condition, how).drop(*[f"__r_{c}" for c in on])


def all_columns(df: DataFrame) -> Column:
    """Aggregate that reads every column of ``df``, as ``__seen``; it is never null.

    For a plan that needs its input twice, once grouped and once row by row: if both
    branches read the same columns, the shuffle below them is planned the same and run once.
    """
    return F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).alias("__seen")


def _hash(columns: Sequence[str]) -> str:
    return f"xxhash64({', '.join(f'`{c}`' for c in columns)})"


def left_slot(columns: Sequence[str], key: Sequence[str], hot: str) -> str:
    """SQL for the shuffle slot of a row: the hash of its key, spread out for hot keys.

    The slot is a join key next to the real ones, so that rows of a hot key, which have
    their partner already, do not meet in one task. Copies of a row differ by the
    partition they come from. Only the route of a row depends on its slot, never its
    partner. It is a hash on both sides because a constant would be folded away and the
    slot with it.
    """
    spread = f"{_hash(columns)} ^ (spark_partition_id() * 1000003L)"
    return f"CASE WHEN {hot} THEN {spread} ELSE {_hash(key)} END"


def right_slot(key: Sequence[str]) -> str:
    """SQL for the slot in which rows without a partner look for one."""
    return _hash(key)


def split_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` with ``right``, which holds at most one row per key.

    Rows of hot keys meet their partner through a broadcast of fewer than
    ``hot_key_limit`` rows and then travel spread over all tasks of the shuffle; all other
    rows take the ordinary shuffle join, where no key is hot. The two parts together
    are the whole join: nothing is dropped or capped.

    ``counts`` may hold the keys and, as ``__n``, their rows of ``left``, where the caller has
    counted them anyway. Null keys never match; their rows are spread over all tasks as well. ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"split_join supports inner and left joins, not {how!r}")
    on = list(on)
    payload = [c for c in right.columns if c not in on]
    with_key = " AND ".join(f"`{c}` IS NOT NULL" for c in on)
    if how == "inner":
        left = left.filter(with_key)
    if counts is None:
        counts = left.filter(with_key).groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    threshold = counts.agg((F.sum("__n") / hot_key_limit(left)).alias("rows")).scalar()
    hot_keys = counts.filter(F.col("__n") > threshold).select(*on)

    partners = right.select(*on, F.struct(F.lit(True).alias("__found"), *payload).alias("__cold"))
    hot_partners = partners.join(F.broadcast(hot_keys), on, "left_semi")
    hot = hot_keys.join(hot_partners, on, "left").selectExpr(
        *on, "__cold AS __hot", "TRUE AS __is_hot"
    )
    without_key = " OR ".join(f"`{c}` IS NULL" for c in on)
    routed = left.join(F.broadcast(hot), on, "left").withColumn(
        "__slot", F.expr(left_slot(left.columns, on, f"__is_hot OR {without_key}"))
    )
    cold = partners.withColumn("__slot", F.expr(right_slot(on)))
    joined = routed.join(cold, [*on, "__slot"], "left")
    joined = joined.withColumn("__match", F.expr("CASE WHEN __is_hot THEN __hot ELSE __cold END"))
    if how == "inner":
        joined = joined.filter("__match IS NOT NULL")
    return joined.selectExpr(
        *[f"`{c}`" for c in left.columns], *[f"__match.`{c}` AS `{c}`" for c in payload]
    )
