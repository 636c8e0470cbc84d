"""Top-N per group and global ranks that never bring all rows into one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from roomledger.operators.blocks import with_blocks
from roomledger.operators.joins import (
    all_columns,
    hot_key_limit,
    left_slot,
    null_safe_join,
    right_slot,
    split_join,
)

BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class SortKey:
    """A column and a direction. Nulls come first ascending and last descending.

    ``max_distinct`` states a proven limit on the number of different values.
    """

    name: str
    descending: bool = False
    max_distinct: int | None = None

    @property
    def column(self) -> Column:
        c = F.col(self.name)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_first()


def asc(name: str, max_distinct: int | None = None) -> SortKey:
    return SortKey(name, False, max_distinct)


def desc(name: str, max_distinct: int | None = None) -> SortKey:
    return SortKey(name, True, max_distinct)


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[SortKey],
    n: int,
    method: str = "dense_rank",
    rank_col: str = "rnk",
    max_groups: int | None = None,
) -> DataFrame:
    """Rows whose rank within their group is at most ``n``, with the rank as a long.

    ``dense_rank`` keeps all ties, so it ranks the distinct order values first: every
    task then forwards at most ``n`` values per group, however many rows are tied. The
    winning values find their rows through a join. It is a broadcast when the number of
    groups is known to be small (``max_groups``, or no group at all); otherwise rows of a
    value that many share, winning or not, are spread over all tasks.

    ``row_number`` keeps exactly ``n`` rows and needs an order without ties.
    """
    keys = [*group, *[k.name for k in order]]
    window = Window.partitionBy(*group).orderBy(*[k.column for k in order])
    if method == "row_number":
        rank = F.row_number().over(window)
        return df.withColumn(rank_col, rank).filter(F.col(rank_col) <= n).withColumn(
            rank_col, F.col(rank_col).cast("bigint")
        )
    if method != "dense_rank":
        raise ValueError(f"method must be dense_rank or row_number, not {method!r}")

    groups = max_groups if group else 1
    if groups is not None and groups * n <= BROADCAST_ROWS:
        winners = _winners(distinct_keys(df, keys), window, n, rank_col).drop("__rows")
        return null_safe_join(df, F.broadcast(winners), keys)
    # As structs the keys are never null. The grouping that ranks has counted their rows.
    rows = _keyed(df, order, group)
    counted = distinct_keys(rows, [GROUP, KEY])
    fields = [F.col(f"{KEY}.k{i}") for i in range(len(order))]
    in_order = [c.desc_nulls_last() if k.descending else c.asc_nulls_first() for c, k in zip(fields, order)]
    winners = _winners(counted, Window.partitionBy(GROUP).orderBy(*in_order), n, rank_col)
    counts = counted.withColumnRenamed("__rows", "__n")
    found = split_join(rows, winners.drop("__rows"), [GROUP, KEY], counts=counts)
    return found.select(*df.columns, rank_col)


def _winners(keys: DataFrame, window: WindowSpec, n: int, rank_col: str) -> DataFrame:
    ranked = keys.withColumn(rank_col, F.dense_rank().over(window)).filter(F.col(rank_col) <= n)
    return ranked.withColumn(rank_col, F.col(rank_col).cast("bigint"))


def global_dense_rank(
    df: DataFrame,
    order: Sequence[SortKey],
    rank_col: str = "rnk",
    by: Sequence[str] = (),
    block_keys: int | None = None,
) -> DataFrame:
    """``dense_rank`` of all rows (per ``by``, if given) as a long, without a global sort.

    The distinct order values are cut into ordered blocks. The rank of a value is the number of
    values in earlier blocks (of its group) and its place within the block, so a task sorts
    about ``block_keys`` values however they are distributed, and only the counts of blocks
    are added up. Any type that Spark orders will do; floating-point values rank as they are,
    so round what is summed up. A key with few values (``max_distinct``) is one block.

    Ranks then find their rows by a join, in which a value shared by very many rows is
    handled apart: fewer than ``hot_key_limit`` such ranks are broadcast.
    """
    ranks, rows = _rank_table(df, order, by, block_keys)
    bounded = not by and len(order) == 1 and _is_small(order[0])
    return _attach_rank(rows, ranks, rank_col, bounded).select(*df.columns, rank_col)


def _is_small(key: SortKey) -> bool:
    return key.max_distinct is not None and key.max_distinct <= BROADCAST_ROWS


KEY, GROUP = "__key", "__group"


def _keyed(df: DataFrame, order: Sequence[SortKey], by: Sequence[str]) -> DataFrame:
    """Order values and group as two structs, which are never null themselves."""
    values = F.struct(*[F.col(f"`{k.name}`").alias(f"k{i}") for i, k in enumerate(order)])
    group = F.struct(F.lit(0).alias("g"), *[F.col(f"`{c}`").alias(f"g{i}") for i, c in enumerate(by)])
    return df.withColumns({KEY: values, GROUP: group} if by else {KEY: values})


def distinct_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key once with its number of ``__rows``; planned alike wherever it is used.

    The filter holds no row back; it keeps the columns from being pruned in one of the places.
    """
    found = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), all_columns(rows))
    return found.filter("__seen IS NOT NULL AND __rows > 0").drop("__seen")


def _rank_table(
    df: DataFrame, order: Sequence[SortKey], by: Sequence[str], block_keys: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rank of every key with its number of rows and that of all rows; the rows with their key."""
    rows = _keyed(df, order, by)
    down = [k.descending for k in order]
    groups = [GROUP] if by else []
    keys = distinct_keys(rows, [*groups, KEY])
    if not by and len(order) == 1 and _is_small(order[0]):
        position = F.row_number().over(Window.orderBy(F.col(KEY).desc() if down[0] else F.col(KEY).asc()))
        return keys.select(KEY, position.cast("long").alias("__rank"), "__rows"), rows
    if by:  # groups stand in the direction of the first key; only their togetherness counts
        whole = F.struct(F.col(GROUP).alias("g"), F.col(f"{KEY}.*"))
        cut, n_rows = with_blocks(keys.withColumn("__whole", whole), "__whole", [down[0], *down], "__rows", block_keys)
        cut = cut.drop("__whole")
    else:
        cut, n_rows = with_blocks(keys, KEY, down, "__rows", block_keys)
    earlier = Window.partitionBy(*groups).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*groups, "__block")
        .agg(F.count(F.lit(1)).alias("__values"))
        .select(*groups, "__block", F.coalesce(F.sum("__values").over(earlier), F.lit(0)).alias("__offset"))
    )
    fields = [F.col(f"{KEY}.k{i}") for i in range(len(order))]
    in_order = [c.desc_nulls_last() if d else c.asc_nulls_first() for c, d in zip(fields, down)]
    place = F.row_number().over(Window.partitionBy(*groups, "__block").orderBy(*in_order))
    ranks = cut.withColumn("__place", place).join(offsets, [*groups, "__block"])
    return ranks.select(*groups, KEY, (F.col("__offset") + F.col("__place")).alias("__rank"), "__rows", n_rows.alias("__total")), rows


def _attach_rank(rows: DataFrame, ranks: DataFrame, rank_col: str, bounded: bool) -> DataFrame:
    key = [c for c in (GROUP, KEY) if c in ranks.columns]
    if bounded:
        found = F.broadcast(ranks.selectExpr(*key, f"__rank AS `{rank_col}`"))
        return rows.join(found, key)
    # Both sides read the same columns, so that their shuffles are one.
    is_hot = F.col("__rows") * hot_key_limit(rows) > F.col("__total")
    hot = ranks.filter(is_hot).selectExpr(*key, "__rank AS __hot_rank")
    slot = left_slot(rows.columns, key, "__hot_rank IS NOT NULL")
    routed = rows.join(F.broadcast(hot), key, "left").selectExpr("*", f"{slot} AS __slot")
    cold = ranks.filter(~is_hot).selectExpr(*key, "__rank", f"{right_slot(key)} AS __slot")
    return routed.join(cold, [*key, "__slot"], "left").withColumn(
        rank_col, F.coalesce("__hot_rank", "__rank")
    )


def rank_sum_bottom_k(
    df: DataFrame, keys: Sequence[SortKey], k: int, tie_break: Sequence[str]
) -> DataFrame:
    """The ``k`` rows with the smallest sum of dense ranks, one rank per key."""
    ranked = df
    for i, key in enumerate(keys):
        # each rank is that of the rows themselves, so the earlier ones ride along
        ranks, rows = _rank_table(df, [key], ())
        carried = _keyed(ranked, [key], ())
        ranked = _attach_rank(carried, ranks, f"__rank{i}", _is_small(key)).select(*ranked.columns, f"__rank{i}")
    total = sum((F.col(f"__rank{i}") for i in range(1, len(keys))), F.col("__rank0"))
    return (
        ranked.withColumn("__rank_sum", total)
        .orderBy("__rank_sum", *tie_break)
        .limit(k)
        .select(*df.columns)
    )
