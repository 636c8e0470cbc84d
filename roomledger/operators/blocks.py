"""Ordered blocks: distinct keys cut into pieces of about equal size without a global sort.

A sample of the keys, chosen by the hash of the key, is sorted, and evenly spaced elements of
it are the splitters. A key's block is the number of splitters at or before it, found by binary
search. The sample depends on the keys alone, so every evaluation cuts alike, whatever task
runs it or runs it again. Ranks and positions are then an offset of the block and an order
within it, and no task sees more than a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys that one task may well sort. More blocks than MOST_BLOCKS are never made: the splitters
# are carried past every key.
BLOCK_KEYS = 1 << 20
MOST_BLOCKS = 1024
# Sampled keys for each block: blocks differ in size by about a quarter. One key in 65,536 is
# sampled, so the sample of a hundred billion different keys is one and a half million.
SAMPLED = 16


def _not_after(a: Column, b: Column, fields: Sequence[str], descending: Sequence[bool]) -> Column:
    """True if struct ``a`` stands at or before ``b``; a null is smaller than any value."""
    if len(set(descending)) == 1:  # structs compare field by field
        return a >= b if descending[0] else a <= b
    found = F.lit(True)
    for name, down in reversed(list(zip(fields, descending))):
        x, y = F.struct(a.getField(name)), F.struct(b.getField(name))
        found = (x > y if down else x < y) | ((x == y) & found)
    return found


def _in_order(keys: Column, fields: Sequence[str], descending: Sequence[bool]) -> Column:
    if len(set(descending)) == 1:
        return F.sort_array(keys, asc=not descending[0])
    return F.array_sort(keys, lambda a, b: F.when(_not_after(a, b, fields, descending), F.lit(-1)).otherwise(F.lit(1)))


def with_blocks(
    keys: DataFrame,
    key: str,
    descending: Sequence[bool],
    rows: str,
    block_keys: int | None = None,
    out: str = "__block",
) -> tuple[DataFrame, Column]:
    """``keys``, distinct in the struct ``key``, with their block; and the number of all rows.

    ``descending`` has a direction for each field of ``key``, ``rows`` names the number of rows
    of each key. Blocks are numbered in the order of the keys. One aggregate over the keys gives
    both the splitters and the total, as scalars.
    """
    fields = keys.schema[key].dataType.names
    share = min(1.0, SAMPLED / (block_keys or BLOCK_KEYS))
    drawn = F.shiftrightunsigned(F.xxhash64(key), 1).cast("double") < share * float(2**63)
    sample = keys.agg(
        _in_order(F.collect_list(F.when(drawn, F.col(key))), fields, descending).alias("s"), F.sum(rows).alias("n")
    )
    apart = F.greatest(F.lit(SAMPLED), F.ceil(F.size("s") / MOST_BLOCKS).cast("int"))
    place = F.sequence(apart, F.greatest(F.size("s"), apart), apart)
    splitters = F.transform(place, lambda i: F.get("s", i - 1))
    known = sample.select(F.struct(splitters.alias("s"), "n")).scalar()
    widths = F.array(*[F.lit(1 << k) for k in reversed(range((2 * MOST_BLOCKS).bit_length()))])

    def step(at: Column, width: Column) -> Column:
        splitter = F.get("__splitters", at + width - 1)
        fits = splitter.isNotNull() & _not_after(splitter, F.col(key), fields, descending)
        return F.when(fits, at + width).otherwise(at)

    searched = F.aggregate(widths, F.lit(0), step)
    cut = keys.withColumn("__splitters", known.getField("s")).withColumn(out, searched).drop("__splitters")
    return cut, known.getField("n")
