"""Texts of all items in each range, joined in order, without pairing ranges with items.

Items are numbered in order, so a range is a stretch of numbers. A stretch no longer than a block lies within two adjacent blocks: the texts
of those two are gathered once, and the range cuts its list out of them where it meets them. So lists are made where they stay, and only
numbers and the items themselves are moved.

Longer ranges are put together. Runs of ``8^level`` items, aligned to that length, are joined once into fragments. A range takes the few
fragments that make up its stretch of numbers: at most seven on either side per level, so their number grows with the logarithm of the
items it holds (and beyond ``8^TOP_LEVEL`` items with their number over that, which bounds the size of a fragment).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riftspan.operators.ordered import global_row_number
from riftspan.operators.prefix import RangeCount, count_in_ranges
from riftspan.session import reliable_checkpoint

#: A fragment joins so many of the level below, as a power of two.
FAN_BITS = 3
#: Largest fragments: 32,768 items.
TOP_LEVEL = 5
#: Blocks of 4,096 and of 32,768 items, as powers of two; a range takes the shortest that is as long.
BLOCK_BITS = (12, 15)


def _joined(separator: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_text"))), lambda t: t["_text"]), separator)


def fragments(numbered: DataFrame, top: int, separator: str) -> DataFrame:
    """``_level``, ``_block``, ``_text`` for all levels up to ``top``, from ``_number``, ``_text`` of the items.

    At most ``8^TOP_LEVEL`` texts are gathered for a fragment.
    """
    items = numbered.select(F.lit(0).alias("_level"), F.col("_number").alias("_block"), "_text")
    if not top:
        return items
    levels = [F.struct(F.lit(i).alias("_level"), F.shiftright("_number", FAN_BITS * i).alias("_block")) for i in range(1, top + 1)]
    laid_out = numbered.select(F.explode(F.array(*levels)).alias("_u"), F.col("_number").alias("_at"), "_text")
    return items.unionByName(laid_out.groupBy("_u._level", "_u._block").agg(_joined(separator).alias("_text")))


def pieces(first: Column, stop: Column, top: int) -> Column:
    """Fragments ``(_level, _block, _at)`` that make up the numbers from ``first`` up to ``stop``; ``_at`` is their first number."""

    def run(begin: Column, end: Column) -> Column:
        return F.when(begin < end, F.sequence(begin, end - 1)).otherwise(F.expr("cast(array() as array<bigint>)"))

    def bounds(level: int) -> tuple[Column, Column]:
        return F.shiftright(first + ((1 << FAN_BITS * level) - 1), FAN_BITS * level), F.shiftright(stop, FAN_BITS * level)

    def located(level: int):
        return lambda b: F.struct(F.lit(level).alias("_level"), b.alias("_block"), F.shiftleft(b, FAN_BITS * level).alias("_at"))

    parts = []
    for level in range(top + 1):
        begin, end = bounds(level)
        own = run(begin, end)
        if level < top:
            upper_begin, upper_end = (F.shiftleft(b, FAN_BITS) for b in bounds(level + 1))
            own = F.when(upper_begin < upper_end, F.concat(run(begin, upper_begin), run(upper_end, end))).otherwise(own)
        parts.append(F.transform(own, located(level)))
    return F.concat(*parts)


def numbers_in_ranges(ranges: DataFrame, numbered: DataFrame, group: str, x: str) -> DataFrame:
    """``group``, ``lo``, ``hi`` of the ranges that have items, with the numbers of these from ``_first`` up to ``_stop``."""
    points = numbered.select(group, F.lit("item").alias("series"), x)
    wanted = [RangeCount("_first", "item", None, F.col("lo")), RangeCount("_stop", "item", None, F.col("hi"))]
    counts = count_in_ranges(ranges.select(group, "lo", "hi"), [group, "lo", "hi"], group, points, x, wanted)
    base = numbered.groupBy(group).agg(F.min("_number").alias("_base"))
    first, stop = F.col("_base") + F.col("_first"), F.col("_base") + F.col("_stop")
    return counts.filter("_first < _stop").join(base, group).select(group, "lo", "hi", first.alias("_first"), stop.alias("_stop"))


def _in_pieces(placed: DataFrame, *columns: str, top: int) -> DataFrame:
    return placed.select(*columns, F.explode(pieces(F.col("_first"), F.col("_stop"), top)).alias("_p")).select(*columns, "_p.*")


def range_pieces(ranges: DataFrame, numbered: DataFrame, group: str, x: str, top: int) -> DataFrame:
    """One row per range (``group``, ``lo``, ``hi``) and fragment that it takes; ``numbered`` has ``group``, ``x``, ``_number``."""
    return _in_pieces(numbers_in_ranges(ranges, numbered, group, x), group, "lo", "hi", top=top)


def blocks(numbered: DataFrame, levels: Sequence[int]) -> DataFrame:
    """``_level``, ``_block``, ``_texts`` in order of all items of a block and the next one, for the wanted levels of ``BLOCK_BITS``."""
    own = [F.shiftright("_number", BLOCK_BITS[level]) for level in levels]
    uses = [F.struct(F.lit(level).alias("_level"), (b - back).alias("_block")) for level, b in zip(levels, own) for back in (0, 1)]
    laid_out = numbered.select(F.explode(F.array(*uses)).alias("_u"), F.col("_number").alias("_at"), "_text").filter("_u._block >= 0")
    in_order = F.array_sort(F.collect_list(F.struct("_at", "_text")))
    return laid_out.groupBy("_u._level", "_u._block").agg(F.transform(in_order, lambda t: t["_text"]).alias("_texts"))


def with_joined(
    rows: DataFrame, items: DataFrame, group: str, x: str, order: Sequence[str], text: Column, name: str, separator: str = ";"
) -> DataFrame:
    """``rows`` with ``name``: texts of the items with ``lo <= x < hi``, ordered by ``x`` and ``order``; NULL where there is no item.

    ``rows`` has ``group``, ``lo``, ``hi`` and any other columns; ranges may come repeatedly. A NULL text is left out of its list.
    """
    known = items.filter(F.col(group).isNotNull() & F.col(x).isNotNull()).select(group, x, *order, text.alias("_text"))
    numbered = global_row_number(known, [group, x, *order], "_row").select(group, x, (F.col("_row") - 1).alias("_number"), "_text")
    place = [group, "lo", "hi"]
    found = numbers_in_ranges(rows.select(*place).distinct(), numbered, group, x)
    size = F.col("_stop") - F.col("_first")
    level, block = F.lit(len(BLOCK_BITS)), F.lit(None).cast("long")
    for k in range(len(BLOCK_BITS) - 1, -1, -1):
        fits = size <= 1 << BLOCK_BITS[k]
        level, block = F.when(fits, k).otherwise(level), F.when(fits, F.shiftright("_first", BLOCK_BITS[k])).otherwise(block)
    level = F.when(size.isNull(), -1).otherwise(level)
    placed = reliable_checkpoint(rows.join(found, place, "left").withColumns({"_level": level, "_block": block}))
    used = {r[0] for r in placed.select("_level").distinct().collect()}  # a few numbers
    result = placed.filter("_level = -1").select(*rows.columns, F.lit(None).cast("string").alias(name))
    if short := sorted(used - {-1, len(BLOCK_BITS)}):
        bits = F.get(F.array(*[F.lit(b) for b in BLOCK_BITS]), F.col("_level"))
        begin = F.col("_first") - F.call_function("shiftleft", F.col("_block"), bits) + 1
        cut = F.slice("_texts", begin.cast("int"), size.cast("int"))
        within = placed.filter(F.col("_level").isin(short)).join(blocks(numbered, short), ["_level", "_block"])
        result = result.unionByName(within.select(*rows.columns, F.array_join(cut, separator).alias(name)))
    if len(BLOCK_BITS) in used:
        long = placed.filter(F.col("_level") == len(BLOCK_BITS))
        taken = _in_pieces(long.select(*place, "_first", "_stop").distinct(), *place, top=TOP_LEVEL)
        parts = taken.join(fragments(numbered.select("_number", "_text"), TOP_LEVEL, separator), ["_level", "_block"])
        joined = parts.groupBy(*place).agg(_joined(separator).alias(name))
        result = result.unionByName(long.select(*rows.columns).join(joined, place).select(*rows.columns, name))
    return result


def joined_in_ranges(
    ranges: DataFrame, items: DataFrame, group: str, x: str, order: Sequence[str], text: Column, name: str, separator: str = ";"
) -> DataFrame:
    """``group``, ``lo``, ``hi``, ``name`` of :func:`with_joined`; only ranges that have items. No row of ``ranges`` comes twice."""
    found = with_joined(ranges.select(group, "lo", "hi"), items, group, x, order, text, name, separator)
    return found.filter(F.col(name).isNotNull())
