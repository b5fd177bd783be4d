"""Exact medians of the items that overlap each range, without pairing ranges with items.

The items that overlap ``[lo, hi)`` are those that start before ``hi`` less those that have ended by ``lo``. So a rank among them follows
from two prefix counts per value interval, one over starts and one over ends, and the wanted value is found by going down
the digits of the values.

Ranges of up to ``reach`` lie within a block of twice that length. There both sequences are wavelet matrices in the memory of a task, and all
ranges of the block go down bit by bit at once. Ranges up to 8 times as long do the same in blocks that are so much longer, unless
a block holds too many items for a task. All other ranges go down together on Spark, four bits a round: each asks for the digits
of its node at its two ends, whatever its length. Rows moved are those of items per width of blocks in use, or of items and ranges per round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riftspan.functions.interval import int_div
from riftspan.operators.ordered import global_row_number
from riftspan.operators.prefix import sums_below
from riftspan.session import reliable_checkpoint

#: Longest range that is answered within one block of the first level.
REACH = 1 << 18
#: Ranges of one block that one task answers; a block of more is dealt over several.
RANGES_PER_TASK = 1_000_000
#: Blocks grow by this power of two a level, and there are so many levels above the first.
WIDER_BITS, WIDER_LEVELS = 3, 1
#: Items that a block above the first level may hold; ranges of one with more go down in rounds.
ITEMS_PER_BLOCK = 250_000
#: Bits that long ranges go down in a round.
DIGIT = 4


class WaveletMatrix:
    """Numbers in a fixed order, such that values below a bit prefix can be counted for any stretch of it."""

    def __init__(self, numbers: np.ndarray, bits: int) -> None:
        self.zeros: list[np.ndarray] = []
        for bit in range(bits - 1, -1, -1):
            ones = (numbers >> bit & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~ones)]))
            numbers = np.concatenate([numbers[~ones], numbers[ones]])

    def below(self, level: int, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` of a level goes if its bit is zero."""
        return self.zeros[level][at]

    def above(self, level: int, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` of a level goes if its bit is one."""
        return self.zeros[level][-1] + at - self.zeros[level][at]


def ranked_difference(by_start: np.ndarray, by_end: np.ndarray, started: np.ndarray, ended: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The number of each zero-based ``rank`` among the first ``started`` of ``by_start`` less the first ``ended`` of ``by_end``."""
    bits = max(1, int(by_start.max(initial=0)).bit_length())
    matrices = WaveletMatrix(by_start, bits), WaveletMatrix(by_end, bits)
    stretches = [(np.zeros_like(started), started), (np.zeros_like(ended), ended)]
    rank, found = rank.copy(), np.zeros_like(rank)
    for level in range(bits):
        down = [(m.below(level, a), m.below(level, b)) for m, (a, b) in zip(matrices, stretches)]
        zeros = (down[0][1] - down[0][0]) - (down[1][1] - down[1][0])
        one = rank >= zeros
        rank -= np.where(one, zeros, 0)
        found = found << 1 | one
        up = [(m.above(level, a), m.above(level, b)) for m, (a, b) in zip(matrices, stretches)]
        stretches = [(np.where(one, u[0], d[0]), np.where(one, u[1], d[1])) for u, d in zip(up, down)]
    return found


def _in_block(items: pa.Table, ranges: pa.Table) -> pa.Table:
    """Medians of the ranges of one block."""
    if not items.num_rows or not ranges.num_rows:
        return _FOUND.empty_table()
    start, end = (np.asarray(items.column(c)) for c in ("start", "end"))
    value = items.column("value").to_numpy()
    known = ~np.asarray(items.column("value").is_null())
    lo, hi = (np.asarray(ranges.column(c)) for c in ("lo", "hi"))

    def counted(s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.searchsorted(np.sort(s), hi, "left"), np.searchsorted(np.sort(e), lo, "right")

    started, ended = counted(start, end)
    n = started - ended
    started, ended = counted(start[known], end[known])
    values, numbers = np.unique(value[known], return_inverse=True)  # not-a-number comes last, as in Spark
    by_start = numbers[np.argsort(start[known], kind="stable")]
    by_end = numbers[np.argsort(end[known], kind="stable")]
    of_known = started - ended
    median = np.full(len(lo), np.nan)
    some = of_known > 0
    if some.any():
        low, high = (
            values[ranked_difference(by_start, by_end, started[some], ended[some], rank)] for rank in ((of_known[some] - 1) // 2, of_known[some] // 2)
        )
        median[some] = np.where(low == high, low, 0.5 * low + 0.5 * high)
    hit = np.flatnonzero(n)
    group = ranges.column("grp").take(pa.array(hit))
    series = pa.array([items.column("series")[0].as_py()] * len(hit), pa.string())
    medians = pa.array(median[hit], pa.float64(), mask=~some[hit])
    return pa.table([group, series, pa.array(lo[hit]), pa.array(hi[hit]), pa.array(n[hit], pa.int64()), medians], schema=_FOUND)


_FOUND = pa.schema([("grp", pa.string()), ("series", pa.string()), ("lo", pa.int64()), ("hi", pa.int64()), ("n", pa.int64()), ("median", pa.float64())])


def _width(reach: int) -> F.Column:
    width = F.lit(reach).cast("long")
    for k in range(1, WIDER_LEVELS + 1):
        width = F.when(F.col("level") >= k, F.lit(reach << WIDER_BITS * k).cast("long")).otherwise(width)
    return width


def _blocks_touched(start: F.Column, end: F.Column, width: F.Column) -> F.Column:
    zero = F.lit(0).cast("long")
    return F.sequence(F.greatest(int_div(start, width) - 1, zero), int_div(F.greatest(end - 1, zero), width))


def _level(reach: int) -> F.Column:
    """The first level of which a block may hold the range; one more than there are if none may."""
    length, level = F.col("hi") - F.col("lo"), F.lit(WIDER_LEVELS + 1)
    for k in range(WIDER_LEVELS, -1, -1):
        level = F.when(length <= reach << WIDER_BITS * k, k).otherwise(level)
    return level


def _crowded(items: DataFrame, reach: int, levels: list[int]) -> DataFrame:
    """``grp``, ``level``, ``block`` of the blocks above the first level with more than ``ITEMS_PER_BLOCK`` items of a series; few by that bound."""
    # Cells of the first level decide the blocks of all, so items are counted by them first.
    zero = F.lit(0).cast("long")
    cells = items.groupBy("grp", "series", int_div(F.greatest(F.col("start"), zero), reach).alias("_f"), int_div(F.greatest(F.col("end") - 1, zero), reach).alias("_l")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    at = cells.withColumn("level", F.explode(F.array(*[F.lit(k) for k in levels])))
    block = F.explode(_blocks_touched(F.col("_f"), F.col("_l") + 1, _width(1)))
    per_block = at.select("grp", "series", "level", block.alias("block"), "_n").groupBy("grp", "series", "level", "block").agg(F.sum("_n").alias("_n"))
    return per_block.filter(F.col("_n") > ITEMS_PER_BLOCK).select("grp", "level", "block").distinct()


def _short(ranges: DataFrame, items: DataFrame, reach: int, levels: list[int], most: int) -> DataFrame:
    """Ranges within a block: block ``b`` of a level holds what touches ``[b * width, (b + 2) * width)``."""
    laid_out = items.withColumn("level", F.explode(F.array(*[F.lit(k) for k in levels])))
    laid_out = laid_out.withColumn("block", F.explode(_blocks_touched(F.col("start"), F.col("end"), _width(reach))))
    asked = ranges
    key = ["grp", "level", "block"]
    if most > RANGES_PER_TASK:
        parts = asked.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / F.lit(RANGES_PER_TASK)).cast("int").alias("_parts"))
        asked = asked.join(parts, key).withColumn("part", F.pmod(F.xxhash64("lo", "hi"), F.col("_parts")).cast("int"))
        laid_out = laid_out.join(parts, key).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        key = [*key, "part"]
    with_series = asked.withColumn("series", F.explode(F.array(*[F.lit(s) for s in _series(items)])))
    left = laid_out.select(*key, "series", "start", "end", "value").groupBy(*key, "series")
    return left.cogroup(with_series.select(*key, "series", "lo", "hi").groupBy(*key, "series")).applyInArrow(_in_block, _SCHEMA)


_SCHEMA = "grp string, series string, lo bigint, hi bigint, n bigint, median double"


def _series(items: DataFrame) -> list[str]:
    return sorted(r[0] for r in items.select("series").distinct().collect())  # a few names, given by the caller


def _bound(kind: str, sign: int, at) -> F.Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(sign).alias("sign"), at.alias("_x"))


def _differences(asked: DataFrame, key: list[str], marks: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Per row of ``asked``: sums of ``columns`` over items that started before ``hi`` less those that ended by ``lo``."""
    bounds = F.explode(F.array(_bound("start", 1, F.col("hi")), _bound("end", -1, F.col("lo") + 1))).alias("_b")
    ends = asked.select(*dict.fromkeys([*key, *by]), bounds).select("*", "_b.kind", "_b.sign", "_b._x").drop("_b")
    own = [*by, "kind"]
    zeros = [F.lit(0).cast("long").alias(c) for c in columns]
    below = sums_below(marks.select(*own, "_x", *columns).unionByName(ends.select(*own, "_x", *zeros)), own, columns)
    return ends.join(below, [*own, "_x"]).groupBy(*key).agg(*[F.sum(F.col("sign") * F.col(c)).alias(c) for c in columns])


def _long(ranges: DataFrame, items: DataFrame) -> DataFrame:
    """Ranges of any length, four bits of the values' numbers a round."""
    values = global_row_number(items.filter("value is not null").select("value").distinct(), ["value"], "_row").select(
        "value", (F.col("_row") - 1).alias("code")
    )
    values = reliable_checkpoint(values)
    last = values.agg(F.max("code")).first()[0]
    steps = max(1, -(-int(last or 0).bit_length() // DIGIT))
    ends = F.explode(
        F.array(
            F.struct(F.lit("start").alias("kind"), F.col("start").alias("_x")),
            F.struct(F.lit("end").alias("kind"), F.col("end").alias("_x")),
        )
    )
    marks = items.join(values, "value", "left").select("grp", "series", "code", ends.alias("_e")).select("grp", "series", "code", "_e.*")
    marks = reliable_checkpoint(marks.groupBy("grp", "series", "code", "kind", "_x").agg(F.count(F.lit(1)).alias("_n")))
    series = ranges.withColumn("series", F.explode(F.array(*[F.lit(s) for s in _series(items)])))
    key = ["grp", "series", "lo", "hi"]
    counts = _differences(series, key, marks.withColumn("_known", F.when(F.col("code").isNotNull(), F.col("_n")).otherwise(0)), ["grp", "series"], ["_n", "_known"])
    counts = reliable_checkpoint(counts.filter("_n > 0"))
    rank = F.explode(F.array_distinct(F.array(F.expr("(_known - 1) div 2"), F.expr("_known div 2"))))
    asked = counts.filter("_known > 0").select(*key, rank.alias("want")).withColumns({"rank": F.col("want"), "node": F.lit(0).cast("long")})
    digits = [f"_d{i}" for i in range(1 << DIGIT)]
    known = marks.filter("code is not null")
    for step in range(steps):
        shift = DIGIT * (steps - 1 - step)
        node, digit = F.shiftright("code", shift + DIGIT), F.shiftright("code", shift).bitwiseAND(F.lit((1 << DIGIT) - 1))
        split = known.withColumn("node", node).select(
            "grp", "series", "node", "kind", "_x", *[F.when(digit == i, F.col("_n")).otherwise(F.lit(0).cast("long")).alias(d) for i, d in enumerate(digits)]
        )
        if step:  # only nodes that a range has come to
            split = split.join(asked.select("grp", "series", "node").distinct(), ["grp", "series", "node"], "left_semi")
        by_digit = _differences(asked, [*key, "want", "rank", "node"], split, ["grp", "series", "node"], digits)
        below = F.array(*[sum((F.col(d) for d in digits[:i]), F.lit(0).cast("long")) for i in range(1 << DIGIT)])
        asked = by_digit.withColumn("_below", below).withColumn("_digit", F.size(F.filter("_below", lambda b: b <= F.col("rank"))) - 1)
        asked = asked.select(
            *key,
            "want",
            (F.col("rank") - F.get("_below", F.col("_digit"))).alias("rank"),
            (F.shiftleft("node", DIGIT) + F.col("_digit")).alias("node"),
        )
        asked = reliable_checkpoint(asked)
    at = asked.join(values.withColumnRenamed("code", "node"), "node")
    low, high = F.min_by("value", "want"), F.max_by("value", "want")
    medians = at.groupBy(*key).agg(F.when(low == high, low).otherwise(0.5 * low + 0.5 * high).alias("median"))
    return counts.join(medians, key, "left").select(*key, F.col("_n").alias("n"), "median")


def overlap_medians(ranges: DataFrame, items: DataFrame, group: str, reach: int = REACH) -> DataFrame:
    """``group``, ``lo``, ``hi``, ``series``, ``n``, ``median`` for each distinct range and series that has overlapping items.

    ``ranges`` has ``group``, ``lo``, ``hi`` and no row twice; ``items`` has ``group``, ``series`` (a few names), ``start``, ``end`` and a double ``value``.
    ``n`` counts all overlapping items, the median goes over those with a value (the mean of the middle two), and is NULL if there is
    none. Empty ranges and items overlap nothing. ``reach`` is half the length of a block of the first level.
    """
    ranges = ranges.select(F.col(group).cast("string").alias("grp"), F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"))
    ranges = ranges.filter("grp is not null and hi > lo")
    items = items.select(
        F.col(group).cast("string").alias("grp"), "series", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "value"
    ).filter(F.col("end") > F.col("start"))
    ranges = ranges.withColumn("level", _level(reach)).withColumn("block", int_div(F.greatest(F.col("lo"), F.lit(0).cast("long")), _width(reach)))
    is_long = (F.col("level") > WIDER_LEVELS) | (F.col("lo") < 0)
    used = ranges.filter(~is_long).groupBy("grp", "level", "block").count().groupBy("level").agg(F.max("count")).collect()  # a row per level
    levels = sorted(level for level, _ in used)
    if wider := [level for level in levels if level]:
        crowded = reliable_checkpoint(_crowded(items, reach, wider).withColumn("_crowded", F.lit(True)))
        ranges = ranges.join(F.broadcast(crowded), ["grp", "level", "block"], "left")
        is_long = is_long | F.col("_crowded").isNotNull()
    found = None
    if levels:
        found = _short(ranges.filter(~is_long), items, reach, levels, max(most for _, most in used))
    long = ranges.filter(is_long).select("grp", "lo", "hi")
    if not levels or not long.isEmpty():
        rest = _long(long, items).select("grp", "series", "lo", "hi", "n", "median")
        found = rest if found is None else found.unionByName(rest)
    return found.select(F.col("grp").alias(group), "lo", "hi", "series", "n", "median")
