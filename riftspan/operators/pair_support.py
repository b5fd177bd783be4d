"""How many templates support both ends of a variant, without moving what hits either end.

A read near one end counts only with a read of the same template near the other, so hits of both ends have to meet. Where both windows lie
within one block of the contig, they do so in the task of that block, and only counts leave it. Reads are moved once, to the blocks they
touch. Windows far apart, on two contigs or in a block of too many reads are joined with reads bin by bin, and their hits are grouped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riftspan.functions.interval import int_div
from riftspan.operators.range_join import overlap_join
from riftspan.session import reliable_checkpoint

#: A block is so many windows long; two windows that reach over at most an eighth of that share a block.
WINDOWS_PER_BLOCK = 1024
#: Reads that a block may hold; windows in one with more are joined bin by bin.
READS_PER_BLOCK = 250_000
#: Reads times windows of a block that one task answers; a block of more is dealt over several.
WORK_PER_TASK = 2_000_000_000
#: Pairs of windows of a block that one task answers.
PAIRS_PER_TASK = 500_000
#: Hits held at a time.
HITS_AT_ONCE = 4_000_000

FORWARD = "Forward"


def _supported(reads: pa.Table, pairs: pa.Table) -> pa.Table:
    """``site``, ``pe_count``, ``sr_count`` for the pairs of windows of one block."""
    schema = pa.schema([pairs.schema.field("site"), ("pe_count", pa.int64()), ("sr_count", pa.int64())])
    if not reads.num_rows or not pairs.num_rows:
        return schema.empty_table()
    start, end, signal, forward = (np.asarray(reads.column(c)) for c in ("start", "end", "signal", "forward"))
    read = reads.column("read_id").combine_chunks().dictionary_encode(null_encoding="encode").indices
    template = np.asarray(read).astype(np.int64) * 3 + signal
    templates = int(template.max()) + 1
    # Reads of like length together, so that few begin near a window without reaching it.
    size = np.ceil(np.log2(end - start)).astype(np.int64)
    groups = []
    for strand in (False, True):
        for k in np.unique(size[forward == strand]):
            own = np.flatnonzero((forward == strand) & (size == k))
            own = own[np.argsort(start[own], kind="stable")]
            groups.append((strand, 1 << int(k), start[own], end[own], template[own]))
    sides = [tuple(np.asarray(pairs.column(f"{c}{side}")) for c in ("lo", "hi", "forward")) for side in (1, 2)]

    def stretches(lo: np.ndarray, hi: np.ndarray, ahead: np.ndarray, group) -> tuple[np.ndarray, np.ndarray]:
        strand, longest, starts, *_ = group
        first = np.searchsorted(starts, lo - longest, "right")
        return first, np.where(ahead == strand, np.searchsorted(starts, hi, "left") - first, 0).clip(0)

    def hits(lo: np.ndarray, hi: np.ndarray, ahead: np.ndarray) -> np.ndarray:
        found = []
        for group in groups:
            first, n = stretches(lo, hi, ahead, group)
            pair = np.repeat(np.arange(len(lo)), n)
            at = np.arange(len(pair)) + np.repeat(first - (np.cumsum(n) - n), n)
            reached = group[3][at] > lo[pair]
            found.append(pair[reached] * templates + group[4][at[reached]])
        return np.unique(np.concatenate(found))

    looked_at = np.cumsum(sum(stretches(*side, group)[1] for side in sides for group in groups))
    cuts = np.unique(np.searchsorted(looked_at, np.arange(0, looked_at[-1] + HITS_AT_ONCE, HITS_AT_ONCE), "right"))
    counts = np.zeros((2, pairs.num_rows), np.int64)
    for a, b in zip(cuts[:-1], cuts[1:]):
        both = np.intersect1d(*(hits(*(c[a:b] for c in side)) for side in sides), assume_unique=True)
        pair, split = both // templates, both % templates % 3 > 0
        for i, of_kind in enumerate((~split, split)):
            counts[i, a:b] = np.bincount(pair[of_kind], minlength=b - a)
    some = np.flatnonzero(counts.sum(axis=0))
    return pa.table([pairs.column("site").take(pa.array(some)), pa.array(counts[0, some]), pa.array(counts[1, some])], schema=schema)


def _by_bins(reads: DataFrame, pairs: DataFrame, length: int) -> DataFrame:
    """The same for windows anywhere."""
    side = [
        F.struct(F.lit(i).cast("byte").alias("side"), *[F.col(f"{c}{i}").alias(c) for c in ("contig", "lo", "hi", "forward")]) for i in (1, 2)
    ]
    windows = pairs.select("site", "pair", F.explode(F.array(*side)).alias("_w")).select("site", "pair", "_w.*")
    hits = overlap_join(reads.distinct(), windows, ["contig", "forward"], ("start", "end"), ("lo", "hi"), length)
    both = hits.groupBy("site", "pair", "signal", "read_id").agg(F.bit_or("side").alias("_sides")).filter("_sides = 3")
    pe, sr = F.count_if(F.col("signal") == 0), F.count_if(F.col("signal") > 0)
    return both.groupBy("site").agg(pe.alias("pe_count"), sr.alias("sr_count"))


def count_supported(reads: DataFrame, windows: DataFrame, pairs: Column, length: int) -> DataFrame:
    """``site``, ``pe_count``, ``sr_count`` of the sites with support: per pair of windows, templates and signals that hit both.

    ``reads`` has ``read_id``, ``signal`` (0 pair, 1 and 2 split reads), ``contig``, ``start``, ``end``, ``strand``. ``pairs`` is a column of ``windows``
    (which has ``site``): an array of windows of ``length``, the two sides of a pair one after the other.
    """
    known = F.col("contig").isNotNull() & F.col("strand").isin(FORWARD, "Reverse") & (F.col("end") > F.col("start"))
    reads = reads.filter(known).select("read_id", "signal", "contig", "start", "end", (F.col("strand") == FORWARD).alias("forward"))
    two = F.transform(F.sequence(F.lit(0), F.size("_all") - 2, F.lit(2)), lambda i: F.struct(F.get("_all", i).alias("a"), F.get("_all", i + 1).alias("b")))
    sides = [
        c
        for side, w in ((1, "_p.a"), (2, "_p.b"))
        for c in (
            F.col(f"{w}.contig").alias(f"contig{side}"),
            F.col(f"{w}.lo").alias(f"lo{side}"),
            F.col(f"{w}.hi").alias(f"hi{side}"),
            (F.col(f"{w}.strand") == FORWARD).alias(f"forward{side}"),
        )
    ]
    laid_out = windows.select("site", pairs.alias("_all")).filter("_all is not null").select("site", F.explode(two).alias("_p"))
    laid_out = laid_out.select("site", F.col("_p.a.pair").alias("pair"), *sides).dropna(subset=["contig1", "lo1", "contig2", "lo2"])
    width = length * WINDOWS_PER_BLOCK
    reach = width // 8
    low = F.least("lo1", "lo2")
    near = (F.col("contig1") == F.col("contig2")) & (F.greatest("hi1", "hi2") - low <= reach)
    laid_out = reliable_checkpoint(laid_out.withColumn("block", F.when(near, int_div(low, width))))

    block = F.sequence(int_div(F.col("start") - reach, width), int_div(F.col("end") - 1, width))
    in_blocks = reads.withColumn("block", F.explode(block))
    key = ["contig", "block"]
    asked = laid_out.filter("block is not null").withColumnRenamed("contig1", "contig")
    n_reads, n_asked = (df.groupBy(*key).agg(F.count(F.lit(1)).alias(n)) for df, n in ((in_blocks, "_reads"), (asked, "_asked")))
    work, n_pairs = F.col("_reads") * F.col("_asked") / F.lit(WORK_PER_TASK), F.col("_asked") / F.lit(PAIRS_PER_TASK)
    parts = F.when(F.col("_reads") > READS_PER_BLOCK, 0).otherwise(F.ceil(F.greatest(work, n_pairs))).cast("int")
    blocks = reliable_checkpoint(n_reads.join(n_asked, key).select(*key, parts.alias("_parts")))

    used = blocks.filter("_parts > 0")
    left = in_blocks.join(used, key).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    right = asked.join(used, key).withColumn("part", F.pmod(F.xxhash64("site", "pair"), F.col("_parts")).cast("int"))
    key = [*key, "part"]
    left = left.select(*key, "read_id", "signal", "start", "end", "forward").groupBy(*key)
    right = right.select(*key, "site", "lo1", "hi1", "forward1", "lo2", "hi2", "forward2").groupBy(*key)
    schema = f"site {windows.schema['site'].dataType.simpleString()}, pe_count bigint, sr_count bigint"
    found = left.cogroup(right).applyInArrow(_supported, schema)
    crowded = blocks.filter("_parts = 0").select(F.col("contig").alias("contig1"), "block")
    far = laid_out.filter("block is null").unionByName(laid_out.join(crowded, ["contig1", "block"], "left_semi"))
    if not far.isEmpty():
        found = found.unionByName(_by_bins(reads, far, length))
    return found.groupBy("site").agg(F.sum("pe_count").alias("pe_count"), F.sum("sr_count").alias("sr_count"))
