"""Selection of reads that show evidence, together with their mates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riftspan.config import Config
from riftspan.functions.flags import PAIRED, has_flag
from riftspan.functions.reads import interesting
from riftspan.operators.blocked import drop_blocked
from riftspan.plans.library import LibraryProperties
from riftspan.session import reliable_checkpoint


#: So many names are left to the planner alone, and beyond so many a filter of ``2^FILTER_BITS`` bits is of no use.
FEW_NAMES, FILTER_BITS = 500_000, 26
MOST_NAMES = (1 << FILTER_BITS) // 8


def drop_blocked_reads(
    alignments: DataFrame, end: Column, regions: DataFrame
) -> DataFrame:
    """Remove reads whose alignment, or whose mate's position, lies in a blocked region.

    ``end`` is the exclusive end of the tested stretch of the alignment.
    """
    has_mate = has_flag(PAIRED) & (F.col("mtid") != -1)
    return drop_blocked(
        alignments,
        [
            (F.col("contig"), F.col("pos"), end),
            (F.when(has_mate, F.col("mcontig")), F.col("mpos"), F.col("mpos") + 1),
        ],
        regions,
    )


def with_mates(alignments: DataFrame, keep: Column) -> DataFrame:
    """All rows of every template that has at least one row satisfying ``keep``.

    The distinct names are written first, so the planner knows their true size and broadcasts them if they are few. Of
    more names, a filter of bounded size keeps most other rows out of the shuffle; the exact join comes after it in any case. Of
    more than ``MOST_NAMES`` the filter would let too much pass, and there is none. A name with very many
    rows only weighs on the left side of the join, which adaptive execution splits.
    """
    names = reliable_checkpoint(alignments.filter(keep).select("qname").distinct())
    n = names.count()
    likely = might_have_name(alignments, names, n) if FEW_NAMES < n <= MOST_NAMES else alignments
    return likely.join(names, "qname", "left_semi")


def might_have_name(alignments: DataFrame, names: DataFrame, n: int) -> DataFrame:
    """All rows whose name is one of the ``n`` distinct ``names``, and at most about one in eight of the others.

    A name sets one bit of at least eight per name. Tasks set the bits of their names in words of 64, which are merged by
    word; the words with a bit set are at most ``2^FILTER_BITS / 64`` rows, and so may be broadcast.
    """
    bits = min(FILTER_BITS, max(10, (8 * n).bit_length()))

    def slot(name: str) -> Column:
        return F.expr(f"shiftrightunsigned(xxhash64({name}), {64 - bits})")

    words = (
        names.select(slot("qname").alias("_slot"))
        .groupBy(F.expr("_slot div 64").alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(_slot % 64 as int))")).alias("_bits"))
    )
    hit = (F.expr("_slot div 64") == F.col("_word")) & (F.expr("shiftrightunsigned(_bits, cast(_slot % 64 as int)) & 1L") == 1)
    return alignments.withColumn("_slot", slot("qname")).join(F.broadcast(words), hit, "left_semi").drop("_slot")


def is_interesting(library: LibraryProperties, config: Config) -> Column:
    """Evidence test with the configured thresholds."""
    return interesting(
        library.max_normal_isize, config.min_clipped_bases, config.supplementary_masked_as_secondary
    )


def two_pass_scan(
    alignments: DataFrame, regions: DataFrame, library: LibraryProperties, config: Config, order: list[str]
) -> DataFrame:
    """Row-for-row result of scanning overlapping windows twice with a memory of template names.

    ``regions`` has the columns ``region_ord``, ``contig``, ``start``, ``end``. The first pass over a
    window emits a read if its template showed evidence at or before it in scan order; the second
    pass emits it if the template showed evidence up to the end of the window. A read appears once
    per window and pass that emits it. The output has ``region_ord``, ``window_no`` and ``pass`` in
    front of the input columns; sorting by these and ``order`` gives the emission order.
    """
    size = config.sliding_window_size
    overlap = config.sliding_window_margin + library.max_normal_isize + library.max_rlen
    places = regions.select(
        "region_ord", F.col("contig"), F.col("start").alias("_from"), F.col("end").alias("_to")
    )
    offset = F.col("pos") - F.col("_from")
    last_window = F.floor((F.col("_to") - F.col("_from") - 1) / F.lit(size)).cast("long")
    first = F.floor(offset / F.lit(size)).cast("long")
    last = F.least(F.floor((offset + F.lit(overlap)) / F.lit(size)).cast("long"), last_window)
    columns = alignments.columns
    placed = (
        alignments.join(F.broadcast(places), "contig")  # regions are a driver-side list
        .filter((offset >= 0) & (last_window.isNull() | (first <= last_window)))
        .withColumn("window_no", F.explode(F.sequence(first, last)))
        .withColumn("_keep", is_interesting(library, config))
    )
    here = F.struct("region_ord", "window_no", *order)
    seen = placed.filter("_keep").groupBy("qname").agg(F.min(here).alias("_first"))
    joined = placed.join(seen, "qname")
    window_first = F.struct(F.col("_first.region_ord"), F.col("_first.window_no"))
    passes = F.filter(
        F.array(
            F.when(F.col("_first") <= here, 1), F.when(window_first <= F.struct("region_ord", "window_no"), 2)
        ),
        lambda p: p.isNotNull(),
    )
    return joined.select("region_ord", "window_no", F.explode(passes).alias("pass"), *columns)


def scan_reads(
    alignments: DataFrame,
    regions: DataFrame,
    library: LibraryProperties,
    config: Config,
    order: list[str],
    blocked: DataFrame | None = None,
    blocked_end: Column | None = None,
    compat: bool = False,
) -> DataFrame:
    """Reads with evidence and their mates inside the regions.

    By default every such read appears once. ``compat`` gives the rows of the two-pass window scan
    with its repetitions.
    """
    rows = alignments
    if blocked is not None:
        rows = drop_blocked_reads(rows, blocked_end, blocked)
    if compat:
        return two_pass_scan(rows, regions, library, config, order)
    places = regions.select("region_ord", "contig", F.col("start").alias("_from"), F.col("end").alias("_to"))
    inside = (
        rows.join(F.broadcast(places), "contig").filter("pos >= _from AND (_to IS NULL OR pos < _to)").drop("_from", "_to")
    )
    return with_mates(inside, is_interesting(library, config))
