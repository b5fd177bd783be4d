"""Links between similar intervals whose components equal those of the full pair graph.

Two intervals are similar if their reciprocal overlap reaches a threshold and their ends lie close
enough. Listing all similar pairs is quadratic where calls pile up, and is not needed: clusters only
depend on connectivity. Intervals of about the same length whose ends fall into the same small cells
are similar to each other by construction; such a *tile* is linked as a star and then stands for all
its members. Tiles are compared by their bounding boxes, which mostly decides the question. An undecided
pair of tiles is cut into quarters that are compared by their boxes in turn; only parts with
at most ``COMPARED`` pairs of members between them are compared member by member.

Where sets must be similar too, a tile holds one set, and tiles meet only where the prefixes of their sets do. Tiles are laid
out by the elements of their prefixes only where many lie in one place; elsewhere a tile is one row for each place, and carries its prefix.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riftspan.functions.interval import float_ratio
from riftspan.operators.components import connected_components
from riftspan.operators.skew import hot_keys, salted_join
from riftspan.session import reliable_checkpoint

#: Member comparisons between two parts of tiles that are made one by one.
COMPARED = 4_096
#: Bins of a block, as a power of two, and rows of tiles in a block from which sets meet by bin and element there.
BLOCK_BITS, CROWD = 3, 512
#: In place of an element, which is a 32-bit hash: every element.
EVERY = 1 << 32


def _level(start: Column, end: Column) -> Column:
    return F.floor(F.log2((end - start).cast("double"))).cast("int")


def _power(level: Column) -> Column:
    return F.pow(F.lit(2.0), level.cast("double"))


def _cell(level: Column, min_overlap: float, max_shift: int | None) -> Column:
    """Cell size that makes any two intervals of one level in one cell pair similar."""
    by_overlap = (F.lit(max(1.0 - min_overlap - 1e-5, 0.0)) * _power(level) / 2 + 1).cast("long")
    size = by_overlap if max_shift is None else F.least(by_overlap, F.lit(max_shift + 1).cast("long"))
    return F.greatest(size, F.lit(1).cast("long"))


def _tiles(members: DataFrame, by: Sequence[str]) -> DataFrame:
    return members.groupBy(*by, "_level", "_cs", "_ce").agg(
        F.min("_id").alias("_tile"),
        F.count(F.lit(1)).alias("_members"),
        F.min("_s").alias("s0"),
        F.max("_s").alias("s1"),
        F.min("_e").alias("e0"),
        F.max("_e").alias("e1"),
    )


def _close(a: Column, b: Column, max_shift: int | None) -> Column:
    return F.lit(True) if max_shift is None else F.abs(a - b) <= max_shift


def similar(
    s: Column, e: Column, t: Column, f: Column, min_overlap: float, max_shift: int | None
) -> Column:
    """Similarity of the intervals ``[s, e)`` and ``[t, f)``, in single precision as to the overlap."""
    shared = F.greatest(F.least(e, f) - F.greatest(s, t), F.lit(0))
    ratio = float_ratio(shared, F.greatest(e - s, f - t))
    return (ratio >= F.lit(min_overlap).cast("float")) & _close(s, t, max_shift) & _close(e, f, max_shift)


def _box_tests(min_overlap: float, max_shift: int | None) -> tuple[Column, Column]:
    """(every pair of members is similar, some pair may be) for tiles with ``s0..e1`` and ``t0..f1``."""
    c = F.col
    worst_shared = F.greatest(F.least(c("e0"), c("f0")) - F.greatest(c("s1"), c("t1")), F.lit(0))
    worst_length = F.greatest(c("e1") - c("s0"), c("f1") - c("t0"))
    best_shared = F.greatest(F.least(c("e1"), c("f1")) - F.greatest(c("s0"), c("t0")), F.lit(0))
    best_length = F.greatest(c("e0") - c("s1"), c("f0") - c("t1"), F.lit(1))
    threshold = F.lit(min_overlap).cast("float")
    always = float_ratio(worst_shared, worst_length) >= threshold
    maybe = float_ratio(best_shared, best_length) >= threshold
    if max_shift is not None:
        for lo_a, hi_a, lo_b, hi_b in (("s0", "s1", "t0", "t1"), ("e0", "e1", "f0", "f1")):
            farthest = F.greatest(c(hi_a) - c(lo_b), c(hi_b) - c(lo_a))
            nearest = F.greatest(c(lo_a) - c(hi_b), c(lo_b) - c(hi_a), F.lit(0))
            always = always & (farthest <= max_shift)
            maybe = maybe & (nearest <= max_shift)
    return always, maybe


def with_prefixes(tiles: DataFrame, least: float) -> DataFrame:
    """``tiles`` with ``_prefix``: the rarest elements of ``_set``, so many that sets which share enough meet in one of them.

    Two sets share at least ``least`` of the larger one, so at least as much of either. Of a set of ``n`` elements at most
    ``n - ceil(least * n)`` may be missing from the other; with one more of them, in an order that all sets keep to, the two
    prefixes meet. Rare elements come first, so common ones join few sets. An empty set has a mark of its own.
    """
    sets = tiles.groupBy("_set").agg(F.count(F.lit(1)).alias("_uses"))
    elements = sets.select("_set", "_uses", F.explode("_set").alias("_element"))
    rarity = elements.groupBy("_element").agg(F.sum("_uses").alias("_n"))
    token = F.struct("_n", F.col("_element").cast("string").alias("_element"))
    ordered = elements.join(rarity, "_element").groupBy("_set").agg(F.array_sort(F.collect_list(token)).alias("_ordered"))
    n = F.size("_ordered")
    missing = n - F.greatest(F.ceil(n * F.lit(least - 1e-6)).cast("int"), F.lit(1))
    prefixes = ordered.select("_set", F.slice("_ordered", 1, missing + 1).alias("_prefix"))
    none = F.array(F.struct(F.lit(-1).cast("long").alias("_n"), F.lit("").alias("_element")))
    return tiles.join(prefixes, "_set", "left").withColumn("_prefix", F.coalesce("_prefix", none))


def _laid_out_by_sets(left: DataFrame, right: DataFrame, place: Sequence[str], first: Column, last: Column) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_bin``, ``_token`` and the elements of their prefixes before that, ``_below`` and ``_other_below``.

    ``left`` has its ``_bin``, ``right`` lies in the bins from ``first`` to ``last``. In a block of bins with few rows every tile is
    one row that is to be compared with all of the block. In a crowded one it has a row for each bin and element of its prefix; a
    pair counts in the least element that both have, so a row needs those below its own only.
    """
    block = [*place, "_block"]

    def block_of(bin_: Column) -> Column:
        return F.call_function("shiftright", bin_, F.lit(BLOCK_BITS))

    left = left.withColumn("_block", block_of(F.col("_bin")))
    right = right.withColumns({"_first": first, "_last": last})
    right = right.withColumn("_block", F.explode(F.sequence(block_of(F.col("_first")), block_of(F.col("_last")))))
    sizes = right.groupBy(*block).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CROWD)
    crowded = hot_keys(reliable_checkpoint(sizes), block, "_n", CROWD).select(*block, F.lit(True).alias("_crowded"))
    begin, end = (F.call_function("shiftleft", F.col("_block") + k, F.lit(BLOCK_BITS)) for k in (0, 1))

    def laid_out(rows: DataFrame, bins: Column, below: str) -> DataFrame:
        rows = rows.join(F.broadcast(crowded), block, "left")
        rows = rows.withColumn("_bin", F.explode(F.when(F.col("_crowded"), bins).otherwise(F.array(begin))))
        elements = F.transform("_prefix", lambda t: t.cast("long"))
        rows = rows.withColumn("_token", F.explode(F.when(F.col("_crowded"), elements).otherwise(F.array(F.lit(EVERY)))))
        rows = rows.withColumn(below, F.filter("_prefix", lambda t: t < F.col("_token")))
        return rows.drop("_prefix", "_block", "_crowded")

    within = F.sequence(F.greatest(F.col("_first"), begin), F.least(F.col("_last"), end - 1))
    return laid_out(left, F.array("_bin"), "_below"), laid_out(right, within, "_other_below").drop("_first", "_last")


def _tile_pairs(
    tiles: DataFrame, by: Sequence[str], min_overlap: float, max_shift: int | None, least_shared: float | None = None
) -> DataFrame:
    """Pairs of tiles that may hold similar members, each once, with ``_always``.

    With ``least_shared``, tiles with prefixes of sets pair up only if those meet, in the first element that both have, and if
    neither set is too small for the other.
    """
    by = list(by)
    if least_shared is not None:
        # Hashes of elements take their place: a few pairs more may meet, and those are judged by their sets afterwards.
        tiles = tiles.withColumn("_prefix", F.array_distinct(F.transform("_prefix", lambda t: F.hash(t["_element"]))))
        tiles = tiles.withColumn("_size", F.size("_set")).drop("_set")
    left = tiles
    right = tiles.select(
        *by,
        *([] if least_shared is None else ["_prefix", F.col("_size").alias("_other_size")]),
        F.col("_level").alias("_rlevel"),
        F.col("_tile").alias("_other"),
        F.col("_members").alias("_others"),
        F.col("s0").alias("t0"),
        F.col("s1").alias("t1"),
        F.col("e0").alias("f0"),
        F.col("e1").alias("f1"),
    )
    if max_shift is not None:
        # Starts differ by at most max_shift, plus as much again for the extent of a tile.
        width = 2 * max_shift + 1
        # The same holds for ends, so tiles meet in cells of both.
        left = left.withColumn("_lv", F.floor(F.col("e0") / width).cast("long")).withColumn("_bin", F.floor(F.col("s0") / width).cast("long"))
        once = F.col("_tile") < F.col("_other")
        home, far = F.floor(F.col("t0") / width).cast("long"), F.floor(F.col("f0") / width).cast("long")
        right = right.withColumn("_lv", F.explode(F.sequence(far - 1, far + 1)))
        first, last = home - 1, home + 1
    else:
        # Lengths differ by at most the factor 1 / min_overlap, starts by at most the uncovered part.
        # A tile looks for those of higher levels on both sides, and for those of its own level that do not start after it.
        spread = ceil(log2(1.0 / min_overlap) - 1e-9) if min_overlap < 1 else 0
        reach = 2.5 * (1.0 - min_overlap)

        def width_of(level: Column) -> Column:
            return F.ceil(F.lit(reach) * _power(level)).cast("long") + 1

        left = left.withColumn("_lv", F.col("_level")).withColumn(
            "_bin", F.floor(F.col("s0") / width_of(F.col("_level"))).cast("long")
        )
        right = right.withColumn(
            "_lv", F.explode(F.sequence(F.col("_rlevel"), F.col("_rlevel") + spread))
        )
        width = margin = width_of(F.col("_lv"))
        higher = F.col("_lv") > F.col("_rlevel")
        once = higher | (F.col("s0") < F.col("t0")) | ((F.col("s0") == F.col("t0")) & (F.col("_tile") < F.col("_other")))
        first = F.floor((F.col("t0") - margin) / width).cast("long")
        last = F.floor((F.col("t0") + F.when(higher, margin).otherwise(0)) / width).cast("long")
    left = left.drop("_level", "_cs", "_ce")
    keys, counts = [*by, "_lv", "_bin"], None
    if least_shared is None:
        right = right.withColumn("_bin", F.explode(F.sequence(first, last)))
    else:
        left, right = _laid_out_by_sets(left, right, [*by, "_lv"], first, last)
        keys.append("_token")
        # Elsewhere rows are few at a place.
        counts = left.filter(F.col("_token") != EVERY).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    always, maybe = _box_tests(min_overlap, max_shift)
    residual = once & maybe
    if least_shared is not None:
        smaller, larger = (f("_size", "_other_size").cast("double") for f in (F.least, F.greatest))
        residual = residual & (smaller >= larger * F.lit(least_shared - 1e-6))
        # With every element below, prefixes must meet; with those below one element, they must not have met before.
        residual = residual & (F.arrays_overlap("_below", "_other_below") == (F.col("_token") == EVERY))
    joined = salted_join(left, right.drop("_rlevel") if max_shift is not None else right, keys, ["_tile"], residual=residual, counts=counts)
    compared = (F.col("_members") * F.col("_others")).cast("double")
    return joined.select("_tile", "_other", always.alias("_always"), compared.alias("_compared"))


def _settled(
    points: DataFrame, undecided: DataFrame, min_overlap: float, max_shift: int | None, compared: int
) -> DataFrame:
    """Links ``(a, b)`` between undecided tiles that hold at least one similar pair of members.

    ``points`` has the distinct members of the tiles with their offsets ``_so``, ``_eo`` in the tile's cells and the bits
    ``_bits`` of such an offset. A part of a tile is named by the leading bits of both offsets.
    """

    def part(offset: str, bits: int) -> Column:
        return F.call_function("shiftright", F.col(offset), F.greatest(F.col("_bits") - bits, F.lit(0)))

    is_similar = similar(F.col("_s"), F.col("_e"), F.col("_t"), F.col("_f"), min_overlap, max_shift)
    always, maybe = _box_tests(min_overlap, max_shift)
    whole = [F.lit(0).cast("long").alias(c) for c in ("_sp", "_ep", "_tp", "_fp")]
    open_parts = undecided.select("_tile", "_other", *whole, "_compared")
    links, depth = None, 0
    while True:
        here = points.select("_tile", "_s", "_e", part("_so", depth).alias("_sp"), part("_eo", depth).alias("_ep"))
        there = here.toDF("_other", "_t", "_f", "_tp", "_fp")
        few = open_parts.filter(F.col("_compared") <= compared).drop("_compared")
        found = (
            few.join(here, ["_tile", "_sp", "_ep"])
            .join(there, ["_other", "_tp", "_fp"])
            .filter(is_similar)
            .select(F.col("_tile").alias("a"), F.col("_other").alias("b"))
        )
        links = found if links is None else links.unionByName(found)
        many = open_parts.filter(F.col("_compared") > compared)
        if many.isEmpty():
            return links.distinct()
        depth += 1
        quarters = points.groupBy(
            "_tile", part("_so", depth - 1).alias("_sp"), part("_eo", depth - 1).alias("_ep"),
            part("_so", depth).alias("_sq"), part("_eo", depth).alias("_eq"),
        ).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_s").alias("s0"), F.max("_s").alias("s1"), F.min("_e").alias("e0"), F.max("_e").alias("e1")
        )
        others = quarters.toDF("_other", "_tp", "_fp", "_tq", "_fq", "_m", "t0", "t1", "f0", "f1")
        halves = (
            many.join(quarters, ["_tile", "_sp", "_ep"])
            .join(others, ["_other", "_tp", "_fp"])
            .filter(maybe)
            .select(
                "_tile", "_other", F.col("_sq").alias("_sp"), F.col("_eq").alias("_ep"), F.col("_tq").alias("_tp"), F.col("_fq").alias("_fp"),
                (F.col("_n") * F.col("_m")).cast("double").alias("_compared"), always.alias("_always"),
            )
        )
        halves = reliable_checkpoint(halves)
        sure = halves.filter("_always").select("_tile", "_other").distinct()
        links = links.unionByName(sure.select(F.col("_tile").alias("a"), F.col("_other").alias("b")))
        open_parts = halves.filter("NOT _always").drop("_always").join(sure, ["_tile", "_other"], "left_anti")


def cluster_similar(
    df: DataFrame,
    row_id: str,
    by: Sequence[str],
    span: tuple[str, str],
    min_overlap: float,
    max_shift: int | None,
    set_column: str | None = None,
    min_set_overlap: float | None = None,
    name: str = "cluster",
    compared: int = COMPARED,
) -> DataFrame:
    """``df`` with the cluster of each row in ``name``: the least ``row_id`` among rows linked by similarity.

    Only rows with equal ``by`` columns are compared. If ``set_column`` (an array) is given, the
    shared part of both sets must reach ``min_set_overlap`` of the larger one as well; a NULL set is empty, and two
    empty sets share enough. Empty intervals are similar to nothing.
    """
    if min_overlap <= 0 and max_shift is None:
        raise ValueError("either a reciprocal overlap or a breakpoint distance must limit clustering")
    by = list(by)
    start, end = F.col(span[0]).cast("long"), F.col(span[1]).cast("long")
    level = F.when(end > start, _level(start, end))
    cell = _cell(level, min_overlap, max_shift)
    placed = df.withColumns(
        {
            **({"_set": F.coalesce(F.array_sort(F.array_distinct(F.col(set_column))), F.array().cast(df.schema[set_column].dataType))} if set_column else {}),
            "_level": level,
            "_cs": F.floor(start / cell).cast("long"),
            "_ce": F.floor(end / cell).cast("long"),
        }
    )
    tile_by = [*by, "_set"] if set_column else by
    tile_key = [*tile_by, "_level", "_cs", "_ce"]
    members = placed.filter("_level IS NOT NULL").select(
        F.col(row_id).alias("_id"), *tile_key, start.alias("_s"), end.alias("_e")
    )
    tiles = reliable_checkpoint(_tiles(members, tile_by))
    if set_column and min_set_overlap > 0:
        pairs = _tile_pairs(reliable_checkpoint(with_prefixes(tiles, float(min_set_overlap))), by, min_overlap, max_shift, float(min_set_overlap))
    else:
        pairs = _tile_pairs(tiles, by, min_overlap, max_shift)
    if set_column:
        sets = tiles.select("_tile", "_set")
        shared = F.size(F.array_intersect("_set", "_other_set"))
        larger = F.greatest(F.size("_set"), F.size("_other_set"))
        enough = F.coalesce(
            float_ratio(shared, larger) >= F.lit(float(min_set_overlap)).cast("float"), F.lit(True)
        )
        pairs = (
            pairs.join(sets, "_tile")
            .join(sets.select(F.col("_tile").alias("_other"), F.col("_set").alias("_other_set")), "_other")
            .filter(enough)
            .select("_tile", "_other", "_always", "_compared")
        )
    pairs = reliable_checkpoint(pairs)
    links = pairs.filter("_always").select(F.col("_tile").alias("a"), F.col("_other").alias("b"))
    undecided = pairs.filter("NOT _always").select("_tile", "_other", "_compared")
    involved = undecided.select("_tile").unionByName(undecided.select(F.col("_other").alias("_tile"))).distinct()
    keys = tiles.join(involved, "_tile", "left_semi").select(*tile_key, "_tile")
    size = _cell(F.col("_level"), min_overlap, max_shift)
    points = members.join(keys, tile_key).select(
        "_tile", "_s", "_e", (F.col("_s") - F.col("_cs") * size).alias("_so"), (F.col("_e") - F.col("_ce") * size).alias("_eo"),
        F.ceil(F.log2(size.cast("double"))).cast("int").alias("_bits"),
    ).distinct()
    links = links.unionByName(_settled(points, undecided, min_overlap, max_shift, compared))
    labels = connected_components(links).select(F.col("node").alias("_tile"), F.col("component").alias("_top"))
    named = tiles.join(labels, "_tile", "left").select(
        *tile_key, F.coalesce("_top", "_tile").alias(name)
    )
    sizes = tiles.select(*tile_key, F.col("_members").alias("_n"))
    labelled = salted_join(placed, named, tile_key, [row_id], how="left", counts=sizes)
    return labelled.withColumn(name, F.coalesce(name, row_id)).select(*df.columns, name)
