"""Paired-end and split-read evidence extracted from alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riftspan.functions.flags import FIRST, MATE_REVERSE, PAIRED, REVERSE, has_flag
from riftspan.functions.reads import discordant, split_left, split_right

_EVIDENCE = (
    "struct<kind:string,read_id:bigint,is_first:boolean,contig:string,start:bigint,end:bigint,strand1:string,"
    "contig2:string,start2:bigint,strand2:string,tlen:bigint,clipped_sides:string>"
)


def _strand(bit: int) -> Column:
    return F.when(has_flag(bit), "Reverse").otherwise("Forward")


def extract_evidence(
    alignments: DataFrame,
    max_normal_isize: int,
    min_clipped: int,
    masked_secondary: bool = True,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Up to two rows per alignment: split-read evidence (``part`` 0), then paired-end (``part`` 1).

    Needs ``end`` (exclusive alignment end) and ``read_id`` besides the alignment columns. Mate
    columns are NULL for unpaired rows, ``tlen`` also where negative.
    """
    flagged = alignments.withColumn("_l", split_left(min_clipped, masked_secondary)).withColumn(
        "_r", split_right(min_clipped, masked_secondary)
    )
    paired = has_flag(PAIRED)
    none = F.lit(None)
    sides = F.when(F.col("_l") & F.col("_r"), "Both").when(F.col("_l"), "Left").otherwise("Right")
    place = [F.col("read_id"), has_flag(FIRST), F.col("contig"), F.col("pos"), F.col("end")]
    split = F.struct(F.lit("SplitRead"), *place, none, none, none, none, none, sides).cast(_EVIDENCE)
    pair = F.struct(
        F.lit("PairedRead"),
        *place,
        _strand(REVERSE),
        F.when(paired & (F.col("mtid") >= 0), F.col("mcontig")),
        F.when(paired, F.col("mpos")),
        F.when(paired, _strand(MATE_REVERSE)),
        F.when(paired & (F.col("tlen") >= 0), F.col("tlen")),
        none,
    ).cast(_EVIDENCE)
    parts = F.array(
        F.when(F.col("_l") | F.col("_r"), split), F.when(discordant(max_normal_isize), pair)
    )
    return (
        flagged.select(*carry, F.posexplode(parts).alias("part", "_e"))
        .filter(F.col("_e").isNotNull())
        .select(*carry, "part", "_e.*")
    )


def signal_json(evidence: DataFrame) -> Column:
    """The evidence as one externally tagged JSON document; absent values are written as null."""
    split = F.struct("read_id", "is_first", "contig", "start", "end", "clipped_sides")
    pair = F.struct(
        "read_id",
        F.col("is_first").alias("is_first1"),
        F.col("contig").alias("contig1"),
        F.col("start").alias("start1"),
        F.col("end").alias("end1"),
        "strand1",
        "contig2",
        "start2",
        "strand2",
        "tlen",
    )
    keep_null = {"ignoreNullFields": "false"}
    return F.when(F.col("kind") == "SplitRead", F.to_json(F.struct(split.alias("SplitRead")), keep_null)).otherwise(
        F.to_json(F.struct(pair.alias("PairedRead")), keep_null)
    )


def from_signal(rows: DataFrame, signal: Column, carry: tuple[str, ...] = ()) -> DataFrame:
    """Evidence columns from JSON documents, the inverse of :func:`signal_json`."""
    from riftspan.schemas import SIGNAL

    parsed = rows.select(*carry, F.from_json(signal, SIGNAL).alias("_j"))
    sr, pr = F.col("_j.SplitRead"), F.col("_j.PairedRead")
    return parsed.select(
        *carry,
        F.when(sr.isNotNull(), "SplitRead").otherwise("PairedRead").alias("kind"),
        F.coalesce(sr["read_id"], pr["read_id"]).alias("read_id"),
        F.coalesce(sr["is_first"], pr["is_first1"]).alias("is_first"),
        F.coalesce(sr["contig"], pr["contig1"]).alias("contig"),
        F.coalesce(sr["start"], pr["start1"]).alias("start"),
        F.coalesce(sr["end"], pr["end1"]).alias("end"),
        pr["strand1"].alias("strand1"),
        pr["contig2"].alias("contig2"),
        pr["start2"].alias("start2"),
        pr["strand2"].alias("strand2"),
        pr["tlen"].alias("tlen"),
        sr["clipped_sides"].alias("clipped_sides"),
    )
