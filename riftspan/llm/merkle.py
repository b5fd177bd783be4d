"""Merkle fixity audit of replicas of archive files.

Every record is hashed; a file's records, ordered by offset, form a tree whose nodes cover aligned ranges of
offsets: a node of level l covers the offsets that agree but for the last ``BITS_A_LEVEL * l`` bits. A node's hash is
that of its children's hashes and places, in order. A node has at most ``2^BITS_A_LEVEL`` children, so no task
gathers more than that, however large a file is.

Replicas are compared root by root, and only below nodes that differ are children compared, level by
level, down to the records. A replica with sound roots is thus dismissed by one row a file. A
difference is a changed record, or one that one of the replicas lacks.

Defined results: a null payload is hashed as such, unlike an empty one; rows that repeat file and offset form
one leaf, whose hash is that of their sorted hashes; a null file or offset counts as file ``''`` and offset 0; an empty replica lacks everything; further columns are
passed over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.llm.common import stored, table

#: Offsets per node double so many times from level to level.
BITS_A_LEVEL = 4


def _digest(parts: Column) -> Column:
    return F.sha2(F.encode(parts, "UTF-8"), 256)


def leaves(records: DataFrame, file: Column, offset: Column, payload: Column) -> DataFrame:
    """``(file, node, hash, records, bytes)`` of every offset."""
    rows = records.select(
        F.coalesce(file.cast("string"), F.lit("")).alias("file"), F.coalesce(offset.cast("bigint"), F.lit(0)).alias("node"),
        F.coalesce(F.sha2(payload.cast("binary"), 256), F.lit("missing")).alias("hash"), F.coalesce(F.octet_length(payload), F.lit(0)).cast("bigint").alias("bytes"),
    )
    # Repeats of one offset are first counted by hash, so that many of them stay few rows.
    counted = rows.groupBy("file", "node", "hash").agg(F.count(F.lit(1)).alias("records"), F.sum("bytes").alias("bytes"))
    several = F.sort_array(F.collect_list(F.concat_ws("*", "hash", F.col("records").cast("string"))))
    grouped = counted.groupBy("file", "node").agg(several.alias("own"), F.sum("records").alias("records"), F.sum("bytes").alias("bytes"))
    single = (F.size("own") == 1) & (F.col("records") == 1)
    return grouped.select(
        "file", "node", F.when(single, F.substring_index(F.get("own", F.lit(0)), "*", 1)).otherwise(_digest(F.array_join("own", "/"))).alias("hash"), "records", "bytes"
    )


def above(nodes: DataFrame) -> DataFrame:
    """The next level of the tree."""
    child = F.concat_ws("=", F.expr(f"lpad(hex(node & {(1 << BITS_A_LEVEL) - 1}), 4, '0')"), "hash")
    return nodes.groupBy("file", F.expr(f"shiftright(node, {BITS_A_LEVEL})").alias("up")).agg(
        _digest(F.array_join(F.sort_array(F.collect_list(child)), "/")).alias("hash"), F.sum("records").alias("records"), F.sum("bytes").alias("bytes")
    ).withColumnRenamed("up", "node")


def build(records: DataFrame, file: Column, offset: Column, payload: Column, height: int) -> list[DataFrame]:
    """Written levels of the trees of all files, records first, roots last."""
    levels = [stored(leaves(records, file, offset, payload))]
    for _ in range(height):
        levels.append(stored(above(levels[-1])))
    return levels


def height_for(*replicas: tuple[DataFrame, Column]) -> int:
    """Levels above the records that bring every file to one root."""
    largest = 0
    for records, offset in replicas:
        row = records.agg(F.max(offset.cast("bigint")).alias("m")).first()
        largest = max(largest, row["m"] or 0)
    height = 0
    while largest >> height * BITS_A_LEVEL:
        height += 1
    return height


def differences(one: list[DataFrame], other: list[DataFrame]) -> DataFrame:
    """Records that differ: ``file``, ``offset``, ``problem`` and both hashes, found by descent from differing roots."""
    suspects = None
    for a, b in zip(reversed(one), reversed(other)):
        left = a.select("file", "node", F.col("hash").alias("hash_1"))
        right = b.select("file", "node", F.col("hash").alias("hash_2"))
        if suspects is not None:
            up = F.expr(f"shiftright(node, {BITS_A_LEVEL})")
            left, right = (
                side.withColumn("up", up).join(suspects, ["file", "up"], "left_semi").drop("up") for side in (left, right)
            )
        differing = left.join(right, ["file", "node"], "full").filter(~F.col("hash_1").eqNullSafe(F.col("hash_2")))
        differing = stored(differing)
        suspects = differing.select("file", F.col("node").alias("up"))
    problem = F.when(F.col("hash_2").isNull(), "missing").when(F.col("hash_1").isNull(), "surplus").otherwise("changed")
    return differing.select("file", F.col("node").alias("offset"), problem.alias("problem"), "hash_1", "hash_2")


def audit(first: DataFrame, second: DataFrame, file: Column, offset: Column, payload: Column) -> DataFrame:
    """Differences of two replicas given as tables of records with the same columns."""
    height = height_for((first, offset), (second, offset))
    return differences(build(first, file, offset, payload, height), build(second, file, offset, payload, height))


#: Records of a file in the query.
RECORDS_A_FILE = 5_000


def replica(pages: DataFrame) -> DataFrame:
    """A second copy of the pages as a failing disk would return it: some records changed, some lost."""
    spoiled = F.when(F.col("page_id") % 997 == 5, F.concat(F.lit("~"), F.expr("substr(html, 2)"))).otherwise(F.col("html"))
    return pages.filter("page_id % 1499 <> 7").select("page_id", spoiled.alias("html"))


def op2_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the pages that a spoiled copy of them lacks or has changed."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    file = F.expr(f"page_id div {RECORDS_A_FILE}").cast("string")
    offset = F.col("page_id") % RECORDS_A_FILE
    return audit(pages, replica(pages), file, offset, F.col("html"))


ORACLE = f"""
SELECT CAST(page_id // {RECORDS_A_FILE} AS VARCHAR) AS file, page_id % {RECORDS_A_FILE} AS "offset",
  CASE WHEN page_id % 1499 = 7 THEN 'missing' ELSE 'changed' END AS problem,
  sha256(html) AS hash_1, CASE WHEN page_id % 1499 = 7 THEN NULL ELSE sha256('~' || substr(html, 2)) END AS hash_2
FROM pages WHERE page_id % 1499 = 7 OR (page_id % 997 = 5 AND html <> '~' || substr(html, 2))
"""
