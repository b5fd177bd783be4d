"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Each block of documents (one Arrow batch) fingerprints its texts with 64 bits and stores them,
   sorted, in a small written table. Texts are not stored.
2. Each block sends every owner of a fingerprint range its distinct fingerprints as Rice-coded gaps
   (Golomb codes whose parameter is a power of two). An owner answers each block with a bitmap of
   the fingerprints that other blocks sent as well.
3. The suspects (marked by an owner, or repeated within a block) become one bitmap over fingerprint
   prefixes of at most ``FILTER_BITS`` bits, which is all that is broadcast. Texts that pass are
   grouped by their bytes, pre-aggregated within each batch and again by Spark, so a group that
   holds a third of all rows reaches its reducer as one row per batch. A false suspect is a group
   of one. Were the bitmap ever full, more texts would be shuffled; the result stays the same.
4. The groups are joined back to the stored rows, one row per block and text.

Defined results: a null text counts as empty; rows that repeat id and text are returned as often as
they occur and share their fate (all are ``kept`` or none is), and ``group_size`` counts each; a null id is smaller than no other id, so it
stays only if no other row of that length does; an empty table gives an empty result; further
columns are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.llm.common import only, stored, table, texts_of

#: Characters that do not count when texts are compared: [\x20\x09-\x0D].
IGNORED = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Fingerprints that one owner receives on average (16 MB).
PER_OWNER = 2_000_000
#: Upper bound of the broadcast bitmap: 2^26 bits are 8 MB.
FILTER_BITS = 26
#: Parts in which the bitmap is built.
FILTER_PARTS = 16


def normalised(text: str) -> bytes:
    """What two equal texts have in common."""
    return text.encode().translate(None, IGNORED)


def fingerprints(shas: list[bytes]) -> np.ndarray:
    """64 bits of each digest."""
    return np.frombuffer(b"".join(s[:8] for s in shas), ">u8").astype(np.uint64)


def rice_encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sorted distinct ``uint64`` values as ``(width, unary part, remainders)``."""
    gaps = np.diff(values, prepend=np.uint64(0))
    width = max(0, int(np.log2(max(1.0, float(gaps.astype(float).mean()) * np.log(2)))))
    width = min(width, 62)
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    remainders = (gaps[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return width, np.packbits(unary).tobytes(), np.packbits(remainders.astype(np.uint8)).tobytes()


def rice_decode(n: int, width: int, unary: bytes, remainders: bytes) -> np.ndarray:
    """The ``n`` values that :func:`rice_encode` packed."""
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    quotients = (np.diff(ends, prepend=-1) - 1).astype(np.uint64)
    gaps = quotients << np.uint64(width)
    if width:
        bits = np.unpackbits(np.frombuffer(remainders, np.uint8), count=n * width).reshape(n, width)
        gaps += bits.astype(np.uint64) @ (np.uint64(1) << np.arange(width, dtype=np.uint64))
    return np.cumsum(gaps, dtype=np.uint64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per batch: sorted fingerprints, and the rows of each text."""
    part = TaskContext.get().partitionId()
    for number, batch in enumerate(batches):
        own: dict[bytes, list] = {}
        ids = batch.column("id").to_pylist()
        marks = batch.column("mark").to_pylist()
        for row, mark, text in zip(ids, marks, texts_of(batch, "text")):
            own.setdefault(hashlib.sha256(normalised(text)).digest(), []).append({"id": row, "mark": mark, "chars": len(text)})
        if not own:
            continue
        keys = sorted(own)
        prints = np.repeat(fingerprints(keys), [len(own[k]) for k in keys])
        entries = [{"sha": k, "rows": own[k]} for k in keys]
        kind = pa.list_(pa.struct([("sha", pa.binary()), ("rows", pa.list_(pa.struct([("id", batch.column("id").type), ("mark", pa.int64()), ("chars", pa.int64())])))]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([part << 32 | number], pa.int64()), pa.array([prints.tobytes()], pa.binary()), pa.array([len(prints)], pa.int64()), pa.array([entries], kind)],
            names=["block", "prints", "n", "entries"],
        )


def _messages(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block, prints in zip(batch.column("block").to_pylist(), batch.column("prints").to_pylist()):
                distinct = np.unique(np.frombuffer(prints, np.uint64))
                edges = np.searchsorted(distinct, bounds(owners))
                for owner, own in enumerate(np.split(distinct, edges)):
                    if len(own):
                        rows.append((block, owner, len(own), *rice_encode(own)))
            yield pa.RecordBatch.from_pylist([dict(zip(_MESSAGE.names, r)) for r in rows], _MESSAGE)

    return run


_MESSAGE = pa.schema([("block", pa.int64()), ("owner", pa.int32()), ("n", pa.int64()), ("width", pa.int32()), ("unary", pa.binary()), ("remainders", pa.binary())])


def bounds(owners: int) -> np.ndarray:
    """First fingerprints of the ranges after the first."""
    return np.array([(i << 64) // owners for i in range(1, owners)], np.uint64)


def _answer(messages: pa.Table) -> pa.Table:
    """An owner's bitmaps: which fingerprints of a block other blocks sent too."""
    columns = messages.to_pydict()
    sent = [rice_decode(*m) for m in zip(columns["n"], columns["width"], columns["unary"], columns["remainders"])]
    values, counts = np.unique(np.concatenate(sent), return_counts=True)
    shared = values[counts > 1]
    bits = [np.packbits(np.isin(s, shared, assume_unique=True)).tobytes() for s in sent]
    return pa.table({"block": messages.column("block"), "owner": messages.column("owner"), "n": messages.column("n"), "bits": pa.array(bits, pa.binary())})


def _suspects(own: pa.Table, answers: pa.Table) -> pa.Table:
    """Fingerprints of a block that occur again, here or elsewhere."""
    found = [np.empty(0, np.uint64)]
    for prints in own.column("prints").to_pylist():
        distinct, counts = np.unique(np.frombuffer(prints, np.uint64), return_counts=True)
        rows = sorted(zip(*(answers.column(c).to_pylist() for c in ("owner", "n", "bits"))))
        marked = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for _, n, b in rows]).astype(bool)
        found.append(distinct[marked | (counts > 1)])
    return pa.table({"print": pa.array(np.concatenate(found).view(np.int64), pa.int64())})


def _bitmap(spark: SparkSession, suspects: DataFrame, bits: int) -> np.ndarray:
    """The bitmap over the first ``bits`` bits of the suspects' fingerprints, built in parts."""
    width = max(1, (1 << bits) // FILTER_PARTS)

    def part(rows: pa.Table) -> pa.Table:
        slots = np.asarray(rows.column("slot")) % width
        flags = np.zeros(width, np.uint8)
        flags[slots] = 1
        return pa.table({"part": rows.column("part").slice(0, 1), "bits": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    slots = suspects.select(F.expr(f"shiftrightunsigned(print, {64 - bits})").alias("slot")).distinct()
    parts = slots.withColumn("part", F.expr(f"cast(slot div {width} as int)")).groupBy("part").applyInArrow(part, "part int, bits binary")
    flags = np.zeros(max(1 << bits, width * FILTER_PARTS), bool)
    for row in parts.collect():  # at most 2^FILTER_BITS bits in all
        flags[row["part"] * width : (row["part"] + 1) * width] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=width)
    return flags


def _passing(bitmap, bits: int):
    """Texts whose fingerprint passes the bitmap, each distinct text of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(np.frombuffer(bitmap.value, np.uint8))
        for batch in batches:
            ids = batch.column("id").to_pylist()
            groups: dict[bytes, list] = {}
            for row, text in zip(ids, texts_of(batch, "text")):
                norm = normalised(text)
                prefix = int.from_bytes(hashlib.sha256(norm).digest()[:8], "big") >> (64 - bits)
                if flags[prefix]:
                    key = (-len(text), row is None, row)
                    best = groups.get(norm)
                    if best is None:
                        groups[norm] = [1, key]
                    else:
                        best[0] += 1
                        if key[:2] < best[1][:2] or key[:2] == best[1][:2] and row is not None and row < best[1][2]:
                            best[1] = key
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(groups), pa.binary()),
                    pa.array([n for n, _ in groups.values()], pa.int64()),
                    pa.array([k[0] for _, k in groups.values()], pa.int64()),
                    pa.array([k[2] for _, k in groups.values()], batch.column("id").type),
                ],
                names=["norm", "n", "less_chars", "id"],
            )

    return run


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For every document: ``id``, ``mark`` (hash of the original text), ``keep_id``, ``group_size``, ``kept``, ``sha`` (binary).

    Of texts equal but for white space, the longest original stays, then the smallest id.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    rows = only(docs, id_column, text_column).toDF("id", "text")
    rows = rows.select("id", "text", F.xxhash64("text").alias("mark"))
    blocks = stored(
        rows.mapInArrow(_blocks, f"block bigint, prints binary, n bigint, entries array<struct<sha:binary,rows:array<struct<id:{kind},mark:bigint,chars:bigint>>>>")
    )
    total = blocks.agg(F.sum("n")).first()[0] or 0
    owners = max(1, total // PER_OWNER, min(64, total // 1000))
    answers = (
        blocks.select("block", "prints")
        .mapInArrow(_messages(owners), "block bigint, owner int, n bigint, width int, unary binary, remainders binary")
        .groupBy("owner")
        .applyInArrow(_answer, "block bigint, owner int, n bigint, bits binary")
    )
    suspects = stored(
        blocks.select("block", "prints").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_suspects, "print bigint")
    )
    bits = min(FILTER_BITS, max(10, (16 * suspects.count()).bit_length()))
    bitmap = spark.sparkContext.broadcast(np.packbits(_bitmap(spark, suspects, bits)).tobytes())
    groups = (
        rows.select("id", "text")
        .mapInArrow(_passing(bitmap, bits), f"norm binary, n bigint, less_chars bigint, id {kind}")
        .groupBy("norm")
        .agg(F.sum("n").alias("group_size"), F.min(F.struct("less_chars", F.isnull("id").alias("none"), "id")).alias("best"))
        .filter("group_size > 1")
        .select(F.unhex(F.sha2("norm", 256)).alias("sha"), "group_size", F.col("best.id").alias("keep_id"), (-F.col("best.less_chars")).alias("keep_chars"))
    )
    entries = blocks.select(F.explode("entries").alias("e")).select("e.sha", "e.rows")
    return (
        entries.join(groups, "sha", "left")
        .select("sha", "group_size", "keep_id", "keep_chars", F.explode("rows").alias("r"))
        .select(
            F.col("r.id").alias("id"),
            F.col("r.mark").alias("mark"),
            F.when(F.col("group_size").isNull(), F.col("r.id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
            (F.col("group_size").isNull() | (F.col("keep_id").eqNullSafe(F.col("r.id")) & (F.col("keep_chars") == F.col("r.chars")))).alias("kept"),
            "sha",
        )
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of equal texts; rows and columns are otherwise as they were."""
    marked = docs.withColumn("_mark", F.xxhash64("text"))
    kept = stored(exact_duplicates(docs).filter("kept").select(F.col("id").alias("_id"), F.col("mark").alias("_kept_mark")).distinct())
    out = marked.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_kept_mark")))
    out = out.select(*docs.columns)
    repeats = marked.groupBy("doc_id", "_mark").count().filter("count > 1").limit(1).count()
    return out.dropDuplicates(["doc_id", "text"]) if repeats else out


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copies of every document."""
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


ORACLE = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), s AS (SELECT doc_id, chars, norm, sha256(norm) AS text_sha256 FROM n),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
  count(*) OVER (PARTITION BY norm) AS group_size FROM s)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
