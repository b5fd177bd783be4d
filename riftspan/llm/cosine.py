"""Links between embeddings of high cosine, by p-stable hashing of normalised vectors.

For unit vectors cosine and Euclidean distance tell the same: c >= 0.9 is a distance of at most
sqrt(0.2). A hash is floor((a . x + b) / w) with a Gaussian a and a uniform b; two vectors at distance d
share it with a known probability. A table joins k hashes, k so large that a bucket
holds few unrelated vectors, and there are so many tables that a pair at the limit meets in at least
one with probability ``RECALL``; closer pairs meet almost surely.

Vectors of a bucket are compared exactly, in double precision. A large bucket is dealt in blocks, and
each pair of blocks is a group of its own, so no task holds a whole bucket. A pair is counted in the
first of the tables in which it meets, which its two rows can tell from their keys; so links are counted
without listing pairs, and a task returns counts and a spanning forest only. The comparisons in
a group of g mutually linked vectors are g^2 / 2 all the same, since each vector's exact number of links is asked for.

Defined results: null, zero, and empty vectors and those with null or non-finite components link with
nothing, nor do vectors of different lengths with each other; equal vectors link like any other; rows that repeat an
id are vectors of their own whose links add up in the one row of that id; a null id links with nothing; an empty table gives an empty
result; further columns are passed over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.llm.common import only, stored, table
from riftspan.operators.components import connected_components

#: Cosine from which vectors are linked.
LEAST_COSINE = 0.9
#: Width of a hash cell, in the units of unit vectors.
CELL = 2.0
#: Chance that a pair just at the limit is found.
RECALL = 0.95
#: Distance of unrelated unit vectors.
UNRELATED = math.sqrt(2.0)
#: Vectors of one block of a bucket.
BLOCK = 512
#: Vectors hashed at once.
HASHED = 1_000
SEED = 7


def collision(distance: float, cell: float = CELL) -> float:
    """Probability that two vectors at a distance share one p-stable hash."""
    r = cell / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_sizes(n: int, least_cosine: float = LEAST_COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Hashes a table, and tables, for ``n`` vectors."""
    near, far = collision(math.sqrt(2 - 2 * least_cosine)), collision(UNRELATED)
    k = max(1, math.ceil(math.log(max(n, 2)) / -math.log(far)))
    return k, math.ceil(math.log(1 - recall) / math.log(1 - near**k))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors over their norms, in double precision; scaled first so that norms neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _hasher(hashes: int, tables: int):
    """Rows of whole vectors with their keys in all tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            ids = batch.column("id").to_pylist()
            by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
            for row, vector in zip(ids, batch.column("vector").to_pylist()):
                if vector and None not in vector:
                    x = np.array(vector, np.float64)
                    if np.isfinite(x).all() and x.any():
                        by_size.setdefault(len(x), []).append((row, x))
            for size, own in ((size, own[i : i + HASHED]) for size, own in by_size.items() for i in range(0, len(own), HASHED)):
                if size not in drawn:
                    rng = np.random.default_rng([SEED, size])
                    drawn[size] = rng.standard_normal((size, tables * hashes)), rng.uniform(0, CELL, tables * hashes), rng.integers(1, 1 << 62, hashes) | 1
                a, b, mix = drawn[size]
                x = unit(np.stack([v for _, v in own]))
                cells = np.floor((x @ a + b) / CELL).astype(np.int64).reshape(len(x), tables, hashes)
                keys = (cells * mix).sum(2) * 0x1E3779B97F4A7C15 + size
                keys ^= keys >> 32  # 32 bits tell buckets apart well enough; strangers are told by their cosine
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _ in own], pa.int64()), pa.array([v.tobytes() for v in x], pa.binary()), pa.array([k.tobytes() for k in keys.astype(np.int32)], pa.binary()), pa.array(list(keys.astype(np.int32)), pa.list_(pa.int32()))],
                    names=["id", "unit", "signature", "keys"],
                )

    return run


def _spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the least row that the pairs ``(i, j)`` connect it with."""
    label = np.arange(n)
    while len(i):
        before = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == before).all():
            break
    return label


def _compared(rows: pa.Table, tables: int, least_cosine: float) -> pa.RecordBatch:
    """Counts and forest edges of whole groups, which are runs of rows; many small groups are compared at once."""
    columns = {c: rows.column(c).to_numpy() for c in ("row", "table", "key", "block", "one", "other")}
    ids, at, n = columns["row"], columns["table"], rows.num_rows
    first = np.ones(n, bool)
    first[1:] = np.any([columns[c][1:] != columns[c][:-1] for c in ("table", "key", "one", "other")], axis=0)
    starts = np.flatnonzero(first)
    end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    raw = rows.column("unit").to_pylist()
    sizes = np.fromiter(map(len, raw), np.int64, n) // 8
    vectors = np.zeros((n, int(sizes.max())))
    for k, v in enumerate(raw):
        vectors[k, : sizes[k]] = np.frombuffer(v, np.float64)
    signature = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.int32).reshape(n, tables)
    across = columns["one"] != columns["other"]
    here, one, other = np.arange(n), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    shift = 1
    while True:
        here = here[here + shift < end[here]]
        if not len(here):
            break
        there = here + shift
        wanted = (~across[here] | (columns["block"][here] != columns["block"][there])) & (sizes[here] == sizes[there])
        i, j = here[wanted], there[wanted]
        near = np.einsum("ij,ij->i", vectors[i], vectors[j]) >= least_cosine
        i, j = i[near], j[near]
        # Pairs that met in an earlier table have been counted there.
        same = signature[i] == signature[j]
        new = np.where(same.any(1), same.argmax(1), tables) == at[i] if len(i) else np.empty(0, bool)
        one.append(i[new])
        other.append(j[new])
        shift += 1
    i, j = np.concatenate(one), np.concatenate(other)
    links = np.bincount(i, minlength=n) + np.bincount(j, minlength=n)
    label = _spanning(n, i, j)
    some = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(ids[label[some]])], names=["row", "n", "to"])


def _comparer(tables: int, least_cosine: float):
    """Compares groups; rows come sorted by group."""
    keys = ("table", "key", "one", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            now = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            now = now.combine_chunks()
            if not now.num_rows:
                continue
            # The last group may go on in the next batch.
            last = np.all([now.column(c).to_numpy() == now.column(c)[-1].as_py() for c in keys], axis=0)
            cut = int(np.argmax(last))
            if cut:
                yield _compared(now.slice(0, cut), tables, least_cosine)
            rest = now.slice(cut)
        if rest is not None and rest.num_rows:
            yield _compared(rest, tables, least_cosine)

    return run


def cosine_links(
    vectors: DataFrame, id_column: str, vector_column: str, least_cosine: float = LEAST_COSINE, recall: float = RECALL
) -> tuple[DataFrame, DataFrame]:
    """``(row, n)`` links of every linked vector, and edges ``(a, b)`` that connect what links connect."""
    rows = only(vectors, id_column, vector_column).toDF("id", "vector").filter("id is not null and vector is not null")
    hashes, tables = table_sizes(rows.count(), least_cosine, recall)
    kept = stored(rows.mapInArrow(_hasher(hashes, tables), "id bigint, unit binary, signature binary, keys array<int>"))
    placed = kept.select(F.col("id").alias("row"), F.posexplode("keys").alias("table", "key"))
    sizes = placed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    # A bucket of several blocks takes every vector to one group for each block, its own included.
    blocks = F.expr(f"cast((size + {BLOCK} - 1) div {BLOCK} as int)")
    met = placed.join(sizes, ["table", "key"]).withColumn("blocks", blocks)
    met = met.withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    paired = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "row", "table", "key", "block", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other")
    )
    full = paired.join(kept.select(F.col("id").alias("row"), "unit", "signature"), "row")
    group = ["table", "key", "one", "other"]
    grouped = full.repartition(*group).sortWithinPartitions(*group)
    found = stored(grouped.mapInArrow(_comparer(tables, least_cosine), "row bigint, n bigint, to bigint"))
    counts = found.groupBy("row").agg(F.sum("n").alias("n"))
    return counts, found.filter("row <> to").select(F.col("row").alias("a"), F.col("to").alias("b"))


def op7_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and class of every vector."""
    vectors = table(spark, sf_dir, "embeddings")
    counts, edges = cosine_links(vectors, "vec_id", "embedding")
    classes = connected_components(edges)
    found = (
        only(vectors, "vec_id").distinct()
        .join(counts.withColumnRenamed("row", "vec_id"), "vec_id", "left")
        .join(classes.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    )
    component = F.coalesce("component", "vec_id")
    return found.select("vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
