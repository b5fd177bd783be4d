"""SimHash near-duplicates by a generalised pigeonhole search.

Fingerprints of 64 bits are reduced to distinct ones. Their bits are grouped into partitions of
correlated bits, and each partition i gets a threshold t_i of its own, with sum(t_i) = T - m + 1 for m
partitions: two fingerprints at most T bits apart then differ in at most t_i bits of some partition i.
Dynamic programming over the partitions picks the thresholds (-1 leaves a partition out) that cost
least, counted in rows probed and in candidate pairs; pairs that share a partition are counted over
all fingerprints, pairs within a bit or two of each other are projected from the bit statistics.

A threshold t_i is probed by masks: the partition's bits without each choice of t_i of them. Equal
masked values form a bucket, and buckets of up to ``BUCKET`` fingerprints are compared in full, of
which only a spanning forest leaves the task. A larger bucket is split by the same principle over the
bits that still vary in it (T + 1 groups of bits, one of which must agree), again and again; a
bucket of few varying bits is small, so this ends within a few rounds. Beyond T = ``SPLIT_UP_TO`` such parts would hardly be smaller than
the bucket. There a member of the bucket is linked with all within T bits of it, and the others are compared with
all, a pair of tiles a task. No pairs of a group are listed, none are left out.

Where documents are dropped, links only name candidates: a document goes if the exact similarity of its
shingles to those of a document that stays is ``SIMILARITY`` or more.

Defined results: null and empty texts have fingerprint zero and are linked like any other; rows
that repeat id and text are one document; a null id names no class unless all ids of it are null; an
empty table gives an empty result; further columns are passed over.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riftspan.llm.common import only, stored, table, texts_of
from riftspan.operators.components import connected_components

BITS = 64
#: Words of a shingle, and bits that may differ, of the query.
WORDS, DISTANCE = 3, 2
#: Fingerprints of a bucket that are compared in full.
BUCKET = 1_000
#: Bits whose 2^10 combinations bound a bucket in which only they vary.
FEW_BITS = 10
#: Largest distance at which large buckets are split.
SPLIT_UP_TO = 3
#: Cost of a probe row relative to that of a candidate pair.
ROW_COST = 100.0
#: Shingles tallied at once.
TALLIED = 50_000
#: Words of a shingle and Jaccard similarity of near copies, where documents are dropped.
SHINGLE, SIMILARITY = 5, 0.8
#: Documents of a class that one task tells apart.
HEADS = 500
MIX = np.uint64(0x9E3779B97F4A7C15)


def fingerprint(text: str, words: int = WORDS) -> int:
    """SimHash of the shingles of a text, repeats included; a bit is set if it is in over half of the hashes."""
    import xxhash

    own = text.encode().lower().split()
    if not own:
        return 0
    joined = b" ".join(own)
    if len(own) < words:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    begins = np.concatenate([[0], ends[: len(own) - words] + 1]).tolist()
    stops = ends[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    tally = np.zeros(BITS, np.int64)
    for at in range(0, len(begins), TALLIED):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(begins[at : at + TALLIED], stops[at : at + TALLIED])], np.uint64)
        tally += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * tally > len(begins), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, ``mark`` (hash of the text) and ``fp`` (bigint) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, int] = {}
            prints = []
            for text in texts_of(batch, "text"):
                if text not in known:
                    known[text] = fingerprint(text, words)
                prints.append(known[text])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), pa.array(np.array(prints, np.uint64).view(np.int64))], names=["id", "mark", "fp"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = only(docs, id_column, text_column).toDF("id", "text")
    return rows.select("id", F.xxhash64("text").alias("mark"), "text").mapInArrow(run, f"id {kind}, mark bigint, fp bigint")


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j set, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = _bits(batch.column("fp")).astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        if n:
            cells = np.append(both.ravel(), n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells)), pa.int32()), pa.array(cells, pa.int64())], names=["cell", "n"])

    rows = distinct.select("fp").mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1)
    for row in rows:
        cells[row["cell"]] = row["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def _bits(column: pa.Array) -> np.ndarray:
    values = np.ascontiguousarray(column.to_numpy(zero_copy_only=False))
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlated_groups(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """The bits in ``m`` groups of like size; a group grows by the bit most correlated with it."""
    mean = both.diagonal() / max(n, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    tie = np.abs((both / max(n, 1) - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(tie, 0.0)
    left, groups = list(range(BITS)), []
    for g in range(m):
        size = len(left) // (m - g)
        own = [max(left, key=lambda b: (tie[b, left].sum(), -b))]
        left.remove(own[0])
        while len(own) < size:
            best = max(left, key=lambda b: (tie[b, own].sum(), -b))
            own.append(best)
            left.remove(best)
        groups.append(sorted(own))
    return groups


def mask_of(bits: list[int]) -> int:
    """A number with these bits set."""
    return sum(1 << b for b in bits)


def bucket_keys(values: np.ndarray, masks: list[int]) -> np.ndarray:
    """Bucket of each value (rows) under each mask (columns)."""
    m = np.array(masks, np.uint64)
    mixed = (values[:, None] & m) * MIX
    mixed ^= mixed >> np.uint64(29)
    return (mixed + np.arange(1, len(masks) + 1, dtype=np.uint64)) * MIX


def equal_pairs(distinct: DataFrame, masks: list[int]) -> np.ndarray:
    """For each mask, how many pairs of fingerprints agree on its bits; counted over all fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            keys = bucket_keys(values, masks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(len(masks), dtype=np.int32), len(values))), pa.array(keys.ravel().view(np.int64))], names=["mask", "key"]
            )

    counts = distinct.select("fp").mapInArrow(run, "mask int, key bigint").groupBy("mask", "key").count()
    rows = counts.groupBy("mask").agg(F.sum(F.expr("cast(count as double) * (count - 1) / 2")).alias("pairs")).collect()
    out = np.zeros(len(masks))
    for row in rows:
        out[row["mask"]] = row["pairs"]
    return out


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, one a partition, that sum to ``total`` at the least cost: dynamic programming over partial sums."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        ahead: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, picked) in best.items():
            for t, price in options.items():
                value = (cost + price, [*picked, t])
                if done + t not in ahead or value < ahead[done + t]:
                    ahead[done + t] = value
        best = ahead
    return best.get(total, (float("inf"), []))


def probe_masks(distinct: DataFrame, distance: int) -> list[int]:
    """The masks of the cheapest partitioning and thresholds for these fingerprints."""
    n, both = bit_statistics(distinct)
    if n < 2:
        return [(1 << BITS) - 1]
    mean = both.diagonal() / n
    differ = np.clip(2 * mean * (1 - mean), 1e-6, 0.999)
    odds = differ / (1 - differ)
    fewest = 1 + distance // 3
    plans = {m: correlated_groups(n, both, m) for m in range(fewest, min(fewest + 4, distance + 2))}
    flat = [(m, g) for m, groups in plans.items() for g in groups]
    equal = dict(zip([(m, tuple(g)) for m, g in flat], equal_pairs(distinct, [mask_of(g) for _, g in flat])))
    found = []
    for m, groups in plans.items():
        costs = []
        for g in groups:
            within, options = equal[m, tuple(g)], {-1: 0.0}
            near = [1.0, odds[g].sum(), (odds[g].sum() ** 2 - (odds[g] ** 2).sum()) / 2]
            for t in range(min(2, distance) + 1):
                # Of the masks without t bits, a pair that differs in j bits of the partition meets under C(w - j, t - j).
                pairs = within * sum(near[j] * comb(len(g) - j, t - j) for j in range(t + 1))
                options[t] = ROW_COST * n * comb(len(g), t) + pairs
            costs.append(options)
        found.append((*allocate(costs, distance - m + 1), groups))
    _, thresholds, groups = min(found, key=lambda x: x[0])
    return [mask_of(g) & ~mask_of(list(out)) for g, t in zip(groups, thresholds) if t >= 0 for out in itertools.combinations(g, t)]


def _into_buckets(masks: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False)
            for begin in range(0, len(values), 2_000):
                own = values[begin : begin + 2_000]
                keys = bucket_keys(own.view(np.uint64), masks)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(own, len(masks)))], names=["bucket", "fp"])

    return run


def _split_further(parts: int):
    """Rows of large buckets in ``parts`` smaller buckets each, by groups of the bits that vary in the large one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, bucket, varying = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("fp", "bucket", "varying"))
            bits = np.unpackbits(varying.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64)
            rank = np.cumsum(bits, 1) - 1
            group = rank * parts // np.maximum(bits.sum(1, keepdims=True), 1)
            for g in range(parts):
                mask = np.packbits(bits.astype(bool) & (group == g), axis=1, bitorder="little").view("<u8").ravel()
                key = (bucket ^ ((fp & mask) * MIX >> np.uint64(7))) * MIX + np.uint64(g + 1)
                key ^= key >> np.uint64(31)
                yield pa.RecordBatch.from_arrays([pa.array((key * MIX).view(np.int64)), pa.array(fp.view(np.int64))], names=["bucket", "fp"])

    return run


def linked(values: np.ndarray, buckets: np.ndarray, distance: int) -> np.ndarray:
    """For rows sorted by bucket: the least row that each is linked with, directly or through others of its bucket."""
    n = len(values)
    label = np.arange(n)
    one, other = [], []
    _, starts, sizes = np.unique(buckets, return_index=True, return_counts=True)
    last = np.repeat(starts + sizes, sizes)  # end of each row's bucket
    rows = np.arange(n)
    shift = 1
    while True:
        rows = rows[rows + shift < last[rows]]
        if not len(rows):
            break
        near = rows[np.bitwise_count(values[rows] ^ values[rows + shift]) <= distance]
        one.append(near)
        other.append(near + shift)
        shift += 1
    return label if not one else forest(label, np.concatenate(one), np.concatenate(other))


def forest(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each is connected with by the edges ``(a, b)``."""
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


def _compare(distance: int):
    """Forest edges of whole buckets; rows come sorted by bucket."""

    def edges(buckets: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        label = linked(values.view(np.uint64), buckets, distance)
        found = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(values[found]), pa.array(values[label[found]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_b, rest_v = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            b = np.concatenate([rest_b, batch.column("bucket").to_numpy(zero_copy_only=False)])
            v = np.concatenate([rest_v, batch.column("fp").to_numpy(zero_copy_only=False)])
            if not len(b):
                continue
            cut = int(np.searchsorted(b, b[-1]))  # the last bucket may go on in the next batch
            if cut:
                yield edges(b[:cut], v[:cut])
            rest_b, rest_v = b[cut:], v[cut:]
        if len(rest_b):
            yield edges(rest_b, rest_v)

    return run


def _compare_tiles(distance: int):
    """Forest edges between the rows of one side and those of the other in each unit; rows come sorted by bucket and unit."""

    def edges(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = pa.Table.from_batches(held)
        values, rest = unit.column("fp").to_numpy(), np.asarray(unit.column("rest"))
        left, right = np.flatnonzero(rest), np.flatnonzero(~rest)
        if not len(left) or not len(right):
            return
        bits = values.view(np.uint64)
        a, b = np.nonzero(np.bitwise_count(bits[left][:, None] ^ bits[right]) <= distance)
        label = forest(np.arange(len(values)), left[a], right[b])
        found = np.flatnonzero(values[label] != values)
        yield pa.RecordBatch.from_arrays([pa.array(values[found]), pa.array(values[label[found]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            keys = list(zip(batch.column("bucket").to_pylist(), batch.column("unit").to_pylist()))
            starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            for first, stop in zip(starts, [*starts[1:], len(keys)]):
                if held and keys[first] != key:
                    yield from edges(held)
                    held = []
                key = keys[first]
                held.append(batch.slice(first, stop - first))
        if held:
            yield from edges(held)

    return run


def _star(large: DataFrame, distance: int, tile: int) -> DataFrame:
    """Edges that connect what the pairs within large buckets connect.

    What lies within the distance of one member is connected through it. Only the others, few where a bucket holds near
    copies of a text, are compared with all of the bucket.
    """
    centres = large.groupBy("bucket").agg(F.min_by("fp", F.xxhash64("fp")).alias("centre"))
    led = stored(large.join(centres, "bucket").withColumn("rest", F.bit_count(F.col("fp").bitwiseXOR(F.col("centre"))) > distance))
    star = led.filter("not rest and fp <> centre").select(F.col("fp").alias("a"), F.col("centre").alias("b"))
    others = led.filter("rest")
    if others.isEmpty():
        return star
    tiles = F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("bigint").alias("tiles")
    # Written, so that the planner knows how few buckets there are and broadcasts these if anything, not their rows.
    sizes = stored(led.groupBy("bucket").agg(tiles, F.ceil(F.count_if("rest") / F.lit(tile)).cast("bigint").alias("rests")).filter("rests > 0"))
    sized = led.join(sizes, "bucket")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        rows = rows.withColumn("_own", F.pmod(F.xxhash64("fp", F.lit(3)), F.col(own)))
        return rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)))

    left = dealt(sized.filter("rest"), "rests", "tiles").select("bucket", F.expr("_own * tiles + _other").alias("unit"), "fp", F.lit(True).alias("rest"))
    right = dealt(sized, "tiles", "rests").select("bucket", F.expr("_other * tiles + _own").alias("unit"), "fp", F.lit(False).alias("rest"))
    units = left.unionByName(right).repartition("bucket", "unit").sortWithinPartitions("bucket", "unit")
    return star.unionByName(units.mapInArrow(_compare_tiles(distance), "a bigint, b bigint"))


def links(distinct: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Edges ``(a, b)`` that connect the same fingerprints as all pairs at most ``distance`` bits apart.

    ``distinct`` must be a written table of distinct ``fp``.
    """
    rows = distinct.select("fp").mapInArrow(_into_buckets(probe_masks(distinct, distance)), "bucket bigint, fp bigint")
    edges = None
    while True:
        sizes = rows.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"), F.expr("bit_or(fp) ^ bit_and(fp)").alias("varying")
        ).filter("n > 1")
        # The planner takes a fingerprint for one row, however many masks there are, and would broadcast them all.
        sized = stored(rows.hint("merge").join(sizes, "bucket"))
        # Each bucket of this size is whole in one task and in one run of rows.
        compared = (F.col("n") <= bucket) | (F.bit_count("varying") <= FEW_BITS)
        small = sized.filter(compared).select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket", "fp")
        found = small.mapInArrow(_compare(distance), "a bigint, b bigint")
        edges = found if edges is None else edges.unionByName(found)
        large = sized.filter(~compared)
        if large.isEmpty():
            return edges
        if distance > SPLIT_UP_TO:
            return edges.unionByName(_star(large.select("bucket", "fp"), distance, bucket))
        split = large.select("fp", "bucket", "varying").mapInArrow(_split_further(distance + 1), "bucket bigint, fp bigint")
        rows = split.distinct()


def near_classes(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, ``mark``, ``fp``, ``component`` (one fingerprint of the class) and ``component_id`` (least id of those connected by links) of every document."""
    # Repeated rows go here: after the join below, no grouping keeps the planner from splitting a very common fingerprint.
    prints = stored(fingerprints(docs, words, id_column, text_column).distinct())
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("least")))
    nodes = connected_components(links(distinct, distance))
    named = distinct.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = named.select("fp", "component").join(least, "component").select("fp", "component", "component_id")
    return prints.join(classes, "fp").select("id", "mark", "fp", "component", "component_id")


def shingle_set(text: str, words: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; a shorter text is one shingle, an empty one has none."""
    import xxhash

    own = text.encode().lower().split()
    last = max(len(own) - words, 0) + 1 if own else 0
    return np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(own[i : i + words]), 42) for i in range(last)], np.uint64))


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two shingle sets have this Jaccard similarity; empty sets are equal."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= similarity * (len(a) + len(b) - common)


class Leaders:
    """Documents that stay, found by the least hashes of their sets.

    Of two sets of the similarity s or more, the first n - ceil(s n) + 1 hashes of each have one in common.
    """

    def __init__(self, similarity: float) -> None:
        self.similarity = similarity
        self.sets: list[np.ndarray] = []
        self.by_hash: dict[int, list[int]] = {}

    def _prefix(self, own: np.ndarray) -> list[int]:
        return own[: len(own) - int(np.ceil(self.similarity * len(own) - 1e-9)) + 1].tolist() if len(own) else [-1]

    def near(self, own: np.ndarray) -> bool:
        """Whether a leader is similar to this set."""
        tried: set[int] = set()
        for h in self._prefix(own):
            for k in self.by_hash.get(h, ()):
                if k not in tried:
                    tried.add(k)
                    if alike(own, self.sets[k], self.similarity):
                        return True
        return False

    def add(self, own: np.ndarray) -> None:
        """One more leader."""
        for h in self._prefix(own):
            self.by_hash.setdefault(h, []).append(len(self.sets))
        self.sets.append(own)


#: Parts of a row in a comparison: a leader already, one to be compared and to lead if it is like none, one only to be compared.
LEADS, MAY_LEAD, FOLLOWS = 0, 1, 2


def _judge(similarity: float):
    """Rows sorted by component, slice and part, then in the order in which they lead; ``near`` says that a leader is similar.

    A repeated row has the answer of the first one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last, leaders = None, None, Leaders(similarity)
        for batch in batches:
            near = []
            for *at, part, id_, mark, grams in zip(*(batch.column(c).to_pylist() for c in ("component", "slice", "part", "id", "mark", "grams"))):
                if at != group:
                    group, last, leaders = at, None, Leaders(similarity)
                if last is not None and last[:3] == (part, id_, mark):
                    near.append(last[3])
                    continue
                own = np.frombuffer(grams, np.uint64)
                near.append(part != LEADS and leaders.near(own))
                if part == LEADS or part == MAY_LEAD and not near[-1]:
                    leaders.add(own)
                last = (part, id_, mark, near[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.bool_())], names=[*batch.schema.names, "near"])

    return run


def _judged(rows: DataFrame, similarity: float) -> DataFrame:
    dealt = rows.repartition("component", "slice").sortWithinPartitions("component", "slice", "part", F.isnull("id"), "id", "mark")
    return dealt.mapInArrow(_judge(similarity), T.StructType([*rows.schema.fields, T.StructField("near", T.BooleanType())]))


def near_copies(docs: DataFrame, words: int, distance: int, shingle: int = SHINGLE, similarity: float = SIMILARITY, heads: int = HEADS) -> DataFrame:
    """``id`` and ``mark`` of the documents that go, as a written table.

    Inside a class of linked fingerprints the documents lead in the order of their ids, unless they have the similarity to
    one that leads before them, exactly computed; those go. So each that goes is a near copy of one that stays, and of
    those that stay in a class no two are near copies. A class of more than ``heads`` documents is
    worked off in rounds: its next ``heads`` documents are told apart by one task, then the rest are compared with those that lead, in slices.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [shingle_set(t, shingle).tobytes() for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(grams, pa.binary())], names=[*names, "grams"])

    classes = stored(near_classes(docs, words, distance).select("id", "mark", "component"))
    sizes = classes.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = classes.join(sizes, "component")
    texts = only(docs, "doc_id", "text").toDF("_id", "text").withColumn("_mark", F.xxhash64("text"))
    found = texts.join(members, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_mark") == F.col("mark")))
    found = found.select("id", "mark", "component", "n", F.lit(0).cast("bigint").alias("slice"), F.lit(MAY_LEAD).alias("part"), "text")
    names = found.columns[:-1]
    rows = stored(found.mapInArrow(sets, T.StructType([*found.schema.fields[:-1], T.StructField("grams", T.BinaryType())])))
    key = ["component", "id", "mark"]
    gone = _judged(rows.filter(F.col("n") <= heads), similarity).filter("near").select(key)
    rest = rows.filter(F.col("n") > heads)
    while not rest.isEmpty():
        order = Window.partitionBy("component").orderBy(F.isnull("id"), "id", "mark")
        first = stored(rest.select(key).distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= heads).select(key))
        same = [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in key]
        ahead = rest.alias("r").join(first.alias("f"), same, "left_semi").select(rest.columns)
        told = stored(_judged(ahead, similarity))
        slices = F.ceil(F.col("n") / heads)
        leading = told.filter("not near").drop("near").withColumn("part", F.lit(LEADS)).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)))
        behind = rest.alias("r").join(first.alias("f"), same, "left_anti").select(rest.columns)
        behind = behind.withColumn("part", F.lit(FOLLOWS)).withColumn("slice", F.pmod(F.xxhash64("id", "mark"), slices))
        compared = stored(_judged(leading.select(rest.columns).unionByName(behind.select(rest.columns)), similarity).filter(F.col("part") == FOLLOWS))
        gone = gone.unionByName(told.filter("near").select(key)).unionByName(compared.filter("near").select(key))
        rest = compared.filter("not near").drop("near").withColumn("part", F.lit(MAY_LEAD)).withColumn("slice", F.lit(0).cast("bigint"))
    return stored(gone.select("id", "mark").distinct())


def without_near_copies(docs: DataFrame, words: int, distance: int, shingle: int = SHINGLE, similarity: float = SIMILARITY, heads: int = HEADS) -> DataFrame:
    """``docs`` without near copies of documents that stay, see :func:`near_copies`; rows and columns are otherwise as they were."""
    marked = docs.withColumn("_mark", F.xxhash64("text"))
    gone = near_copies(docs, words, distance, shingle, similarity, heads).select(F.col("id").alias("_id"), F.col("mark").alias("_gone_mark"))
    out = marked.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_gone_mark")), "left_anti")
    out = out.select(*docs.columns)
    repeats = marked.groupBy("doc_id", "_mark").count().filter("count > 1").limit(1).count()
    return out.dropDuplicates(["doc_id", "text"]) if repeats else out


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document."""
    found = near_classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
