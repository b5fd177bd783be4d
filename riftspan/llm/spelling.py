"""Spelling variants by blocked Gram matrices of letter counts.

1. Words are counted on Spark. The letters are dealt into ``G`` groups of like weight, and the sums of a
   word over the groups are its block; the sums add up to the length of the word.
2. Words one edit apart lie in the same block (a letter replaced within its group), in blocks of adjacent
   length (one sum larger by one), or in two blocks that become the same by one letter less each (a letter
   replaced by one of another group). So each word is sent to its own block and, for every group it has a letter of,
   to the block with one less there. Any pair within one edit meets in exactly one block.
3. A task multiplies the letter counts of a block, tile by tile: the Gram matrix gives the squared distances, and
   pairs at most two apart are compared letter by letter. Only counts and the best partner of a word leave the task.
4. ``G`` grows until no block holds more than ``BLOCK`` words, so the work per word does not grow with the
   vocabulary. A meeting block that is still large is dealt over pairs of tiles.

Defined results: a null text has no words; a null id counts as empty where it enters the checksum; repeated rows
count as often as they occur; words of any length are kept whole; equal counts are decided by code-point order; an
empty table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.llm.common import only, stored, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of these letters, after lower-casing A-Z, are words.
RUN = "[a-zÀ-ÿ]+"
#: One in so many occurrences loses a letter, chosen by checksum.
TYPO_EVERY = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: Letters are counted in so many places; those beyond a-z share six, which can only bring words closer.
PLACES = 32
#: Words that one block may hold before letters are dealt into more groups.
BLOCK = 8192
#: Numbers of groups tried.
GROUPS = (2, 4, 6, 8, 12, 16, 24, 32)
#: Words of a meeting block that one task compares at once, and rows of a tile of its Gram matrix.
TOGETHER, TILE = 65_536, 2048
#: A partner is the form of a word if it is at least so many times as frequent.
FORM_RATIO = 2

_place = np.zeros(256, np.int64)
_place[97:123] = np.arange(26)
_place[0xC0:] = 26 + np.arange(64) % 6


def with_typos(run: Column, doc_id: Column) -> Column:
    """``run`` without one of its letters, in one of ``TYPO_EVERY`` occurrences."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % TYPO_EVERY == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word``, ``n``: words of at least ``LEAST_LENGTH`` letters that occur at least ``LEAST_COUNT`` times."""
    runs = F.regexp_extract_all(F.translate(F.col("text"), UPPER, LOWER), F.lit(RUN), F.lit(0))
    return (
        only(docs, id_column, text_column)
        .toDF("id", "text")
        .select("id", F.explode(runs).alias("run"))
        .select(with_typos(F.col("run"), F.col("id")).alias("word"))
        .filter(F.char_length("word") >= LEAST_LENGTH)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= LEAST_COUNT)
    )


def letter_counts(words: list[bytes]) -> np.ndarray:
    """How often each word has a letter of each place."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = _place[np.frombuffer(b"".join(words), np.uint8)]
    rows = np.repeat(np.arange(len(words)), lengths)
    return np.bincount(rows * PLACES + letters, minlength=len(words) * PLACES).reshape(-1, PLACES)


def deal_letters(weights: np.ndarray, groups: int) -> np.ndarray:
    """A matrix that adds the places of each group; groups have about the same weight."""
    own = np.zeros((PLACES, groups), np.int64)
    load = np.zeros(groups)
    for place in np.argsort(-weights, kind="stable"):
        lightest = int(np.lexsort((own.sum(0), load))[0])
        own[place, lightest] = 1
        load[lightest] += weights[place]
    return own


def _letter_weights(words: DataFrame) -> np.ndarray:
    """How often each place occurs over all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PLACES, np.int64)
        for batch in batches:
            total += letter_counts([w.encode("latin-1") for w in batch.column("word").to_pylist()]).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(PLACES)), pa.array(total)], names=["place", "n"])

    weights = np.zeros(PLACES)
    for row in words.select("word").mapInArrow(run, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).collect():
        weights[row["place"]] = row["n"]
    return weights


def _largest_block(words: DataFrame, dealt: np.ndarray) -> int:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = letter_counts([w.encode("latin-1") for w in batch.column("word").to_pylist()]) @ dealt
            yield pa.RecordBatch.from_arrays([pa.array([s.tobytes() for s in sums.astype("<i4")], pa.binary())], names=["block"])

    return words.select("word").mapInArrow(run, "block binary").groupBy("block").count().agg(F.max("count")).first()[0] or 0


def choose_groups(words: DataFrame) -> np.ndarray:
    """Letters dealt into as few groups as keep every block within ``BLOCK`` words, counted over all words."""
    weights = _letter_weights(words)
    for groups in GROUPS:
        dealt = deal_letters(weights, groups)
        if _largest_block(words, dealt) <= BLOCK:
            break
    return dealt


def _meetings(dealt: np.ndarray):
    """Each word for its own block (``side`` -1) and for the blocks with one letter less of a group (``side``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = (letter_counts([w.encode("latin-1") for w in batch.column("word").to_pylist()]) @ dealt).astype("<i4")
            rows, sides, blocks = [np.arange(len(sums))], [np.full(len(sums), -1)], [sums]
            for g in range(dealt.shape[1]):
                having = np.flatnonzero(sums[:, g])
                less = sums[having].copy()
                less[:, g] -= 1
                rows.append(having)
                sides.append(np.full(len(having), g))
                blocks.append(less)
            taken = batch.take(pa.array(np.concatenate(rows)))
            keys = [b.tobytes() for b in np.concatenate(blocks)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(np.concatenate(sides), pa.int32()), taken.column("word"), taken.column("n")],
                names=["block", "side", "word", "n"],
            )

    return run


def close_pairs(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``a`` and of ``b`` whose letter counts have a squared distance of at most two."""
    norms_a, norms_b = ((x * x).sum(1) / 2 for x in (a, b))
    kind = np.float32 if max(norms_a.max(initial=0), norms_b.max(initial=0)) < 1 << 22 else np.float64
    left = np.column_stack([a, -norms_a, np.ones(len(a))]).astype(kind)
    right = np.column_stack([b, np.ones(len(b)), -norms_b]).astype(kind).T
    for i in range(0, len(a), TILE):
        for j in range(0, len(b), TILE):
            half = left[i : i + TILE] @ right[:, j : j + TILE]  # minus half of the squared distances
            hit = np.flatnonzero(half >= -1)
            if len(hit):
                yield i + hit // half.shape[1], j + hit % half.shape[1]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words of equal length, as rows of letters, differ in one place."""
    return (a != b).sum(1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether ``long`` is ``short`` with one more letter: what is equal from both ends covers ``short``."""
    ahead = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(1)
    behind = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return ahead + behind >= short.shape[1]


def near_in_block(words: list[bytes], sides: np.ndarray, tiles: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of near words of one meeting block, each once; with two ``tiles`` only pairs across them."""
    order = np.argsort(sides, kind="stable")
    sides = sides[order]
    own = int(np.searchsorted(sides, 0))
    counts = letter_counts([words[i] for i in order])
    short, long = ([words[i] for i in part] for part in (order[:own], order[own:]))
    short = np.frombuffer(b"".join(short), np.uint8).reshape(own, -1) if own else np.empty((0, 0), np.uint8)
    long = np.frombuffer(b"".join(long), np.uint8).reshape(len(order) - own, -1) if own < len(order) else np.empty((0, 0), np.uint8)

    def found(first: int, stop: int, begin: int, end: int, check) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i, j in close_pairs(counts[first:stop], counts[begin:end]):
            i, j = i + first, j + begin
            if first == begin:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), 1 << 18):
                a, b = i[k : k + (1 << 18)], j[k : k + (1 << 18)]
                near = check(a, b)
                a, b = order[a[near]], order[b[near]]
                if across:
                    apart = tiles[a] != tiles[b]
                    a, b = a[apart], b[apart]
                yield a, b

    across = len(tiles) > 0 and tiles.min() != tiles.max()
    if own:
        yield from found(0, own, 0, own, lambda a, b: one_replaced(short[a], short[b]))
    if own and own < len(order):
        yield from found(0, own, own, len(order), lambda a, b: one_inserted(short[a], long[b - own]))
    edges = np.searchsorted(sides, np.arange(sides.max(initial=-1) + 2))
    for first, stop in zip(edges[:-1], edges[1:]):  # within one group the pair meets in its own block
        if first < stop < len(order):
            yield from found(first, stop, stop, len(order), lambda a, b: one_replaced(long[a - own], long[b - own]))


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each meeting block; blocks come one after the other."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(batch.column("block").to_pylist(), batch.column("unit").to_pylist()))
        starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        for first, stop in zip(starts, [*starts[1:], len(keys)]):
            if keys[first] != key:
                yield from _compared(held)
                held, key = [], keys[first]
            held.append(batch.slice(first, stop - first))
    yield from _compared(held)


def _compared(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sum(b.num_rows for b in held)
    if rows < 2:
        return
    block = pa.Table.from_batches(held)
    texts = block.column("word").to_pylist()
    words = [w.encode("latin-1") for w in texts]
    n = block.column("n").to_numpy()
    ranked = sorted(range(rows), key=lambda i: (-n[i], words[i]))  # the best partner first
    rank = np.empty(rows, np.int64)
    rank[ranked] = np.arange(rows)
    near, best = np.zeros(rows, np.int64), np.full(rows, rows)
    for a, b in near_in_block(words, block.column("side").to_numpy(), block.column("tile").to_numpy()):
        near += np.bincount(a, minlength=rows) + np.bincount(b, minlength=rows)
        np.minimum.at(best, a, rank[b])
        np.minimum.at(best, b, rank[a])
    hit = np.flatnonzero(near)
    if len(hit):
        forms = [ranked[best[i]] for i in hit]
        yield pa.RecordBatch.from_arrays(
            [pa.array([texts[i] for i in hit]), pa.array(near[hit]), pa.array([texts[i] for i in forms]), pa.array(n[forms])], schema=_NEAR
        )


def near_words(words: DataFrame, dealt: np.ndarray) -> DataFrame:
    """``word``, ``n_near``, and the most frequent near word ``form`` with its ``form_n``, for words that have near words."""
    meetings = words.select("word", "n").mapInArrow(_meetings(dealt), "block binary, side int, word string, n bigint")
    large = stored(
        meetings.groupBy("block").count().filter(F.col("count") > TOGETHER).select("block", F.ceil(F.col("count") * 2 / TOGETHER).cast("int").alias("tiles"))
    )
    if large.isEmpty():
        units = meetings.withColumns({"tile": F.lit(0), "unit": F.lit(0)})
    else:
        tiles = F.coalesce("tiles", F.lit(1))
        other = F.explode(F.sequence(F.lit(0), tiles - 1))
        dealt_out = meetings.join(large, "block", "left").withColumn("tile", F.pmod(F.xxhash64("word"), tiles).cast("int")).withColumn("other", other)
        unit = F.least("tile", "other") * tiles + F.greatest("tile", "other")
        units = dealt_out.select("block", "side", "word", "n", "tile", unit.cast("int").alias("unit"))
    found = units.repartition("block", "unit").sortWithinPartitions("block", "unit").mapInArrow(_compare, "word string, n_near bigint, form string, form_n bigint")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))


def last_forms(links: DataFrame) -> DataFrame:
    """``word``, ``root`` from ``word``, ``form``: forms followed to the last, twice as far with each round.

    The count doubles from a word to its form, so a chain is never longer than a count has bits.
    """
    ways = stored(links.select("word", F.col("form").alias("root")))
    while True:
        onward = ways.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        joined = stored(ways.join(onward, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_to", "root").alias("root"), F.isnotnull("_to").alias("_more")))
        ways = joined.select("word", "root")
        if joined.filter("_more").isEmpty():
            return ways


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every word of :func:`word_counts`."""
    words = stored(word_counts(docs, id_column, text_column))
    near = near_words(words, choose_groups(words))
    fits = F.col("form_n") >= FORM_RATIO * F.col("n")
    formed = stored(
        words.join(near, "word", "left").select(
            "word", F.when(fits, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("form_n")).alias("form_n")
        )
    )
    roots = last_forms(formed.filter("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spelling variants of the words of all documents."""
    return spelling_variants(table(spark, sf_dir, "documents"))
