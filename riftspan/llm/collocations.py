"""Phrase collocations from weighted acyclic automata of n-gram counts.

For each length from one word to five, one pass over the texts:

1. A task counts the n-grams of its texts in blocks, and adds the sorted n-grams of each block to those it holds. They leave
   as count automata (:mod:`automata`), cut at the bounds of prefix ranges.
2. The owner of a prefix range unites the automata that it gets, sums their weights, and keeps the n-grams that are
   frequent enough in an automaton of its own.
3. An n-gram can only be frequent if both of its parts without an end word are, so the next pass takes only n-grams
   whose parts pass a bitmap of at most ``FILTER_BITS`` bits. What passes by chance costs time only; counts are exact.

Bounds of the ranges are quantiles of a bounded sample; they decide how the work is dealt, not what comes out. A common first word is cut
like anything else, since ranges are bounded by whole n-grams. At last the parts of all candidates are looked up by composing the
automaton of the parts that fall into a range with that of the counts.

Defined results: a null text has no words; a null language is ``und``; repeated rows count as often as they occur; there are
no ids to be null; texts of any length are taken whole; ties end with the phrase in byte order; an empty table gives an
empty result; other columns are passed over.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riftspan.llm.automata import CountAutomaton, grouped, pack_words, union, unpack_words
from riftspan.llm.common import bounded_sample, only, opened, shared, stored, table

MOST_WORDS = 5
LEAST_COUNT = 100
TOP = 2000
UNKNOWN = "und"
#: Words of a block whose n-grams are sorted at once; n-grams and distinct words that a task holds before it sends them.
BLOCK, HELD, HELD_WORDS = 2_000_000, 2_000_000, 1_000_000
#: Bytes of a text that are split into words at once.
SPLIT = 1 << 20
#: Characters of all texts for each owner, on average.
PER_OWNER = 16_000_000
#: Documents, and n-grams of each block of them, from which the bounds of ranges are taken.
SAMPLE, SAMPLE_GRAMS = 2000, 4096
#: Upper bound of the bitmap: 2^26 bits are 8 MB.
FILTER_BITS = 26

_END = b"."
_NORMAL = bytes.maketrans(b",;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"......... abcdefghijklmnopqrstuvwxyz")
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words_and_ends(text: str, split: int) -> Iterator[list[bytes]]:
    """Words of a text in order, with ``.`` for every end of a piece, in lists of bounded size."""
    data = text.encode().translate(_NORMAL).replace(_END, b" . ")
    begin = 0
    while begin < len(data):
        stop = data.find(b" ", begin + split)
        stop = len(data) if stop < 0 else stop
        yield data[begin:stop].split()
        begin = stop


def gram_hashes(seed: int, columns: list[np.ndarray]) -> np.ndarray:
    """64 bits of each n-gram, from the hashes of its words."""
    h = np.full(len(columns[0]), seed, np.uint64)
    for c in columns:
        h = (h ^ c) * _P1
        h ^= h >> np.uint64(29)
        h *= _P2
    return h


def word_hash(word: bytes) -> int:
    """64 bits of a word or a language."""
    return xxhash.xxh64_intdigest(word, 12)


class Shard:
    """N-grams of one length that a task has counted and not yet sent."""

    def __init__(self, length: int, bitmap: np.ndarray | None, limits: tuple[int, int, int]) -> None:
        self.length, self.bitmap = length, bitmap
        self.most_held, self.most_words, self.split = limits
        self.reset()

    def reset(self) -> None:
        """Forget everything."""
        self.codes: defaultdict[bytes, int] = defaultdict()
        self.codes.default_factory = self.codes.__len__
        self.codes[_END]  # number 0
        self.hashes: list[int] = []
        self.streams: dict[str, list[np.ndarray]] = {}
        self.grams: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.waiting = self.held = 0

    def add(self, lang: str, text: str) -> None:
        """Take the words of a text."""
        stream = self.streams.setdefault(lang, [])
        for words in words_and_ends(text, self.split):
            stream.append(np.fromiter(map(self.codes.__getitem__, words), np.int32, len(words)))
            self.waiting += len(words)
        stream.append(np.zeros(1, np.int32))

    def count(self) -> None:
        """Count the n-grams of the waiting words."""
        known = list(self.codes)
        if self.length > 1:
            self.hashes += map(word_hash, known[len(self.hashes) :])
        hashes = np.array(self.hashes, np.uint64)
        for lang, parts in self.streams.items():
            rows, counts = self._block(np.concatenate(parts), hashes, word_hash(lang.encode()))
            own = self.grams.setdefault(lang, [])
            own.append((rows, counts))
            self.held += len(rows)
            if self.held > self.most_held and len(own) > 1:
                own[:] = [grouped(np.concatenate([r for r, _ in own]), np.concatenate([c for _, c in own]))]
        self.streams, self.waiting = {}, 0
        self.held = sum(len(r) for own in self.grams.values() for r, _ in own)

    def _block(self, codes: np.ndarray, hashes: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
        if self.length == 1:
            counts = np.bincount(codes)
            counts[0] = 0
            found = np.flatnonzero(counts)
            return found[:, None].astype(np.int32), counts[found]
        part = self.length - 1
        n = max(0, len(codes) - part + 1)
        inside = np.ones(n, bool)
        for j in range(part):
            inside &= codes[j : j + n] != 0
        at = np.flatnonzero(inside)
        prints = gram_hashes(seed, [hashes[codes[at + j]] for j in range(part)])
        passing = np.zeros(n + 1, bool)
        passing[at] = _in_bitmap(self.bitmap, prints)
        first = np.flatnonzero(passing[:-1] & passing[1:])
        rows = np.column_stack([codes[first + j] for j in range(self.length)])
        return grouped(rows, np.ones(len(rows), np.int64))

    def full(self) -> bool:
        """Whether what is held should be sent."""
        return self.held > self.most_held or len(self.codes) > self.most_words

    def sorted(self) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
        """Per language: words in byte order, n-grams as their numbers in order, counts."""
        known = list(self.codes)
        for lang, own in self.grams.items():
            rows = np.concatenate([r for r, _ in own])
            if not len(rows):
                continue
            used = np.unique(rows)
            words = [known[c] for c in used.tolist()]
            order = sorted(range(len(words)), key=words.__getitem__)
            rank = np.empty(len(known), np.int32)
            rank[used[order]] = np.arange(len(used))
            yield lang, [words[i] for i in order], *grouped(rank[rows], np.concatenate([c for _, c in own]))


def _in_bitmap(bitmap: np.ndarray, prints: np.ndarray) -> np.ndarray:
    slots = prints >> np.uint64(65 - int(8 * bitmap.nbytes).bit_length())
    return (bitmap[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63)) & np.uint64(1)).astype(bool)


def _shards(length: int, bitmap, emit, schema: pa.Schema):
    """A task that counts the n-grams of its texts; ``emit`` turns those of a language into rows."""

    block, limits = BLOCK, (HELD, HELD_WORDS, SPLIT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(length, None if bitmap is None else opened(bitmap), limits)

        def sent() -> Iterator[pa.RecordBatch]:
            shard.count()
            for own in shard.sorted():
                for rows in emit(*own):
                    yield pa.RecordBatch.from_pylist(rows, schema)
            shard.reset()

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                shard.add(lang.as_py(), text.as_py() or "")
                if shard.waiting >= block:
                    shard.count()
                    if shard.full():
                        yield from sent()
        yield from sent()

    return run


def _samples(lang: str, words: list[bytes], rows: np.ndarray, counts: np.ndarray) -> Iterator[list[dict]]:
    step = max(1, len(rows) // SAMPLE_GRAMS)
    yield [{"lang": lang, "gram": [words[c] for c in row]} for row in rows[::step].tolist()]


_SAMPLE = pa.schema([("lang", pa.string()), ("gram", pa.list_(pa.binary()))])
_MESSAGE = pa.schema([("lang", pa.string()), ("owner", pa.int32()), ("words", pa.binary()), ("arcs", pa.binary())])


def _messages(bounds: list[tuple]):
    def emit(lang: str, words: list[bytes], rows: np.ndarray, counts: np.ndarray) -> Iterator[list[dict]]:
        first, last = owner_of(bounds, lang, ()), bisect.bisect_left(bounds, (lang + "\0", ()))
        cuts = [bisect.bisect_left(range(len(rows)), bound, key=lambda i: tuple(words[c] for c in rows[i])) for _, bound in bounds[first:last]]
        for owner, (begin, stop) in enumerate(zip([0, *cuts], [*cuts, len(rows)]), first):
            if begin < stop:
                used, numbers = np.unique(rows[begin:stop], return_inverse=True)
                automaton = CountAutomaton.build(numbers.reshape(stop - begin, -1), counts[begin:stop])
                yield [{"lang": lang, "owner": owner, "words": pack_words([words[c] for c in used.tolist()]), "arcs": automaton.packed()}]

    return emit


def owner_of(bounds: list[tuple], lang: str, gram: tuple) -> int:
    """The range of an n-gram: how many bounds are not above it."""
    return bisect.bisect_right(bounds, (lang, gram))


def range_bounds(sample: DataFrame, length: int, bitmap, owners: int) -> list[tuple]:
    """``owners - 1`` bounds (language, words) between ranges of like size, from a sample of documents."""
    rows = sample.mapInArrow(_shards(length, bitmap, _samples, _SAMPLE), "lang string, gram array<binary>").collect()
    grams = sorted({(r["lang"], tuple(map(bytes, r["gram"]))) for r in rows})
    return sorted({grams[len(grams) * i // owners] for i in range(1, owners)}) if grams else []


def _unite(length: int):
    def run(messages: pa.Table) -> pa.Table:
        vocabularies = [unpack_words(w) for w in messages.column("words").to_pylist()]
        words = sorted(set().union(*vocabularies))
        number = {w: i for i, w in enumerate(words)}
        automata = [
            CountAutomaton.unpacked(a).relabelled(np.array([number[w] for w in own], np.int64))
            for a, own in zip(messages.column("arcs").to_pylist(), vocabularies)
        ]
        rows, counts = union(automata)
        frequent = counts >= LEAST_COUNT
        used, numbers = np.unique(rows[frequent], return_inverse=True)
        kept = CountAutomaton.build(numbers.reshape(-1, length), counts[frequent])
        return pa.table(
            {
                "lang": messages.column("lang").slice(0, 1),
                "owner": messages.column("owner").slice(0, 1),
                "length": pa.array([length], pa.int32()),
                "total": pa.array([int(counts.sum())], pa.int64()),
                "kept": pa.array([int(frequent.sum())], pa.int64()),
                "words": pa.array([pack_words([words[i] for i in used.tolist()])], pa.binary()),
                "arcs": pa.array([kept.packed()], pa.binary()),
            }
        )

    return run


_UNITED = "lang string, owner int, length int, total bigint, kept bigint, words binary, arcs binary"


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, words, arcs in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "arcs"))):
            hashes = np.array([word_hash(w) for w in unpack_words(words)], np.uint64)
            rows, _ = CountAutomaton.unpacked(arcs).paths()
            if len(rows):
                yield pa.RecordBatch.from_arrays([pa.array(gram_hashes(word_hash(lang.encode()), list(hashes[rows].T)).view(np.int64))], names=["print"])


def frequent_bitmap(united: DataFrame, frequent: int) -> np.ndarray:
    """One bit for the leading bits of each frequent n-gram's hash; about 16 times as many bits as n-grams, but at most 2^26."""
    bits = min(FILTER_BITS, max(10, (16 * frequent).bit_length()))
    slot = F.expr(f"shiftrightunsigned(print, {64 - bits})")
    flags = (
        united.mapInArrow(_prints, "print bigint")
        .select(slot.alias("slot"))
        .groupBy(F.expr("slot div 64").alias("place"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("flags"))
        .toPandas()
    )
    bitmap = np.zeros(1 << (bits - 6), np.uint64)
    bitmap[flags["place"].to_numpy(np.int64)] = flags["flags"].to_numpy(np.int64).view(np.uint64)
    return bitmap


def count_grams(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> tuple[DataFrame, dict[int, list[tuple]]]:
    """Automata of all n-grams that occur at least ``LEAST_COUNT`` times in a language, and the bounds of ranges by length.

    A row holds a range: ``lang``, ``owner``, ``length``, ``total`` (occurrences of all its n-grams, rare ones included),
    ``kept`` (n-grams in the automaton), ``words``, ``arcs``.
    """
    spark = docs.sparkSession
    texts = only(docs, lang_column, text_column).toDF("lang", "text")
    texts = texts.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    characters = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    owners = max(characters // PER_OWNER, min(2 * spark.sparkContext.defaultParallelism, characters // 500_000), 1)
    hashed = texts.withColumn("hash", F.xxhash64("text"))
    sample = stored(bounded_sample(hashed, "hash", SAMPLE).select("lang", "text"))
    tables, bounds, bitmap = [], {}, None
    for length in range(1, MOST_WORDS + 1):
        bounds[length] = range_bounds(sample, length, bitmap, owners)
        messages = texts.mapInArrow(_shards(length, bitmap, _messages(bounds[length]), _MESSAGE), "lang string, owner int, words binary, arcs binary")
        united = stored(messages.groupBy("lang", "owner").applyInArrow(_unite(length), _UNITED))
        tables.append(united)
        frequent = united.agg(F.sum("kept")).first()[0] or 0
        if not frequent:
            break
        if length < MOST_WORDS:
            bitmap = shared(spark, frequent_bitmap(united, frequent))
    return reduce(DataFrame.unionByName, tables), bounds


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, words, arcs in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "arcs"))):
            known = [w.decode() for w in unpack_words(words)]
            rows, counts = CountAutomaton.unpacked(arcs).paths()
            for first in range(0, len(rows), 10_000):
                part = rows[first : first + 10_000]
                phrases = [" ".join([known[c] for c in row]) for row in part.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array(phrases), pa.array(np.full(len(part), rows.shape[1], np.int32)), pa.array(counts[first : first + 10_000])],
                    names=["lang", "phrase", "length", "a"],
                )


def phrases_of(grams: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``length``, ``a`` of the n-grams in the automata."""
    return grams.mapInArrow(_phrases, "lang string, phrase string, length int, a bigint")


def _with_owner(bounds: dict[int, list[tuple]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("lang", "part", "length")))
            owners = [owner_of(bounds[n], lang, tuple(part.encode().split(b" "))) for lang, part, n in rows]
            yield batch.append_column("owner", pa.array(owners, pa.int32()))

    return run


_FOUND = pa.schema([("lang", pa.string()), ("part", pa.string()), ("f", pa.int64())])


def _compose(asked: pa.Table, counts: pa.Table) -> pa.Table:
    """Counts of the parts that fall into one range."""
    if not asked.num_rows or not counts.num_rows:
        return _FOUND.empty_table()
    words = unpack_words(counts.column("words")[0].as_py())
    number = {w: i for i, w in enumerate(words)}
    parts = [[number.get(w, -1) for w in p.encode().split(b" ")] for p in asked.column("part").to_pylist()]
    rows = np.array(parts, np.int64)
    rows, _ = grouped(rows[(rows >= 0).all(1)], np.zeros(int((rows >= 0).all(1).sum()), np.int64))
    found, f = CountAutomaton.build(rows, np.zeros(len(rows), np.int64)).composed(CountAutomaton.unpacked(counts.column("arcs")[0].as_py()))
    known = [w.decode() for w in words]
    return pa.table({"lang": [asked.column("lang")[0].as_py()] * len(found), "part": [" ".join([known[c] for c in r]) for r in found.tolist()], "f": f}, schema=_FOUND)


def part_counts(parts: DataFrame, grams: DataFrame, bounds: dict[int, list[tuple]]) -> DataFrame:
    """``lang``, ``part``, ``f`` for distinct ``lang``, ``part``, ``length``: looked up in the range that owns them."""
    key = ["lang", "length", "owner"]
    owned = parts.mapInArrow(_with_owner(bounds), "lang string, part string, length int, owner int")
    return owned.groupBy(*key).cogroup(grams.groupBy(*key)).applyInArrow(_compose, "lang string, part string, f bigint")


def collocations(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of all candidates that no longer one explains.

    A candidate is a phrase of two to five words of at least ``LEAST_COUNT`` occurrences; it goes if a longer one that
    holds it is as frequent, and then one that is longer by a word is as well.
    """
    grams, bounds = count_grams(docs, lang_column, text_column)
    n = grams.filter("length = 1").groupBy("lang").agg(F.sum("total").alias("n"))
    candidates = stored(phrases_of(grams.filter("length > 1")).withColumn("words", F.split("phrase", " ")))
    cuts = candidates.select("lang", "phrase", "length", "a", "words", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = stored(
        cuts.select(
            "lang", "phrase", "length", "a", "k",
            F.array_join(F.slice("words", 1, F.col("k")), " ").alias("head"),
            F.array_join(F.slice("words", F.col("k") + 1, F.col("length")), " ").alias("rest"),
        )
    )
    parts = cuts.select("lang", F.col("head").alias("part"), F.col("k").alias("length")).unionByName(
        cuts.select("lang", F.col("rest").alias("part"), (F.col("length") - F.col("k")).alias("length"))
    )
    looked_up = stored(part_counts(parts.distinct(), grams, bounds))
    held = candidates.filter("length > 2").select(
        "lang", "a", F.explode(F.array(F.slice("words", 1, F.col("length") - 1), F.slice("words", 2, F.col("length")))).alias("part")
    )
    explained = held.groupBy("lang", F.array_join("part", " ").alias("phrase")).agg(F.max("a").alias("longer"))
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = (
        cuts.join(looked_up.withColumnsRenamed({"part": "head", "f": "l"}), ["lang", "head"])
        .join(looked_up.withColumnsRenamed({"part": "rest", "f": "r"}), ["lang", "rest"])
        .join(n, "lang")
        .withColumn("score", score)
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
    )
    return (
        scored.join(explained, ["lang", "phrase"], "left")
        .filter("longer is null or 100 * longer < 100 * cut.a")
        .select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ``TOP`` collocations of each language."""
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = collocations(table(spark, sf_dir, "documents")).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= TOP).select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS row_no,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM p),
i AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w WHERE len(words) > 0),
g AS (SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase FROM i, range(1, 6) AS r(m) WHERE i + m - 1 <= len(words)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY lang, m, phrase),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE m BETWEEN 2 AND 5 AND f >= 100),
k AS (SELECT c.*, unnest(range(1, m)) AS k FROM c),
h AS (SELECT lang, m, phrase, a, k, array_to_string(words[1:k], ' ') AS head, array_to_string(words[k + 1:m], ' ') AS rest FROM k),
s AS (
  SELECT h.lang, h.m, h.phrase, h.a, x.f AS l, y.f AS r, n.n, (1000::HUGEINT * h.a * n.n) // (x.f::HUGEINT * y.f) AS score, h.k
  FROM h JOIN f x ON x.lang = h.lang AND x.m = h.k AND x.phrase = h.head
  JOIN f y ON y.lang = h.lang AND y.m = h.m - h.k AND y.phrase = h.rest JOIN n ON n.lang = h.lang
), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
d AS (SELECT b.* FROM b WHERE NOT EXISTS (
  SELECT 1 FROM c q WHERE q.lang = b.lang AND q.m > b.m AND contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * q.a >= 100 * b.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM d QUALIFY rank <= 2000
"""
