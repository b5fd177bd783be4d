"""Character language models with interpolated Kneser-Ney smoothing over a bounded alphabet.

Characters fall into 128 classes: 0 for everything but letters, 1 to 26 for a to z, the rest for
other letters by code point, all in lower case. A trigram is thus one of 2^21 codes whatever the
corpus, which bounds a model by proof rather than by pruning. Counts come from all texts: tasks add
up the trigrams of a batch, Spark adds up the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riftspan.llm.common import slices, texts_of

BITS = 7
CLASSES = 1 << BITS
CODES = 1 << 3 * BITS
#: Characters counted or scored at once.
CHARACTERS = 2_000_000
#: An odd multiplier: spreads codes over 64 bits without collisions.
MIX = np.uint64(0x9E3779B97F4A7C15)


def class_table() -> np.ndarray:
    """Class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            low = ord(low) if len(low) == 1 else code
            table[code] = low - 96 if 97 <= low <= 122 else 27 + low % (CLASSES - 27)
    return table


def windows(texts: list[str], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes of the texts one after the other, and the number of codes of each text.

    A text is set between non-letters. Windows that end in two non-letters say nothing and are left out.
    """
    joined = "\0\0" + "\0\0".join(texts) + "\0\0"
    c = classes[np.frombuffer(joined.encode("utf-32-le"), "<u4")].astype(np.int32)
    last, before = c[2:], c[1:-1]
    told = (last | before) != 0
    codes = (c[:-2] << 2 * BITS | before << BITS | last)[told]
    owner = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    return codes, np.bincount(owner[told], minlength=len(texts))


def letters(texts: list[str], classes: np.ndarray) -> np.ndarray:
    """Whether each text has a letter."""
    return np.array([bool(classes[np.frombuffer(t.encode("utf-32-le"), "<u4")].any()) for t in texts], bool)


def trigram_counts(docs: DataFrame, group: str | None, classes) -> DataFrame:
    """``(grp, code, n)``: how often each trigram occurs in the texts of each group (``classes`` is a broadcast table)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = classes.value
        for batch in batches:
            groups = pd.Series(batch.column("grp").to_pylist(), dtype=object)
            texts = texts_of(batch, "text")
            for name, rows in groups.groupby(groups).indices.items():
                own = [texts[i] for i in rows]
                for begin, end in slices(own, CHARACTERS):
                    n = np.bincount(windows(own[begin:end], table)[0], minlength=CODES)
                    codes = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(codes, pa.int32()), pa.array(n[codes], pa.int64())], names=["grp", "code", "n"])

    label = F.lit("") if group is None else F.col(group).cast("string")
    return docs.select(label.alias("grp"), "text").mapInArrow(count, "grp string, code int, n bigint").groupBy("grp", "code").agg(F.sum("n").alias("n"))


@dataclass
class KneserNey:
    """Interpolated Kneser-Ney trigrams, as sorted arrays of hashed codes."""

    trigrams: np.ndarray
    trigram_log: np.ndarray
    contexts: np.ndarray
    context_weight: np.ndarray
    bigrams: np.ndarray  # continuation probability of a class after a class, dense: 2^14 entries

    @staticmethod
    def fit(codes: np.ndarray, counts: np.ndarray) -> KneserNey:
        """The model of the given trigram counts (distinct codes)."""
        codes, counts = codes.astype(np.int64), counts.astype(np.float64)
        pair = codes & (1 << 2 * BITS) - 1  # last two classes
        context = codes >> BITS  # first two classes
        # Unigrams and bigrams count in how many contexts a class goes on, not how often.
        continued = np.bincount(pair, minlength=CLASSES * CLASSES).astype(float).reshape(CLASSES, CLASSES)
        d2 = _discount(continued[continued > 0])
        ahead = (continued > 0).sum(0).astype(float)
        unigram = (ahead + 1) / (ahead.sum() + CLASSES)
        total = continued.sum(1, keepdims=True)
        weight = np.where(total > 0, d2 * (continued > 0).sum(1, keepdims=True) / np.maximum(total, 1), 1.0)
        bigrams = np.maximum(continued - d2, 0) / np.maximum(total, 1) + weight * unigram
        d3 = _discount(counts)
        seen, inverse = np.unique(context, return_inverse=True)
        totals = np.bincount(inverse, counts)
        weights = d3 * np.bincount(inverse) / totals
        p = np.maximum(counts - d3, 0) / totals[inverse] + weights[inverse] * bigrams.ravel()[pair]
        keys, context_keys = hashed(codes), hashed(seen)
        by_key, by_context = np.argsort(keys), np.argsort(context_keys)
        return KneserNey(keys[by_key], np.log(p)[by_key].astype(np.float32), context_keys[by_context], weights[by_context].astype(np.float32), bigrams.astype(np.float32))

    def log_probability(self, codes: np.ndarray) -> np.ndarray:
        """Natural log of the probability of the last class of each trigram after the first two."""
        codes = codes.astype(np.int64)
        weight = _found(self.contexts, self.context_weight, hashed(codes >> BITS), 1.0)
        lower = np.log(weight * self.bigrams.ravel()[codes & (1 << 2 * BITS) - 1])
        known = _found(self.trigrams, self.trigram_log, hashed(codes), np.nan)
        return np.where(np.isnan(known), lower, known)


def hashed(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of codes, without collisions."""
    return codes.astype(np.uint64) * MIX


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), otherwise)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at].astype(np.float64), otherwise)


def _discount(counts: np.ndarray) -> float:
    once, twice = (counts == 1).sum(), (counts == 2).sum()
    return once / (once + 2 * twice) if once and twice else 0.75


def fit_models(counts: DataFrame) -> dict[str, KneserNey]:
    """A model for each group of :func:`trigram_counts`; at most 2^21 rows a group reach the driver."""
    rows = counts.toPandas().sort_values(["grp", "code"])
    return {g: KneserNey.fit(own["code"].to_numpy(), own["n"].to_numpy()) for g, own in rows.groupby("grp")}


def cross_entropies(texts: list[str], models: list[KneserNey], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nats per window of each text under each model (texts x models), and the windows of each text."""
    out, sizes = [np.empty((0, len(models)))], [np.empty(0, np.int64)]
    for begin, end in slices(texts, CHARACTERS):
        codes, n = windows(texts[begin:end], classes)
        distinct = np.flatnonzero(np.bincount(codes, minlength=CODES))
        place = np.zeros(CODES, np.int32)
        place[distinct] = np.arange(len(distinct), dtype=np.int32)
        at, owner = place[codes], np.repeat(np.arange(end - begin), n)
        logs = [np.bincount(owner, m.log_probability(distinct)[at], minlength=end - begin) for m in models]
        out.append(-np.column_stack(logs) / np.maximum(n, 1)[:, None])
        sizes.append(n)
    return np.concatenate(out), np.concatenate(sizes)
