"""Language by interpolated Kneser-Ney character models, one per language.

Models are counted over all learning rows. A text gets the language whose model gives the lowest
cross-entropy per character. The score turns the lead over the other languages into a probability
with a temperature fitted on all learning rows, and a text is marked ``rejected`` if that probability is
under one half or its cross-entropy is beyond what all but a thousandth of the learning rows of that
language have. Both are found by a second pass over the learning rows, of which the driver gets sums and limits only.

Defined results: null texts and texts without a letter are ``und`` with score 0 and rejected; ties go
to the first language by name; without learning rows everything is ``und``; repeated rows give
repeated results; other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.llm.charlm import KneserNey, class_table, cross_entropies, fit_models, letters, trigram_counts
from riftspan.llm.common import held_out, only, opened, shared, stored, table, texts_of
from riftspan.operators.quantiles import exact_quantiles

#: Temperatures that are tried on all learning rows.
TEMPERATURES = 2.0 ** np.arange(-6, 7)
#: Share of a language's learning rows whose cross-entropy is within its limit.
WITHIN = 0.999
UNKNOWN = "und"


@dataclass
class LanguageModels:
    """Models by language with their calibration."""

    names: list[str]
    models: list[KneserNey]
    temperature: float
    limits: np.ndarray

    def predict(self, texts: list[str], classes: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and rejection of each text."""
        known = letters(texts, classes)
        if not self.names:
            none = np.zeros(len(texts))
            return [UNKNOWN] * len(texts), none, none, np.ones(len(texts), bool)
        entropy, n = cross_entropies(texts, self.models, classes)
        best = entropy.argmin(1) if len(texts) else np.empty(0, int)
        score = np.where(known, posterior(entropy, n, self.temperature), 0.0)
        least = entropy[np.arange(len(texts)), best]
        rejected = ~known | (score < 0.5) | (least > self.limits[best])
        return [self.names[b] if k else UNKNOWN for b, k in zip(best, known)], score, np.where(known, least, 0.0), rejected


def posterior(entropy: np.ndarray, n: np.ndarray, temperature: float) -> np.ndarray:
    """Probability of the best language; evidence grows with the root of the length, as characters depend on each other."""
    lead = (entropy - entropy.min(1, keepdims=True)) * np.sqrt(np.maximum(n, 1))[:, None] * temperature
    return 1.0 / np.exp(-lead).sum(1)


def train(labelled: DataFrame, classes) -> LanguageModels:
    """Models from rows of ``doc_id``, ``text`` and ``lang``; rows without text or language teach nothing."""
    rows = labelled.filter("lang is not null and text is not null").select("lang", "text")
    fitted = fit_models(trigram_counts(rows, "lang", classes))
    names = sorted(fitted)
    models = [fitted[n] for n in names]
    if not names:
        return LanguageModels(names, models, 1.0, np.empty(0))
    return calibrated(rows, names, models, classes)


def calibrated(rows: DataFrame, names: list[str], models: list[KneserNey], classes) -> LanguageModels:
    """The models with temperature and limits from all of ``rows`` (``lang``, ``text``); rows of a language without a model say nothing."""
    box = shared(rows.sparkSession, models)
    number = {name: k for k, name in enumerate(names)}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = opened(box)
        total = np.zeros(len(TEMPERATURES))
        for batch in batches:
            texts, truth = texts_of(batch, "text"), np.array([number[name] for name in batch.column("lang").to_pylist()], int)
            entropy, n = cross_entropies(texts, fitted, classes.value)
            lead = (entropy - entropy.min(1, keepdims=True)) * np.sqrt(np.maximum(n, 1))[:, None]
            at = np.arange(len(texts)), truth
            total += [np.sum(np.log(np.exp(-lead * t).sum(1)) + lead[at] * t) for t in TEMPERATURES]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(entropy[at]), pa.nulls(len(texts), pa.list_(pa.float64()))], names=["lang", "own", "loss"])
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.nulls(1, pa.float64()), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["lang", "own", "loss"])

    known = rows.select(F.col("lang").cast("string").alias("lang"), "text").filter(F.col("lang").isin(names))
    judged = stored(known.mapInArrow(judge, "lang string, own double, loss array<double>"))
    loss = judged.filter("loss is not null").agg(*[F.sum(F.get("loss", F.lit(i))) for i in range(len(TEMPERATURES))]).first()
    found = exact_quantiles(judged.filter("lang is not null"), ["lang"], "own", {"most": WITHIN})
    most = {r["lang"]: r["most"] for r in found.collect()}
    return LanguageModels(names, models, float(TEMPERATURES[int(np.argmin(loss))]), np.array([most[name] for name in names]))


def identify(docs: DataFrame, models: LanguageModels, classes, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``lang_pred``, ``score``, ``cross_entropy``, ``rejected`` of every document."""
    box = shared(docs.sparkSession, models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = opened(box)
        for batch in batches:
            names, score, entropy, rejected = fitted.predict(texts_of(batch, text_column), classes.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(entropy, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[id_column, "lang_pred", "score", "cross_entropy", "rejected"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return only(docs, id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, lang_pred string, score double, cross_entropy double, rejected boolean")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four folds of five."""
    docs = table(spark, sf_dir, "documents")
    classes = spark.sparkContext.broadcast(class_table())
    models = train(docs.filter(~held_out("doc_id")), classes)
    found = identify(docs, models, classes)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
