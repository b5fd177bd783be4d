"""Toxicity of texts whose words may be disguised.

1. A character language model (Kneser-Ney trigrams) is counted over all texts of the corpus.
2. Words that may be disguised (a look-alike, a doubled letter, a sign inside) become a lattice: a
   character may stand for itself, for a letter it looks like, for a repetition of the letter before,
   for the end of a word, or for nothing; a run of groups of one or two characters set apart by any
   white space is one such lattice, and runs of single characters in it are once more. Viterbi decoding, which keeps every state, finds the reading that
   the language model and the channel costs together make likeliest, with and without repetitions.
   A word is also read as it stands and as the parts between its signs, since most doubled letters,
   hyphens and commas are meant.
3. The restored words of labelled rows give evidence: for each word, and for each beginning of five
   letters, the log-odds of toxic rows at the cautious end of its confidence interval. A text's
   evidence is the sum over its distinct words; the score is evidence / (evidence + threshold), with
   the threshold that separates the learning rows best.

Distinct words are decoded about once per task. Documents are independent, so nothing is shuffled but
counts. Defined results: null or empty texts have score 0; repeated rows give repeated results; very
long texts and words are decoded whole, in time and memory proportional to their length; of equally
likely readings the one found first in the order of the fixed tables counts; if no toxic row can be
learned from, all scores are 0; other columns are passed over.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.llm.charlm import BITS, CLASSES, KneserNey, class_table, fit_models, trigram_counts
from riftspan.llm.common import held_out, labelled_sample, only, opened, shared, table, texts_of

#: Letters that a character is commonly put for. Fixed values.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "#": "h", "*": "aeiou",
}

#: Costs in nats of the channel: a look-alike, a repeated letter, a sign put in between, a sign that ends a word, a look-alike that means nothing,
#: a digit left as it is. White space in a lattice may be nothing or the end of a word at no cost.
SUBSTITUTED, REPEATED, INSERTED, BROKEN, IDLE, KEPT = 1.0, 0.7, 1.5, 4.0, 10.0, 12.0
#: Learning rows: about so many labelled rows, chosen by a hash of the id.
LEARNING_ROWS = 20_000
#: Characters of words remembered by a task, and of the longest word that is.
REMEMBERED, LONGEST = 6_000_000, 100
#: Letters of a word's beginning that count as evidence of their own.
BEGINNING = 5
#: Rows in which a toxic word must occur.
LEAST_ROWS = 3
#: Standard errors taken off a feature's log-odds, and the log-odds that must then be left.
CAUTION, LEAST_EVIDENCE = 2.5, 0.7

#: The last two classes of a trigram's code.
PAIR = (1 << 2 * BITS) - 1
WORD = re.compile(r"\S+")
#: Three or more groups of one or two characters in a row.
SPACED = re.compile(r"(?<!\S)\S{1,2}(?:\s+\S{1,2}){2,}(?!\S)")
#: Three or more single characters in a row.
SINGLE = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
#: Surely disguised: a look-alike between letters or at their edge, a letter three times in a row, or letters set apart by signs.
DISGUISED = re.compile(r"[^\W\d_][^\w\s]*[0-9@$!|+(<€£¡#*]+[^\w\s]*[^\W\d_]|^[0-9@$!|+(<€£¡]+[^\W\d_]|[^\W\d_][0-9@$€£]+\W*$|([^\W\d_])\1\1|[^\W\d_](?:[\W_]+[^\W\d_]){2}")
#: Perhaps disguised: a doubled letter, a sign between letters, or look-alikes only.
PERHAPS = re.compile(r"([^\W\d_])\1|[^\W\d_][\W_]+[^\W\d_]|^(?=.*[@$€£])[0-9@$!|+(<€£¡#*]{3,}$")
#: A character twice in a row.
DOUBLED = re.compile(r"(\S)\1")
SIGNS = re.compile(r"[\W_]+")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


@dataclass
class Lattice:
    """Viterbi decoding of disguised words under a character model."""

    table: np.ndarray  # log probability by (class, class, class)
    classes: np.ndarray

    @staticmethod
    def under(model: KneserNey, classes: np.ndarray) -> Lattice:
        """With all trigrams laid out, since lattices ask for many."""
        codes = np.arange(1 << 3 * BITS)
        return Lattice(model.log_probability(codes).astype(np.float32).reshape(CLASSES, CLASSES, CLASSES), classes)

    @cached_property
    def costs(self) -> array:
        """The table as plain numbers, by class << 14 | class << 7 | class."""
        return array("f", (-self.table).ravel().tobytes())

    @cached_property
    def class_of(self) -> bytes:
        """Classes as plain numbers."""
        return self.classes.tobytes()

    @cached_property
    def options(self) -> dict[str, list[tuple[str, int, float]]]:
        """Readings of the characters met so far."""
        return {}

    def readings(self, c: str) -> list[tuple[str, int, float]]:
        """What a character may stand for, with classes and costs; an empty text is nothing at all, a blank the end of a word."""
        if c.isspace():
            found = [("", 0.0), (" ", 0.0)]
        elif c.isalpha():
            found = [(c, 0.0)]
        else:
            like = [(x, SUBSTITUTED) for x in LOOKS_LIKE.get(c, "")]
            found = [*like, ("", IDLE if like else INSERTED), *[(c, KEPT)] * c.isdigit(), *[(" ", BROKEN)] * (not like)]
        return [(x, self.class_of[ord(x)] if x else 0, price) for x, price in found]

    def decode(self, text: str, repeats: bool = True) -> str:
        """The likeliest reading; without ``repeats`` every letter is meant.

        A state is the last two classes and the last letter, of which there are a bounded number however long the text is.
        Paths are chains that share their beginnings.
        """
        costs, known = self.costs, self.options
        states: dict[tuple[int, str], tuple[float, tuple | None]] = {(0, ""): (0.0, None)}
        for c in text.lower():
            options = known.get(c)
            if options is None:
                options = known[c] = self.readings(c)
            ahead: dict[tuple[int, str], tuple[float, tuple | None]] = {}
            for key, (cost, path) in states.items():
                context, last = key
                for letter, kind, price in options:
                    spent = cost + price
                    if letter:
                        total = spent + costs[context << BITS | kind]
                        new = ((context << BITS | kind) & PAIR, letter)
                        if new not in ahead or total < ahead[new][0]:
                            ahead[new] = (total, (path, letter))
                        if letter != last or not repeats or letter == " ":
                            continue
                        spent += REPEATED  # the same letter once more, said only once
                    if key not in ahead or spent < ahead[key][0]:
                        ahead[key] = (spent, path)
            states = ahead
        path = min(((cost + costs[context << BITS], path) for (context, _), (cost, path) in states.items()), key=lambda x: x[0])[1]
        out = []
        while path is not None:
            path, letter = path
            out.append(letter)
        return "".join(reversed(out))


class Restorer:
    """Readings of the words of texts; a distinct word is looked at once as long as it is remembered."""

    def __init__(self, lattice: Lattice) -> None:
        self.lattice = lattice
        self.known: dict[str, tuple[str, ...]] = {}
        self.room = REMEMBERED

    def _remember(self, w: str, found: tuple[str, ...]) -> tuple[str, ...]:
        if len(w) <= LONGEST:
            self.room -= len(w)
            if self.room < 0:
                self.known.clear()
                self.room = REMEMBERED
            self.known[w] = found
        return found

    def word(self, w: str) -> tuple[str, ...]:
        """Readings of a word: as it stands (without signs at the edges), as the parts that signs set apart, and decoded."""
        found = self.known.get(w)
        if found is not None:
            return found
        if w.isalpha():  # can only be disguised by repetition, and has no signs
            return self._remember(w, (w, *self.decoded(w)) if DOUBLED.search(w) else (w,))
        plain = EDGES.sub("", w)
        if not (PERHAPS.search(w) or DISGUISED.search(w)):
            return self._remember(w, (plain,))
        return self._remember(w, (plain, *(x for x in SIGNS.split(plain) if x != plain), *self.decoded(w)))

    def decoded(self, w: str) -> list[str]:
        """Words of the likeliest readings."""
        found = self.lattice.decode(w).split()
        if w.isalpha() or not DOUBLED.search(w):  # letters without repetitions can only be read as they stand
            return found
        return found + self.lattice.decode(w, repeats=False).split()

    def spaced(self, run: str) -> tuple[str, ...]:
        """Words that a run of short groups reads as."""
        key = " ".join(run.split())
        found = self.known.get(key)
        return found if found is not None else self._remember(key, tuple(self.decoded(key)))

    def words(self, text: str) -> set[str]:
        """Distinct words of a text by all readings."""
        low = text.lower()
        out: set[str] = set()
        for w in set(low.split()):
            out.update(self.word(w))
        for m in SPACED.finditer(low):
            run = m.group()
            for own in {run, *(x.group() for x in SINGLE.finditer(run))}:
                if any(map(str.isalpha, own)):
                    out.update(self.spaced(own))
        out.discard("")
        return out

    def restored(self, text: str) -> str:
        """A text with the words restored that are surely disguised."""
        decode = self.lattice.decode
        joined = SINGLE.sub(lambda m: decode(" ".join(m.group().split())) if any(map(str.isalpha, m.group())) else m.group(), text)
        return WORD.sub(lambda m: decode(m.group()) if DISGUISED.search(m.group().lower()) else m.group(), joined)


def features(words: set[str]) -> set[str]:
    """Evidence-bearing parts of a text: its words and their beginnings."""
    return words | {w[:BEGINNING] + "*" for w in words if len(w) > BEGINNING}


@dataclass
class ToxicityModel:
    """Evidence by feature, and the evidence at which the score is one half."""

    evidence: dict[str, float]
    threshold: float

    def score(self, words: set[str]) -> float:
        """From 0 to 1; a word counts by the stronger of itself and its beginning."""
        get = self.evidence.get
        total = sum(max(get(w, 0.0), get(w[:BEGINNING] + "*", 0.0)) for w in words)
        return total / (total + self.threshold) if total else 0.0


def corpus_lattice(docs: DataFrame, text_column: str = "text") -> Lattice:
    """The lattice decoder under the character model of all texts."""
    table_of = class_table()
    classes = docs.sparkSession.sparkContext.broadcast(table_of)
    models = fit_models(trigram_counts(only(docs, text_column).toDF("text"), None, classes))
    empty = np.empty(0, np.int64)
    return Lattice.under(models[""] if models else KneserNey.fit(empty, empty), table_of)


def cautious_log_odds(toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int) -> np.ndarray:
    """Log-odds of toxic against clean rows, ``CAUTION`` standard errors towards none."""
    a, b = toxic + 0.5, clean + 0.5
    odds = np.log(a / (all_toxic + 1)) - np.log(b / (all_clean + 1))
    return odds - CAUTION * np.sqrt(1 / a + 1 / b)


def train(labelled: DataFrame, box) -> ToxicityModel:
    """The model of rows of ``text`` and ``toxic`` (0 or 1); ``box`` holds the shared lattice.

    The rows are read twice and are few enough that their distinct features fit the driver.
    """
    sample = labelled

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(opened(box))
        for batch in batches:
            for kind in (0, 1):
                n: Counter = Counter()
                rows = 0
                for text, toxic in zip(texts_of(batch, "text"), batch.column("toxic").to_pylist()):
                    if int(toxic > 0) == kind:
                        n.update(features(restorer.words(text)))
                        rows += 1
                n[" rows"] = rows
                yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([kind] * len(n), pa.int32()), pa.array(list(n.values()), pa.int64())], names=["feature", "toxic", "n"])

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(opened(box))
        for batch in batches:
            scores = [unscaled.score(restorer.words(t)) for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([pa.array(scores, pa.float64()), pa.array([int(t > 0) for t in batch.column("toxic").to_pylist()], pa.int32())], names=["score", "toxic"])

    counted = only(sample, "text", "toxic").mapInArrow(parts, "feature string, toxic int, n bigint").groupBy("feature").agg(
        F.sum(F.expr("if(toxic = 1, n, 0)")).alias("bad"), F.sum(F.expr("if(toxic = 0, n, 0)")).alias("good")
    )
    # Only features that can give evidence leave the executors; their number is bounded by the sample.
    found = counted.filter(f"feature = ' rows' or bad >= {LEAST_ROWS} and bad * 2 > good").toPandas().set_index("feature")
    if " rows" not in found.index or not found.loc[" rows", "bad"]:
        return ToxicityModel({}, 1.0)
    all_toxic, all_clean = (int(x) for x in found.loc[" rows", ["bad", "good"]])
    found = found.drop(index=" rows").sort_index()
    odds = cautious_log_odds(found["bad"].to_numpy(float), found["good"].to_numpy(float), all_toxic, all_clean)
    weights = {f: float(o) for f, o in zip(found.index, odds) if o > LEAST_EVIDENCE}
    unscaled = ToxicityModel(weights, 1.0)
    seen = only(sample, "text", "toxic").mapInArrow(evidence, "score double, toxic int").groupBy(F.expr("round(score, 3)").alias("s")).agg(
        F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("all")
    ).toPandas().sort_values("s", ascending=False)
    seen = seen[seen["s"] > 0]
    if not len(seen):
        return ToxicityModel(weights, 1.0)
    caught, flagged = seen["bad"].cumsum().to_numpy(float), seen["all"].cumsum().to_numpy(float)
    f1 = 2 * caught / (flagged + all_toxic)
    best = int(np.argmax(f1))
    s = seen["s"].to_numpy()
    cut = (s[best] + (s[best + 1] if best + 1 < len(s) else 0.0)) / 2
    cut = min(max(cut, 1e-3), 1 - 1e-3)
    return ToxicityModel(weights, cut / (1 - cut))


def score_texts(docs: DataFrame, model: ToxicityModel, box, id_column: str = "doc_id", text_column: str = "text", restored: bool = False) -> DataFrame:
    """``id_column`` and ``score`` of every document, and on demand the ``restored`` text."""
    weights = shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, scorer = Restorer(opened(box)), opened(weights)
        for batch in batches:
            texts = texts_of(batch, text_column)
            columns = [batch.column(id_column), pa.array([scorer.score(restorer.words(t)) for t in texts], pa.float64())]
            if restored:
                columns.append(pa.array([restorer.restored(t) for t in texts], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[id_column, "score", "restored"][: len(columns)])

    kind = docs.schema[id_column].dataType.simpleString()
    return only(docs, id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, score double" + ", restored string" * restored)


def learned(docs: DataFrame, labels: DataFrame):
    """The model and the shared lattice, from all texts of ``docs`` and the labels of the learning folds."""
    box = shared(docs.sparkSession, corpus_lattice(docs))
    known = only(labels, "doc_id", "toxic").filter("toxic is not null").filter(~held_out("doc_id"))
    return train(labelled_sample(docs, known, LEARNING_ROWS, "text"), box), box


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four folds of five."""
    docs = table(spark, sf_dir, "documents")
    model, box = learned(docs, table(spark, sf_dir, "labels"))
    found = score_texts(docs, model, box)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", F.expr("if(score >= 0.5, 1, 0)").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose score is 0.5 or more; rows and columns are otherwise as they were."""
    model, box = learned(docs, labels)
    weights = shared(docs.sparkSession, model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, scorer = Restorer(opened(box)), opened(weights)
        for batch in batches:
            keep = [scorer.score(restorer.words(t or "")) < 0.5 for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
