"""Mixing documents to target weights of domains that they belong to only in part.

1. A naive Bayes classifier over hashed words, learned from a table of labelled rows, gives every
   document posterior probabilities p over the domains. Evidence counts as of ``EVIDENCE_WORDS`` words
   at most, so long texts keep soft memberships.
2. Rates r minimise  sum_k (S_k - T_k)^2 / (2 T_k B) + (damping / 2) sum_d n_d (r_d - 1)^2 / N  over r >= ``least``,
   where S_k = sum_d r_d n_d p_dk are the expected tokens of a domain, T_k its target, B the budget and n_d the
   tokens of a document, by accelerated projected gradient steps. A step needs the K sums S and the size of the
   projected gradient: one aggregation over a compact table (id, tokens, p, rate) per step. Rates between two
   steps are a column expression of the gradients so far, and are written out every few steps. Steps end when
   totals are close to their targets, or when the projected gradient is small (where targets cannot be met, or
   classes are told apart too weakly to meet them). `domain_gaps` says how far totals are from their targets.
3. A document is taken floor(r + u) times with u uniform from a hash of its id, so that expected
   totals stay as fitted.

DataFrame functions only. Defined results: null texts count as empty; a document without words has
the prior as posterior and no tokens; rows with null domain teach nothing; without labelled rows or
tokens all rates are 1; rows that repeat id and text are one document; further columns are passed over;
a domain without tokens has the target 0 and no gap.
"""

from __future__ import annotations

import logging
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.llm.common import labelled_sample, only, stored, table

LOG = logging.getLogger(__name__)

#: Hash buckets of words; classifier tables have so many entries a domain.
BUCKETS = 4_096
#: Labelled rows that the classifier learns from, about; chosen by a hash of the id.
LEARNING_ROWS = 20_000
#: Words whose evidence a document has at most.
EVIDENCE_WORDS = 30.0
#: Weight of staying near rate 1.
DAMPING = 1e-4
#: Most gradient steps (a warning says if they run out), and steps between written rates.
STEPS, WRITTEN_EVERY = 256, 8
#: The relative gap of totals at which to stop, and the projected gradient (root mean square over tokens) at which they stay.
CLOSE, STILL = 2e-3, 1e-4
#: Target weights are the corpus' own shares to this power.
FLATTENING = 0.7


def _words(rows: DataFrame) -> DataFrame:
    """One row per word with its hash bucket; a row without words has one of ``word`` 0."""
    exploded = rows.withColumn("w", F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s")))
    return exploded.select(
        *[c for c in rows.columns if c != "text"], (F.col("w") != "").cast("int").alias("word"), F.pmod(F.xxhash64("w"), F.lit(BUCKETS)).cast("int").alias("bucket")
    )


def word_weights(labelled: DataFrame) -> tuple[list[str], list[float], list[list[float]]]:
    """Domains, log priors and log probabilities by domain and bucket, from rows of ``text`` and ``domain``."""
    rows = labelled.filter("domain is not null").select(F.col("domain").cast("string").alias("domain"), "text")
    docs = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(docs)
    counts = {n: [0.5] * BUCKETS for n in names}
    for r in _words(rows).filter("word = 1").groupBy("domain", "bucket").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["domain"]][r["bucket"]] += r["n"]
    totals = {n: sum(counts[n]) for n in names}
    priors = [math.log(docs[n] / sum(docs.values())) for n in names]
    return names, priors, [[math.log(c / totals[n]) for c in counts[n]] for n in names]


def _constant(values: list[float]) -> Column:
    """Numbers as one constant of the plan; thousands of literals would weigh on the driver."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def memberships(docs: DataFrame, priors: list[float], weights: list[list[float]]) -> DataFrame:
    """``id``, ``mark`` (hash of the text), ``tokens`` (words) and posterior ``p`` of every document."""
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"), "text")
    likelihood = [
        F.sum(F.when(F.col("word") == 1, F.get(_constant(w), F.col("bucket")))).alias(f"l{k}") for k, w in enumerate(weights)
    ]
    # Rows that repeat id and text add up to one document of so many times the words; `copies` takes that back.
    per_doc = _words(rows.withColumn("first", F.lit(1))).groupBy("id", "mark").agg(F.sum("word").alias("tokens"), *likelihood)
    scale = F.least(F.lit(1.0), F.lit(EVIDENCE_WORDS) / F.greatest("tokens", F.lit(1)))
    logits = F.array(*[F.lit(b) + F.coalesce(F.col(f"l{k}"), F.lit(0.0)) * scale for k, b in enumerate(priors)])
    shifted = F.transform("logits", lambda x: F.exp(x - F.array_max("logits")))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return (
        per_doc.select("id", "mark", "tokens", logits.alias("logits"))
        .select("id", "mark", "tokens", shifted.alias("e"))
        .select("id", "mark", "tokens", F.transform("e", lambda x: x / total).alias("p"))
    )


def _dot(gradient: list[float]) -> Column:
    return sum((F.col("p")[k] * F.lit(g) for k, g in enumerate(gradient)), F.lit(0.0))


def fit_rates(members: DataFrame, targets: list[float], least: float = 0.0, damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """``members`` (``id``, ``mark``, ``tokens``, ``p``) with the fitted ``rate``, as a written table.

    ``targets`` are the wished token totals of the domains.
    """
    k_all = range(len(targets))
    budget = sum(targets)
    start = F.lit(max(1.0, least))
    state = stored(members.withColumns({"rate": start, "before": start, "moved": F.lit(0.0)}))
    moves = F.sum(F.col("tokens") * F.col("moved") * F.col("moved")).alias("moved")

    def totals(df: DataFrame) -> tuple[list[float], float]:
        row = df.agg(*_sums(len(targets)), moves).first()
        return [row[f"s{k}"] or 0.0 for k in k_all], row["moved"] or 0.0

    now, _ = totals(state)
    everything = sum(now) / max(1.0, least)
    if not budget or not everything:
        return state.drop("before", "moved")

    def distance(sums: list[float]) -> float:
        return sum((s - t) ** 2 / t for s, t in zip(sums, targets) if t > 0)

    # In the metric of token shares no eigenvalue of the fit exceeds the largest row sum of its matrix, since memberships add up to 1.
    steepest = max(everything * s / max(1.0, least) / (budget * t) for s, t in zip(now, targets) if t > 0)
    rate_step = 1.0 / (steepest + damping)
    current, last, pace = state, now, 1.0
    for step in range(1, steps + 1):
        if max(abs(s - t) / t for s, t in zip(now, targets) if t > 0) < CLOSE:
            break
        # Rates go on by part of their last move before the gradient is taken, the longer the more.
        longer = (1.0 + math.sqrt(1.0 + 4.0 * pace * pace)) / 2.0
        momentum, pace = round((pace - 1.0) / longer, 12), longer
        # Totals are linear in the rates, so those of the rates gone on by the momentum need no pass of their own.
        ahead = [s + momentum * (s - b) for s, b in zip(now, last)]
        # d/dr_d of the fit, per token and in units of 1/N; rounded so that a retried sum gives the same steps
        gradient = [round((s - t) / t * everything / budget, 12) if t > 0 else 0.0 for s, t in zip(ahead, targets)]
        went_on = current.withColumn("ahead", F.col("rate") + F.lit(momentum) * (F.col("rate") - F.col("before")))
        lower = F.col("ahead") - F.lit(rate_step) * (_dot(gradient) + F.lit(damping) * (F.col("ahead") - 1.0))
        fitted = went_on.select(*members.columns, F.greatest(F.lit(float(least)), lower).alias("rate"), F.col("rate").alias("before"), "ahead")
        current = fitted.withColumn("moved", F.col("rate") - F.col("ahead")).drop("ahead")
        if step % WRITTEN_EVERY == 0:
            current = stored(current)
        last, (now, move) = now, totals(current)
        if distance(now) > distance(last):  # the momentum carried too far
            pace = 1.0
        if math.sqrt(move / everything) / rate_step < STILL:
            break
    else:
        LOG.warning("mixing: %d steps did not reach the targets; see domain_gaps", steps)
    return stored(current.drop("before", "moved"))


def _sums(domains: int) -> list[Column]:
    """Expected token totals by domain."""
    return [F.sum(F.col("rate") * F.col("tokens") * F.col("p")[k]).alias(f"s{k}") for k in range(domains)]


def domain_gaps(rated: DataFrame, targets: list[float]) -> list[float | None]:
    """By how much of its target each domain's expected total misses it; None where the target is 0."""
    row = rated.agg(*_sums(len(targets))).first()
    return [((row[f"s{k}"] or 0.0) - t) / t if t > 0 else None for k, t in enumerate(targets)]


def flattened_targets(shares: list[float], power: float, every_document: bool) -> list[float]:
    """Token totals proportional to ``shares`` to the given power.

    The budget is the sum of ``shares``, or with ``every_document`` so large that no domain has to shrink.
    """
    weights = [s**power if s > 0 else 0.0 for s in shares]
    whole = sum(weights) or 1.0
    budget = sum(shares)
    targets = [w / whole * budget for w in weights]
    if every_document:
        grow = max((s / t for s, t in zip(shares, targets) if t > 0), default=1.0)
        targets = [t * grow for t in targets]
    return targets


def mix(docs: DataFrame, labelled: DataFrame, power: float = FLATTENING, every_document: bool = False) -> tuple[list[str], list[float], DataFrame]:
    """Domains, target totals, and ``id``, ``mark``, ``tokens``, ``p``, ``rate``, ``copies`` of every document.

    ``labelled`` has ``text`` and ``domain``. ``every_document`` keeps all rates at 1 or more.
    """
    names, priors, weights = word_weights(labelled)
    if not names:
        names, priors, weights = ["all"], [0.0], [[0.0] * BUCKETS]
    members = stored(memberships(docs, priors, weights))
    row = members.agg(*[F.sum(F.col("tokens") * F.col("p")[k]).alias(f"s{k}") for k in range(len(names))]).first()
    shares = [row[f"s{k}"] or 0.0 for k in range(len(names))]
    targets = flattened_targets(shares, power, every_document)
    rated = fit_rates(members, targets, least=1.0 if every_document else 0.0)
    uniform = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(10)), F.lit(1 << 30)) / float(1 << 30)
    return names, targets, rated.withColumn("copies", F.floor(F.col("rate") + uniform).cast("int"))


def by_language_and_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A sample of labelled rows whose domain is the language with the quality label."""
    rows = labelled_sample(docs, only(labels, "doc_id", "quality").filter("quality is not null"), LEARNING_ROWS, "text", "lang")
    return rows.filter("lang is not null").select("text", F.concat_ws("/", "lang", F.when(F.col("quality") > 0, "high").otherwise("low")).alias("domain"))


def mixed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with every row repeated as often as the mixture asks, at least once."""
    _, _, rated = mix(docs, by_language_and_quality(docs, labels), every_document=True)
    copies = rated.select(F.col("id").alias("_id"), F.col("mark").alias("_rated_mark"), "copies")
    joined = docs.withColumn("_mark", F.xxhash64("text")).join(
        copies, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_rated_mark"))
    )
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*docs.columns)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain, its gap to the target, expected share, rate and copies of every document, under a budget of the corpus' own size."""
    docs = table(spark, sf_dir, "documents")
    names, targets, rated = mix(docs, by_language_and_quality(docs, table(spark, sf_dir, "labels")))
    domain = F.array(*[F.lit(n) for n in names])
    gaps = F.array(*[F.lit(g).cast("double") for g in domain_gaps(rated, targets)])
    top = F.array_max("p")
    at = F.array_position("p", top).cast("int") - 1
    return rated.select(
        F.col("id").alias("doc_id"), "tokens", F.get(domain, at).alias("domain"), top.alias("posterior"), "rate", "copies", F.get(gaps, at).alias("domain_gap")
    )
