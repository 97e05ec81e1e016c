"""Operator 6: mixing to target weights with soft domain membership.

Domains are the classes of the labelled table (quality x toxic).  A classifier with one head for each label gives every
document domain posteriors p; with n words it adds n * p to the expected totals of the domains.  Document rates r >= 0 are
fitted so that the totals sum(r * n * p) match the targets: least squares, each domain over its own expected total,
by projected gradient steps with momentum that start at r = 1 (so rates stay near 1 where the targets leave them free).  In the metric of n the
curvature of the fit is at most 1, so the step is 1 and needs no search.  A step needs one sum over a table of a few numbers a document; a
document's rate is the fold of the steps so far, so no rate is stored or shuffled between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import quality, store

#: Domains in order: low and toxic are classes of the labelled table. Shares of the mixture.
DOMAINS = ("clean", "toxic", "low", "low_toxic")
TARGET_WEIGHTS = {"clean": 0.97, "toxic": 0.01, "low": 0.015, "low_toxic": 0.005}
#: In the pipeline no domain is aimed at more than this multiple of what it has: the classifier has rejected most of the low domains before, and their asked
#: shares would repeat what is left of them hundreds of times.
STAGE_REPEATS = 1.0
HEADS, DESIGNS = ("quality", "toxic"), (quality.NGRAMS, quality.PRESENCE)
#: Largest relative gap to a target at which the fit ends.
TOLERANCE = 2e-3
#: It also ends when the squared gaps haven't shrunk by STALL in PATIENCE steps: the targets are out of reach then.
STALL, PATIENCE = 0.05, 10


def _domains(texts, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of the domains (a column each) and words of some texts."""
    p, words = quality.batch_scores(texts, weights, DESIGNS)
    good, toxic = p[:, 0], p[:, 1]
    return np.stack([good * (1 - toxic), good * toxic, (1 - good) * (1 - toxic), (1 - good) * toxic], axis=1), words


def posteriors(docs: DataFrame, labels: DataFrame, weights=None) -> DataFrame:
    """doc_id, n_tokens (words) and the posteriors p0.. of the domains, one row for each row of ``docs``. Null texts are
    empty and have the posteriors of the bias; without labels every head says one half. ``weights``: a broadcast of fitted ones."""
    weights = weights or docs.sparkSession.sparkContext.broadcast(quality.train(docs, labels, HEADS, DESIGNS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, words = _domains(b.column(1), weights.value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words), *(pa.array(x) for x in np.ascontiguousarray(p.T))], ["doc_id", "n_tokens", "p0", "p1", "p2", "p3"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, p0 double, p1 double, p2 double, p3 double")


def _rates(p: np.ndarray, steps: list[tuple[float, np.ndarray]]) -> np.ndarray:
    """Rates after the steps (momentum, gradient of the domains)."""
    r = before = np.ones(len(p))
    for momentum, g in steps:
        r, before = np.maximum(0.0, r + momentum * (r - before) - p @ g), r
    return r


def _totals(member: DataFrame, steps: list[np.ndarray]) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(DOMAINS))
        for b in batches:
            p = np.stack([b.column(1 + k).to_numpy() for k in range(len(DOMAINS))], axis=1)
            total += (_rates(p, steps) * b.column(0).to_numpy()) @ p
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], [f"s{k}" for k in range(len(DOMAINS))])

    sums = member.select("n_tokens", *(f"p{k}" for k in range(len(DOMAINS)))).mapInArrow(run, ", ".join(f"s{k} double" for k in range(len(DOMAINS))))
    row = sums.agg(*(F.sum(f"s{k}") for k in range(len(DOMAINS)))).first()
    return np.array([x or 0.0 for x in row])


def _gaps(now: np.ndarray, target: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Gaps to the targets, relative to them (to a target of 0: to the domain's own expected total); 0 for a domain without words."""
    whole = np.where(target > 0, target, base)
    return np.where(base > 0, np.abs(now - target) / np.where(whole > 0, whole, 1.0), 0.0)


def fit_rates(member: DataFrame, weights: dict[str, float] = TARGET_WEIGHTS, repeats: float | None = None) -> tuple[list[tuple[float, np.ndarray]], np.ndarray, np.ndarray, float]:
    """Steps whose fold gives the rates, the totals they reach, the targets as asked, and the largest gap between them. The budget is what leaves the domain
    of the largest weight at its own expected total; a scarce domain's documents are used more than once. With ``repeats`` no domain is aimed at more than
    that multiple of its own total; the gap is to what was asked all the same. A domain of no expected words can't be matched and is left out.
    Momentum starts anew when the fit gets worse."""
    share = np.array([weights.get(d, 0.0) for d in DOMAINS])
    base = _totals(member, [])
    lead = int(np.argmax(share))
    asked = share / share[lead] * base[lead]
    target = asked if repeats is None else np.minimum(asked, repeats * base)
    scale = np.where(base > 0, base, np.inf)
    steps, now, before, run = [], base, base, 1.0
    loss = lambda t: float((np.where(base > 0, t - target, 0.0) ** 2 / scale).sum())
    best, since = loss(now), 0
    while since < PATIENCE and _gaps(now, target, base).max() > TOLERANCE:
        longer = (1 + np.sqrt(1 + 4 * run * run)) / 2
        momentum, run = (run - 1) / longer, longer
        ahead = now + momentum * (now - before)  # totals are linear in the rates
        steps.append((momentum, (ahead - target) / scale))
        now, before = _totals(member, steps), now
        if loss(now) > loss(before):
            run = 1.0
        best, since = (loss(now), 0) if loss(now) < best * (1 - STALL) else (best, since + 1)
    return steps, now, asked, float(_gaps(now, asked, base).max())


def _shares(totals: np.ndarray) -> list[float]:
    return (totals / totals.sum() if totals.sum() else totals).tolist()


def document_rates(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = TARGET_WEIGHTS, repeats: float | None = None) -> DataFrame:
    """doc_id, n_tokens, rate, the posteriors, and, the same in all rows: target_gap (the largest relative gap that the fit leaves between a domain's expected
    total and its target; above TOLERANCE only where the targets are out of reach), asked_shares and reached_shares (of the mixture's words, by domain). One
    row for each row of ``docs``; an empty table gives no rows."""
    member = store.written(posteriors(docs, labels), "posteriors")
    steps, now, asked, gap = fit_rates(member, weights, repeats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.stack([b.column(2 + k).to_numpy() for k in range(len(DOMAINS))], axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(_rates(p, steps)), *b.columns[2:]], ["doc_id", "n_tokens", "rate", "p0", "p1", "p2", "p3"])

    shares = {n: F.array(*map(F.lit, _shares(x))) for n, x in (("asked_shares", asked), ("reached_shares", now))}
    return member.mapInArrow(run, "doc_id long, n_tokens long, rate double, p0 double, p1 double, p2 double, p3 double").withColumns({"target_gap": F.lit(gap)} | shares)


def copies(rate, doc_id) -> F.Column:
    """Whole copies of a document: its rate, rounded up or down by a hash of its id so that totals hold on average."""
    return F.floor(rate + F.pmod(F.xxhash64(doc_id), F.lit(1 << 20)) / (1 << 20)).cast("int")


def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``documents`` with a rate and whole copies. Null and empty texts have the rate of the bias' posteriors; rows of one doc_id have a rate
    each; without labels all rates are alike; an empty table gives no rows."""
    got = document_rates(store.table(spark, sf_dir, "documents"), store.table(spark, sf_dir, "labels"))
    return got.withColumn("copies", copies(F.col("rate"), F.col("doc_id")))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each row as often as its own rate says, by a fit with STAGE_REPEATS. Texts are scored a second time with the fitted weights, so that a row and its rate stay together:
    nothing is joined, and rows that share a doc_id, or have none, have a rate each. All columns stay; an empty table gives no rows."""
    labels = store.table(spark, sf_dir, "labels")
    weights = spark.sparkContext.broadcast(quality.train(docs, labels, HEADS, DESIGNS))
    steps = fit_rates(store.written(posteriors(docs, labels, weights), "posteriors"), repeats=STAGE_REPEATS)[0]
    rate = "rate"
    while rate in docs.columns:  # a name that no column has
        rate += "_"
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_rates(_domains(b.column(text), weights.value)[0], steps))], [*b.schema.names, rate])

    rated = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(rate, T.DoubleType())]))
    return rated.withColumn(rate, F.explode(F.array_repeat(F.lit(0), copies(F.col(rate), F.col("doc_id"))))).select(*docs.columns)
