"""Toxicity by a convolutional text classifier.

Words are embedded as the sum of hashed vectors of the word and of its beginnings;
filters of several widths run over the words, each keeps its largest response in the
whole text, and a logistic output weighs these. Embedding, filters and output are
trained in numpy on all labelled rows, in shards whose changes are averaged. Filters
are linear in the words, so scoring looks up one row per hash. The threshold is set for each language on rows kept from
training; the language is told from the bytes of the text, and the score is moved so
that the threshold lies at one half.

Cases: null texts and texts without words respond nowhere and get the score of the
bias; without labels of both kinds the score is the prior (one half if there are no
labels); repeated rows get the same score; an empty table gives no rows. Labels,
language, source and id columns are never inputs of a score.
"""

import copy
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from txnwatch.llm.common import map_batches, slices, texts_of
from txnwatch.llm.labelled import BLOCK, best_cuts, in_shards, label_counts, mixed, remainder, sample, summed, sums_of
from txnwatch.llm.subword import predictions
from txnwatch.llm.words import Runs, runs_where, stretches

BUCKETS, DIMENSION, FILTERS, WIDTHS = 1 << 16, 12, 6, (1, 2, 3)
#: Bytes of a word's beginnings that have vectors of their own.
BEGINNINGS = (4, 5, 6, 7, 8)
VIEWS = 1 + len(BEGINNINGS)
#: Documents that every bucket is taken to be in besides, with labels as they are in all.
SMOOTHING = 4
#: Steps of training at least.
STEPS = 12_000
#: Passes over every row at least, however many shards there are; changes of several shards are averaged so often.
PASSES, SEED = 4, 5
#: Languages with fewer than one row in so many count as none, so there are never more than that.
COMMON = 1000
#: Buckets of byte triples by which languages are told apart; of each label, one in so many rows sets thresholds.
LANGUAGE_BUCKETS, KEPT = 1 << 10, 5

_IS_WORD = np.array([chr(i).isalnum() or i >= 128 for i in range(128)] + [True] * 128)


def word_buckets(text: str) -> np.ndarray:
    """A row of buckets for each word of a whole text: of the word, then of its beginnings."""
    rows = []
    for data, size in stretches(text.encode().lower()):
        starts, ends = runs_where(_IS_WORD[data[:size]])
        runs = Runs(data[:size])
        views = [runs.hashes(starts, ends)] + [
            runs.hashes(starts, np.minimum(ends, starts + n)) + np.uint64(n) for n in BEGINNINGS]
        rows.append((np.stack(views, axis=1) % np.uint64(BUCKETS)).astype(np.int32))
    return np.concatenate(rows) if rows else np.zeros((0, VIEWS), np.int32)


def language_vector(text: str) -> np.ndarray:
    """Roots of the shares of hashed byte triples."""
    counts = np.zeros(LANGUAGE_BUCKETS)
    for data, size in stretches(text.encode().lower()):
        part = data[: size + 2].astype(np.uint32)
        if len(part) > 2:
            mixed = part[:-2] * np.uint32(0x9E3779B1) + part[1:-1] * np.uint32(0x85EBCA77) + part[2:] * np.uint32(0xC2B2AE3D)
            counts += np.bincount(mixed >> np.uint32(22), minlength=LANGUAGE_BUCKETS)
    return np.sqrt(counts / max(1, counts.sum()))


@dataclass
class ToxicityModel:
    """Responses of every bucket to every filter tap, biases, output, and thresholds by language."""

    taps: np.ndarray  # bucket, tap of a filter (widths one after the other), filter
    bias: np.ndarray  # width, filter
    output: np.ndarray
    constant: float
    centres: np.ndarray = field(default_factory=lambda: np.zeros((1, LANGUAGE_BUCKETS)))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def pooled(self, words: np.ndarray) -> np.ndarray:
        best = np.zeros((len(WIDTHS), FILTERS), np.float32)
        for start in range(0, max(1, len(words)), 1 << 15):
            part = words[start: start + (1 << 15) + max(WIDTHS) - 1]
            taps = self.taps[part[:, 0]]
            for view in range(1, VIEWS):
                taps += self.taps[part[:, view]]
            at = 0
            for i, width in enumerate(WIDTHS):
                n = len(part) - width + 1
                if n > 0:
                    response = taps[:n, at].copy()
                    for tap in range(1, width):
                        response += taps[tap: tap + n, at + tap]
                    best[i] = np.maximum(best[i], response.max(axis=0) + self.bias[i])
                at += width
        return best.ravel()

    def logit(self, text: str) -> float:
        return float(self.pooled(word_buckets(text)) @ self.output) + self.constant

    def language(self, text: str) -> int:
        return int(np.argmax(self.centres @ language_vector(text))) if len(self.centres) > 1 else 0

    def scores(self, texts: list[str]) -> np.ndarray:
        moved = [self.logit(text) - self.thresholds[self.language(text)] for text in texts]
        return 1 / (1 + np.exp(-np.clip(moved, -30, 30)))


def start(odds: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
    """Vectors of buckets, filters, biases, output and constant before training.

    The first dimension of the embedding begins as the log odds of the label in
    documents that hold the bucket, and all filters begin by looking at it.
    """
    n_taps = sum(WIDTHS)
    vectors = (rng.standard_normal((BUCKETS, DIMENSION)) * 0.05).astype(np.float32)
    vectors[:, 0] = odds
    filters = (rng.standard_normal((DIMENSION, n_taps, FILTERS)) * 0.2).astype(np.float32)
    filters[0] = 0.5 / np.repeat(WIDTHS, WIDTHS)[:, None]
    bias, output = np.full((len(WIDTHS), FILTERS), -1, np.float32), np.full((len(WIDTHS), FILTERS), 0.3, np.float32)
    output *= rng.uniform(0.5, 1.5, output.shape).astype(np.float32)
    return [vectors, filters, bias, output, np.array([-1.0])]


def responses(words: np.ndarray, vectors: np.ndarray, filters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest response of each filter in a whole text, and at which word; so many words at a time that memory stays bounded."""
    best, where = np.full((len(WIDTHS), FILTERS), -np.inf, np.float32), np.zeros((len(WIDTHS), FILTERS), np.int64)
    for begin in range(0, len(words), 1 << 15):
        taps = np.tensordot(vectors[words[begin: begin + (1 << 15) + max(WIDTHS) - 1]].sum(axis=1), filters, 1)
        tap0 = 0
        for i, width in enumerate(WIDTHS):
            n = len(taps) - width + 1
            if n > 0:
                response = sum(taps[tap: tap + n, tap0 + tap] for tap in range(width))
                at = response.argmax(axis=0)
                value = response[at, np.arange(FILTERS)]
                where[i] = np.where(value > best[i], begin + at, where[i])
                best[i] = np.maximum(best[i], value)
            tap0 += width
    return best, where


def descend(weights: list[np.ndarray], examples: list[tuple[np.ndarray, int]], rng: np.random.Generator, epochs: int, first: int, last: int, rate: float = 0.02) -> None:
    """Stochastic gradient descent over (word buckets, label), in place: ``epochs`` from the ``first`` on, of ``last`` in all.

    Only the words under a filter's largest response learn.
    """
    vectors, filters, bias, output, constant = weights
    steps, done = last * len(examples), first * len(examples)
    for _ in range(epochs):
        for at in rng.permutation(len(examples)):
            words, label = examples[at]
            pace = rate * (1 - done / steps) + 1e-3
            done += 1
            if not len(words):
                continue
            largest, where = responses(words, vectors, filters)
            best = np.maximum(0, largest + bias)
            error = 1 / (1 + math.exp(-max(-30, min(30, float((best * output).sum()) + float(constant[0]))))) - label
            back = np.where(best > 0, error * output, 0)
            output -= pace * error * best
            constant -= pace * error
            bias -= pace * back
            taps = [(i, tap, live) for i, width in enumerate(WIDTHS) if len(live := np.flatnonzero(back[i])) for tap in range(width)]
            under = [words[where[i, live] + tap] for i, tap, live in taps]
            embedded = [vectors[rows].sum(axis=1) for rows in under]
            for (i, tap, live), rows, values in zip(taps, under, embedded):
                slope, at_tap = back[i, live], sum(WIDTHS[:i]) + tap
                moved = filters[:, at_tap, live] * slope
                filters[:, at_tap, live] -= pace * values.T * slope
                np.subtract.at(vectors, rows.ravel(), np.repeat(pace * moved.T, VIEWS, axis=0))


def log_odds(held: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Per bucket, the smoothed log odds of label 1 among the documents that hold it, against all documents; both are counted by label."""
    share = totals / totals.sum()
    return np.log((held[1] + SMOOTHING * share[1]) / (held[0] + SMOOTHING * share[0])) - np.log(share[1] / share[0])


def best_threshold(logits: np.ndarray, labels: np.ndarray, weight: float) -> float:
    """Middle of the cut with the fewest errors, label 1 counting ``weight``; the widest such gap. What ``best_cuts`` finds for tables."""
    order = np.argsort(logits)
    logits, labels = logits[order], labels[order]
    missed = np.concatenate([[0], np.cumsum(labels * weight)])
    false = np.concatenate([np.cumsum((labels == 0)[::-1])[::-1], [0]])
    edges = np.concatenate([[logits[0] - 1], logits, [logits[-1] + 1]])
    gaps = np.diff(edges)
    errors = np.where(gaps > 0, missed + false, np.inf)
    cut = np.flatnonzero(errors == errors.min())
    cut = cut[np.argmax(gaps[cut])]
    return float(edges[cut] + gaps[cut] / 2)


def learn(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_label: tuple[int, int] | None = None) -> ToxicityModel:
    """A model of ``label`` from all labels that ``allowed``, a condition on the id, lets through; ``per_label`` asks for a sample of so many rows of either.

    One row in ``KEPT`` sets thresholds, the others are learned from.
    """
    clean, counts = label_counts(labels, label, allowed)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    docs = docs.filter(allowed).select("doc_id", "text", F.coalesce(lang, F.lit("")).alias("lang"))
    table, n_shards, kinds = in_shards(sample(docs, clean, per_label).drop("label") if per_label else docs, clean)
    n_rows = sum(kinds.values())
    if len(kinds) < 2:
        prior = math.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1)) if counts else 0.0
        return ToxicityModel(np.zeros((BUCKETS, sum(WIDTHS), FILTERS), np.float32), np.zeros((len(WIDTHS), FILTERS), np.float32), np.zeros(len(WIDTHS) * FILTERS, np.float32), prior)
    common = table.groupBy("lang").agg(F.count("*").alias("n")).filter(F.col("n") * COMMON >= n_rows)
    names = sorted({row["lang"] for row in common.collect()} | {""})
    table = table.withColumn("lang", F.when(F.col("lang").isin(names), F.col("lang")).otherwise(""))
    fitted = F.col("place") % KEPT != 0

    found = summed(table.select(fitted.alias("fitted"), "label", "text", "lang"), _profile)
    held = np.concatenate([found.get(f"held {at}", np.zeros((2, BLOCK))).reshape(2, -1) for at in range(0, BUCKETS, BLOCK)], axis=1)
    rng = np.random.default_rng(SEED)
    weights = start(log_odds(held, found["labels"]), rng)
    n_fitted = int(found["labels"].sum())
    passes = max(PASSES, -(-STEPS // n_fitted))
    rounds = 1 if n_shards == 1 else PASSES
    for number in range(rounds):
        def step(weights_: list[np.ndarray], examples: list, shard: int, number: int = number) -> None:
            if n_shards == 1:
                descend(weights_, examples, copy.deepcopy(rng), passes, 0, passes)
            else:
                done, upto = number * passes // rounds, (number + 1) * passes // rounds
                descend(weights_, examples, np.random.default_rng([SEED, number, shard]), upto - done, done, passes)

        weights = mixed(table.filter(fitted), weights, word_buckets, step, np.float64 if n_shards == 1 else np.float32)
    vectors, filters, bias, output, constant = weights
    model = ToxicityModel(np.tensordot(vectors, filters, 1).astype(np.float32), bias, output.ravel(), float(constant[0]))

    names = [name for name in names if f"lang {name}" in found]
    model.centres = np.stack([found[f"lang {name}"][1:] / found[f"lang {name}"][0] for name in names])
    model.centres /= np.maximum(1e-9, np.linalg.norm(model.centres, axis=1, keepdims=True))
    # rows of a label may be more or fewer than its documents; errors count as often as they would in these
    weight = (counts[1] / kinds[1]) / (counts[0] / kinds[0])
    cuts = best_cuts(_told(table.filter(~fitted), model), weight, 8)
    model.thresholds = np.array([cuts.get(i, cuts.get(-1, 0.0)) for i in range(len(names))])
    return model


def _profile(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over (fitted, label, text, lang): fitted documents by label, and those that hold each bucket; of all, rows and triples by language."""
    labels, held, langs = np.zeros(2), np.zeros((2, BUCKETS)), {}
    for batch in slices(batches):
        for fitted, label, text, lang in zip(*[column.to_pylist() for column in batch.columns]):
            if lang not in langs:
                langs[lang] = np.zeros(1 + LANGUAGE_BUCKETS)
            langs[lang] += np.concatenate([[1], language_vector(text or "")])
            if fitted:
                labels[label] += 1
                held[label, np.unique(word_buckets(text or ""))] += 1
    yield sums_of({"labels": labels, **{f"lang {lang}": sums for lang, sums in langs.items()}})
    for at in range(0, BUCKETS, BLOCK):
        yield sums_of({f"held {at}": held[:, at: at + BLOCK]})


def _told(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """label, logit and, as ``group``, the language that the text is told to be in; and each row once more in group -1."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def tell(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, read = texts_of(batch), shared.value
        return pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([read.logit(text) for text in texts], pa.float64()), pa.array([read.language(text) for text in texts], pa.int32()),
        ], ["label", "logit", "told"])

    told = map_batches(rows.select("label", "text"), tell, "label int, logit double, told int")
    return told.select("label", "logit", F.explode(F.array("told", F.lit(-1))).alias("group"))


def toxicity(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (5, 0)) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; rows whose remainder is ``held_out[1]`` are not learned from."""
    modulus, rest = held_out
    model = learn(docs, labels, "toxic", remainder("doc_id", modulus) != rest)
    return predictions(docs, model, F.coalesce(remainder("doc_id", modulus) == rest, F.lit(False)))
