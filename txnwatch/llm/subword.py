"""Quality by supervised subword embeddings.

A document is the mean of learned vectors of its hashed words and byte runs, and of
one shared bucket for words that repeat the word before; a softmax over it gives the
label. Vectors and softmax are trained by stochastic gradient descent in numpy on all
labelled rows, in shards whose changes are averaged. As all is linear up to the
softmax, scoring adds up one number per bucket.

Cases: null and empty texts have no feature and get the score of the prior; without
labels of both kinds the prior is all there is (one half if there are none); repeated
rows get the same score; an empty table gives no rows. Other columns, whatever their
names, pass by and are never inputs.
"""

import copy
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from txnwatch.llm.common import few_rows_at_a_time
from txnwatch.llm.labelled import in_shards, label_counts, mixed, remainder, sample
from txnwatch.llm.words import STRETCH, Runs, runs_where, stretches

#: Passes over every row, however many shards there are; changes of several shards are averaged after each.
EPOCHS, SEED = 5, 3
BUCKETS, WIDTHS, DIMENSION = 1 << 17, (3, 4), 12
#: Bucket of a word that repeats the one before.
REPEAT = 0


def features(text: str):
    """Buckets of a whole text, repeats included, a stretch at a time."""
    for data, size in stretches(text.encode()):
        runs = Runs(data)
        starts, ends = runs_where(data[:size] > 32)
        found = runs.hashes(starts, ends)
        same = np.count_nonzero(found[1:] == found[:-1])
        yield np.full(same, REPEAT)
        yield (found % np.uint64(BUCKETS - 1)).astype(np.int64) + 1
        for width in WIDTHS:
            places = np.arange(min(size, len(data) - width + 1)) if len(data) >= width else np.zeros(0, np.int64)
            yield (runs.hashes(places, places + width) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1


@dataclass
class QualityModel:
    """One number per bucket, the softmax of the two labels folded in, and the bias."""

    weights: np.ndarray
    bias: float

    def logit(self, text: str) -> float:
        total = n = 0
        for buckets in features(text):
            total += float(self.weights[buckets].sum(dtype=np.float64))
            n += len(buckets)
        return self.bias + total / n if n else self.bias

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip([self.logit(text) for text in texts], -30, 30)))


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text and how often it has them."""
    if len(text) < STRETCH:
        buckets, counts = np.unique(np.concatenate([np.zeros(0, np.int64), *features(text)]), return_counts=True)
    else:
        totals = np.zeros(BUCKETS, np.int64)
        for part in features(text):
            totals += np.bincount(part, minlength=BUCKETS)
        buckets, counts = np.flatnonzero(totals), totals[totals > 0]
    return buckets.astype(np.int32), counts.astype(np.float32)


def descend(weights: list[np.ndarray], examples: list[tuple[tuple[np.ndarray, np.ndarray], int]], rng: np.random.Generator, epochs: int, first: int, last: int, rate: float = 4.0) -> None:
    """Stochastic gradient descent over ((buckets, counts), label), in place: ``epochs`` from the ``first`` on, of ``last`` in all."""
    vectors, output, bias = weights
    steps, done = last * len(examples), first * len(examples)
    for _ in range(epochs):
        for at in rng.permutation(len(examples)):
            (buckets, counts), label = examples[at]
            if not len(buckets):
                continue
            pace = rate * (1 - done / steps)
            done += 1
            share = counts / counts.sum()
            hidden = share @ vectors[buckets]
            odds = output @ hidden + bias
            chance = np.exp(odds - odds.max())
            error = chance / chance.sum()
            error[label] -= 1
            back = (error @ output).astype(np.float32)
            output -= (pace / rate * 0.5 * np.outer(error, hidden)).astype(np.float32)
            bias -= pace / rate * 0.05 * error
            vectors[buckets] -= np.outer(share * pace, back)


def learn(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_label: tuple[int, int] | None = None) -> QualityModel:
    """A model of ``label`` from all labels that ``allowed``, a condition on the id, lets through; ``per_label`` asks for a sample of so many rows of either."""
    clean, counts = label_counts(labels, label, allowed)
    prior = math.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1))
    docs = docs.filter(allowed).select("doc_id", "text")
    table, n_shards, kinds = in_shards(sample(docs, clean, per_label).drop("label") if per_label else docs, clean)
    if len(kinds) < 2:
        return QualityModel(np.zeros(BUCKETS, np.float32), prior if counts else 0.0)
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSION)).astype(np.float32) / DIMENSION
    output = np.zeros((2, DIMENSION), np.float32)
    output[1] = rng.standard_normal(DIMENSION) / 4
    weights, rounds = [vectors, output, np.zeros(2)], 1 if n_shards == 1 else EPOCHS
    for number in range(rounds):
        def step(weights_: list[np.ndarray], examples: list, shard: int, number: int = number) -> None:
            if n_shards == 1:
                descend(weights_, examples, copy.deepcopy(rng), EPOCHS, 0, EPOCHS)
            else:
                descend(weights_, examples, np.random.default_rng([SEED, number, shard]), 1, number, rounds)

        weights = mixed(table, weights, counted, step, np.float64 if n_shards == 1 else np.float32)
    vectors, output, bias = weights
    # the odds among the rows are in the bias already; those among all labels take their place
    return QualityModel(vectors @ (output[1] - output[0]), float(bias[1] - bias[0]) + prior - math.log(kinds[1] / kinds[0]))


def score(text: str | Column, model) -> Column:
    """Score of each whole text by a model that has ``scores``; rows stay where they are."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores([text or "" for text in texts]))

    return scored(F.col(text) if isinstance(text, str) else text)


def quality(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (3, 1)) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; rows whose remainder is ``held_out[1]`` are not learned from."""
    modulus, rest = held_out
    model = learn(docs, labels, "quality", remainder("doc_id", modulus) != rest)
    return predictions(docs, model, F.coalesce(remainder("doc_id", modulus) == rest, F.lit(False)))


def predictions(docs: DataFrame, model, held_out: Column) -> DataFrame:
    rows = few_rows_at_a_time(docs).select("doc_id", held_out.alias("held_out"), score("text", model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
