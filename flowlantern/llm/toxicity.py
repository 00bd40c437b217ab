"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence is toxic with probability sigmoid(bias + sum of the weights of its
distinct words) if it holds a word of the lexicon, else never; a document is toxic if any sentence is (noisy-or) or by
a small leak. Only documents carry labels: lexicon weights, bias and leak are fitted to the likelihood of the document
labels, and the sentence probabilities then say where the toxic part is.

Defined cases: a NULL or empty text has no sentences and scores the leak. Rows with several labels count as toxic if
one label says so; labels other than 0 and 1 are not learned from. Equal texts are learned from once. Without any
label of either class the lexicon is empty and the leak is the share of toxic documents (0 without labels).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlantern.llm.common import stored

WORD = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"[^.!?\n]+")
RESULT = "score double, spans array<struct<start: int, end: int, score: double>>"


@dataclass
class NoisyOr:
    """Lexicon weights; ``leak`` is the chance of a toxic document without a toxic sentence."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    leak: float = 0.0

    def sentences(self, text: str | None) -> list[tuple[int, int, float]]:
        """(start, end, probability) of the sentences that hold a word of the lexicon."""
        lowered = (text or "").lower()
        if self.weights.keys().isdisjoint(WORD.findall(lowered)):
            return []
        # a few letters change length in lower case; offsets are those of the text itself
        body = lowered if len(lowered) == len(text) else "".join(c.lower()[:1] for c in text)
        found = []
        for part in SENTENCE.finditer(body):
            words = self.weights.keys() & WORD.findall(part.group())
            if words:
                z = self.bias + sum(self.weights[w] for w in words)
                found.append((*part.span(), float(1 / (1 + np.exp(-np.clip(z, -30, 30))))))
        return found

    def score(self, sentences: list[tuple[int, int, float]]) -> float:
        clean = 1 - self.leak
        for _, _, p in sentences:
            clean *= 1 - p
        return 1 - clean


MIN_DOCS = 5
MAX_WORDS = 2000
MIN_GAIN = 5


def _select(docs: list[list[set[str]]], y: np.ndarray) -> list[str]:
    """Words of at least MIN_DOCS documents with the largest likelihood ratio for a toxic document."""
    total, toxic = Counter(), Counter()
    for bag, label in zip(docs, y, strict=True):
        words = set().union(*bag)
        total.update(words)
        if label:
            toxic.update(words)
    words = [w for w, n in total.items() if n >= MIN_DOCS]
    if not words or not y.any() or y.all():
        return []
    n, k = np.array([total[w] for w in words], float), np.array([toxic[w] for w in words], float)
    rate = (k + 0.5) / (n + 1)
    base = y.mean()
    gain = np.where(rate > base, n * (rate * np.log(rate / base) + (1 - rate) * np.log((1 - rate) / (1 - base))), 0)
    order = np.lexsort((words, -gain))[:MAX_WORDS]
    return sorted(words[i] for i in order if gain[i] > MIN_GAIN)


def bags(text: str) -> list[set[str]]:
    """The words of each sentence."""
    return [set(WORD.findall(s)) for s in SENTENCE.findall(text.lower())]


def fit(texts: list[str], labels: list[int], weight: list[float]) -> NoisyOr:
    """``learn`` for a few texts at hand."""
    docs = [bags(t) for t in texts]
    words = _select(docs, np.array(labels, float))
    index = {w: i for i, w in enumerate(words)}
    held = [(d, s, index[w]) for d, bag in enumerate(docs) for s, sentence in enumerate(bag) for w in sentence if w in index]
    return learn(words, np.array(held, int).reshape(-1, 3), labels, weight)


def learn(words: list[str], held: np.ndarray, labels: list[int], weight: list[float], penalty: float = 0.001, steps: int = 600) -> NoisyOr:
    """Maximum likelihood under an L1 penalty on the word weights, by proximal gradient steps scaled by the recent
    size of each slope. The bias stays: a sentence is taken as clean until its words say otherwise. ``held`` has
    the number of the document, of the sentence in it and of the word for each word of the lexicon in a sentence; ``weight``
    is the number of documents of the population a sampled one stands for. The penalty counts in toxic documents, so a
    word has to explain about that share of them: words of a single family of copies stay out."""
    y, mass = np.array(labels, float), np.array(weight, float)
    share = float((y * mass).sum() / mass.sum()) if len(y) else 0.0
    if not words:
        return NoisyOr(leak=min(share, 0.45))
    held = held[np.lexsort(held.T[::-1])]
    sentences, rows = np.unique(held[:, :2], axis=0, return_inverse=True)
    rows, cols, owner = rows.ravel(), held[:, 2], sentences[:, 0]
    w, bias, leak = np.zeros(len(words)), NoisyOr.bias, np.log(0.02 / 0.98)
    second = np.zeros(len(words) + 1)
    cost = max(0.4, penalty * float((y * mass).sum()))
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(rows, w[cols], len(owner)), -30, 30)))
        low = 1 / (1 + np.exp(-leak))
        clean = np.log1p(-low) + np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y))
        toxic = np.maximum(-np.expm1(clean), 1e-9)
        push = mass * np.where(y > 0, -np.exp(clean) / toxic, 1.0)  # times p: slope of the loss in a sentence's z
        slope = push[owner] * p
        grad = np.r_[np.bincount(cols, slope[rows], len(words)), (push * low).sum()]
        second = 0.95 * second + 0.05 * grad**2
        size = 0.2 / (np.sqrt(second / (1 - 0.95**step)) + 1.0)
        w = w - size[:-1] * grad[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - size[:-1] * cost, 0)
        leak = min(leak - size[-1] * grad[-1], -0.2)
    kept = {x: float(v) for x, v in zip(words, w, strict=True) if abs(v) > 1e-3}
    return NoisyOr(kept, bias, float(1 / (1 + np.exp(-leak))))


def _chosen(rows: DataFrame, base: float) -> list[str]:
    """``_select`` over distributed texts (text, toxic): only the words that are taken reach the driver."""

    def distinct(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for text, toxic in zip(part["text"], part["toxic"], strict=True):
                yield pd.DataFrame({"word": sorted(set(WORD.findall(text.lower()))), "toxic": toxic})

    counts = rows.mapInPandas(distinct, "word string, toxic int").groupBy("word")
    counts = counts.agg(F.count("*").alias("n"), F.sum("toxic").alias("k")).where(F.col("n") >= MIN_DOCS)
    rate = (F.col("k") + 0.5) / (F.col("n") + 1)
    gain = F.col("n") * (rate * F.log(rate / base) + (1 - rate) * F.log((1 - rate) / (1 - base)))
    leading = counts.where(rate > base).select("word", gain.alias("gain")).where(F.col("gain") > MIN_GAIN)
    return sorted(r.word for r in leading.orderBy(F.desc("gain"), "word").limit(MAX_WORDS).collect())


def _held(rows: DataFrame, number: dict[str, int], words: list[str]) -> np.ndarray:
    """Numbers of document, sentence and word for the ``words`` in the sentences of ``rows`` (key, text)."""
    shared = rows.sparkSession.sparkContext.broadcast((number, {w: i for i, w in enumerate(words)}))

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs, index = shared.value
        for part in parts:
            for key, text in zip(part["key"], part["text"], strict=True):
                found = [(docs[key], s, index[w]) for s, bag in enumerate(bags(text)) for w in index.keys() & bag]
                yield pd.DataFrame(found, columns=["doc", "sentence", "word"], dtype="int32")

    found = rows.select("key", "text").mapInPandas(find, "doc int, sentence int, word int").toPandas()
    return found.to_numpy(int).reshape(-1, 3)


def train(
    docs: DataFrame,
    labels: DataFrame,
    eligible: Column | None = None,
    max_toxic: int = 2000,
    max_clean: int = 4000,
    max_chars: int = 50_000,
) -> NoisyOr:
    """Fits a model to ``labels`` (doc_id, toxic) for ``docs`` (doc_id, text).

    The sample is bounded: the first ``max_toxic`` toxic and ``max_clean`` clean labels in the order of a hash of the
    id, without texts of over ``max_chars`` characters. Its texts stay on the executors; the driver gets the words of
    the lexicon and where they stand, as numbers. ``eligible`` is a condition on doc_id.
    """
    wanted = F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)
    marks = labels.where(wanted if eligible is None else wanted & eligible)
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r.toxic: r.n for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bounds = {1: max_toxic, 0: max_clean}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [marks.where(F.col("toxic") == k).orderBy(*order).limit(n) for k, n in bounds.items()]
    sample = docs.select("doc_id", "text").join(F.broadcast(parts[0].union(parts[1])), "doc_id")  # ids: see the bounds
    sample = sample.where(F.length("text").between(1, max_chars))
    sample = stored(sample.groupBy("text").agg(F.max("toxic").alias("toxic")).withColumn("key", F.sha2("text", 256)), "labelled")
    rows = sample.select("key", "toxic").orderBy("key").collect()
    y = [r.toxic for r in rows]
    stands = {k: max(counts.get(k, 0) / bounds[k], 1.0) for k in bounds}
    words = _chosen(sample, sum(y) / len(y)) if 0 < sum(y) < len(y) else []
    held = _held(sample, {r.key: i for i, r in enumerate(rows)}, words) if words else np.zeros((0, 3), int)
    return learn(words, held, y, [stands[k] for k in y])


def scored(text: str, model: NoisyOr, spark) -> Column:
    """A struct column with the document's score and its suspicious sentences, by position in the text."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def apply(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        judge = shared.value
        for part in parts:
            spans = [judge.sentences(t) for t in part]
            keys = ("start", "end", "score")
            yield pd.DataFrame(
                {
                    "score": [judge.score(s) for s in spans],
                    "spans": [[dict(zip(keys, x, strict=True)) for x in s] for s in spans],
                }
            )

    return apply(F.col(text))
