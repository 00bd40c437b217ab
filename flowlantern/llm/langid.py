"""Language identification, word first with n-gram backoff.

A word of the text that some language's word list holds is scored by its log frequency in every language. A word that
none holds is scored by its longest character n-grams that some language holds (mean over them), n falling step by
step to single characters. A text's score for a language is the mean over its words; the lowest cost wins, ties to the
first name in order.

Defined cases: ``und`` with score 0 for a NULL text, a text without letters (signs that are only numbers are none), or a
model without languages. Training rows with NULL text or language are left out, equal rows count as often as they occur.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
MAX_GRAM = 6
TEXT_AT_ONCE = 2_000_000  # characters


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word between blanks; of length 1 those of the word itself."""
    padded = word if n == 1 else f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass
class LanguageModel:
    """``rows[n]``: n-gram to its row of ``costs``, the negative log10 frequencies by language; ``rows[0]`` holds words,
    and row 0 of ``costs`` says nothing about any language."""

    names: list[str]
    rows: list[dict[str, int]]
    costs: np.ndarray

    def evidence(self, word: str) -> list[int]:
        """The rows whose mean is the word's cost."""
        found = self.rows[0].get(word)
        if found is not None:
            return [found]
        for n in range(MAX_GRAM, 0, -1):
            known = [r for g in grams(word, n) if (r := self.rows[n].get(g)) is not None]
            if known:
                return known
        return [0]

    def word_costs(self, words: list[str]) -> np.ndarray:
        each = [self.evidence(w) for w in words]
        lengths = np.array([len(e) for e in each])
        flat = np.fromiter((r for e in each for r in e), np.int32, lengths.sum())
        starts = np.r_[0, np.cumsum(lengths)[:-1]]
        return np.add.reduceat(self.costs[flat], starts, axis=0) / lengths[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Languages and scores, for as many texts at a time as bound the list of their words."""
        names, scores, held, size = [], [], [], 0
        for i, text in enumerate(texts):
            held.append(text)
            size += len(text or "")
            if size >= TEXT_AT_ONCE or i + 1 == len(texts):
                for total, part in zip((names, scores), self._predict(held), strict=True):
                    total += part
                held, size = [], 0
        return names, scores

    def _predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        words: list[str] = []
        lengths = []
        for text in texts:
            own = [w for w in WORD.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))] if text else []
            lengths.append(len(own))
            words += own
        lengths = np.array(lengths)
        if not words or not self.names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        codes, distinct = pd.factorize(np.array(words, object))
        costs = self.word_costs(distinct)[codes]
        full = np.flatnonzero(lengths)
        starts = np.r_[0, np.cumsum(lengths[full])[:-1]]
        mean = np.add.reduceat(costs, starts, axis=0) / lengths[full, None]
        best = mean.argmin(axis=1)
        # the words of a text hang together: the evidence counts as the root of their number
        odds = 10 ** (np.sqrt(lengths[full])[:, None] * (mean.min(axis=1, keepdims=True) - mean))
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        for i, k, p in zip(full, best, 1 / odds.sum(axis=1), strict=True):
            names[i], scores[i] = self.names[k], float(p)
        return names, scores


def train(docs: DataFrame, eligible: Column, max_docs: int = 2000, max_features: int = 10_000) -> LanguageModel:
    """Learns from ``docs`` (doc_id, text, lang) where ``eligible`` holds.

    Bounds: per language the whole texts of the first ``max_docs`` documents in the order of a hash of the id, and the
    ``max_features`` most frequent words and n-grams of each length, so the ids and the model are small enough to
    broadcast. Words are counted where the texts are read.
    """
    ranked = docs.where(eligible & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = ranked.distinct().withColumn("k", rank).where(F.col("k") <= max_docs).drop("k")
    sample = docs.select("doc_id", "text", "lang").join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter = Counter()
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
                total.update((lang, w) for w in WORD.findall((text or "").lower()))
            langs, words = zip(*total, strict=True) if total else ((), ())
            cells = [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(total.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(cells, ["lang", "gram", "n"])

    def break_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter = Counter()
            for lang, word, n in zip(*(batch[c].to_pylist() for c in ("lang", "gram", "n")), strict=True):
                total[lang, 0, word] += n
                for size in range(1, MAX_GRAM + 1):
                    for gram in grams(word, size):
                        total[lang, size, gram] += n
            langs, sizes, found = zip(*total, strict=True) if total else ((), (), ())
            cells = [pa.array(langs, pa.string()), pa.array(sizes, pa.int32()), pa.array(found, pa.string())]
            cells.append(pa.array(total.values(), pa.int64()))
            yield pa.RecordBatch.from_arrays(cells, ["lang", "size", "gram", "n"])

    words = sample.mapInArrow(count, "lang string, gram string, n long")
    words = words.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    pieces = words.mapInArrow(break_up, "lang string, size int, gram string, n long")
    pieces = pieces.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram")
    top = pieces.withColumn("k", F.row_number().over(order)).where(F.col("k") <= max_features)
    return model(top.select("lang", "size", "gram", "n").toPandas())


def model(counts: pd.DataFrame) -> LanguageModel:
    """From (lang, size, gram, n); a gram a language lacks costs one decade more than its rarest one."""
    names = sorted(counts["lang"].unique())
    rows: list[dict[str, int]] = [{} for _ in range(MAX_GRAM + 1)]
    costs = [np.zeros((1, len(names)), np.float32)]
    begin = 1
    for size, part in counts.groupby("size"):
        which, distinct = pd.factorize(part["gram"])
        cols = np.searchsorted(names, part["lang"])
        total = np.bincount(cols, part["n"], len(names))
        table = np.broadcast_to(np.log10(np.maximum(total, 1)) + 1, (len(distinct), len(names))).astype(np.float32)
        table[which, cols] = np.log10(total[cols]) - np.log10(part["n"])
        rows[size] = dict(zip(distinct, range(begin, begin + len(distinct)), strict=True))
        costs.append(table)
        begin += len(distinct)
    return LanguageModel(names, rows, np.concatenate(costs))


def predicted(text: str, languages: LanguageModel, spark) -> Column:
    """A struct column (lang_pred, score) for a text column."""
    shared = spark.sparkContext.broadcast(languages)  # bounded by the features of train()

    @F.pandas_udf("lang_pred string, score double")
    def apply(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            names, scores = shared.value.predict(list(part))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return apply(F.col(text))
