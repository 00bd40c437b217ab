"""Text quality by a generalised additive model with pairwise interactions.

A text is described by some thirty numbers: counts and shares of kinds of characters and of pairs of neighbouring kinds,
repetition of words and lines, lengths. Each number falls into one of its bins, and the log-odds of a good text
are a base value plus one entry of each number's lookup table plus entries of two-way tables for a few pairs. The
tables are learned by cyclic boosting: in every round each number in turn gets a tree of a few leaves, fitted to
what is still unexplained and added with a small rate; then pairs are ranked by how much a four-leaved table explains
beyond the single numbers, and the best ones are boosted the same way. Rows set aside say when to stop.
Scoring is a lookup and an addition for each table, over whole batches at once.

Defined cases: NULL is the empty text, which has a score, too. Labels other than 0 and 1 and those without id are not
learned from; several labels of one id count as 1 if one does. Without labels of both classes all tables are empty and
the score is the share of good labels (0.5 without labels). Other columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK, LOWER, UPPER, DIGIT, MARK, WIDE = range(6)  # kinds of bytes
KINDS = ("blank", "lower", "upper", "digit", "mark", "wide")
PIECE = 1 << 20  # bytes looked at together
PAIRS = [  # of neighbouring bytes
    *((UPPER, UPPER), (UPPER, LOWER), (LOWER, UPPER), (LOWER, MARK), (MARK, MARK)),
    *((MARK, BLANK), (BLANK, MARK), (BLANK, UPPER), (BLANK, BLANK), (DIGIT, DIGIT)),
]
NAMES = (
    [f"share_{k}" for k in KINDS]
    + [f"pair_{KINDS[a]}_{KINDS[b]}" for a, b in PAIRS]
    + ["log_bytes", "log_words", "word_length", "upper_of_letters", "same_neighbours", "entropy", "distinct_words"]
    + ["top_word", "repeated_words", "short_words", "log_lines", "line_words", "repeated_lines", "sentence_words"]
)


def _kind_of_bytes() -> np.ndarray:
    kind = np.full(256, MARK, np.uint8)
    kind[:33], kind[127], kind[128:] = BLANK, BLANK, WIDE
    kind[ord("a") : ord("z") + 1], kind[ord("A") : ord("Z") + 1], kind[ord("0") : ord("9") + 1] = LOWER, UPPER, DIGIT
    return kind


KIND = _kind_of_bytes()


def features(text: str | None) -> list[float]:
    """The numbers of NAMES."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    counts, pairs, same = np.zeros(256, np.int64), np.zeros(36, np.int64), 0
    for at in range(0, len(raw), PIECE):
        piece = np.frombuffer(raw, np.uint8, min(PIECE + 1, len(raw) - at), at)  # and the first byte of the next one
        counts += np.bincount(piece[:PIECE], minlength=256)
        kind = KIND[piece]
        pairs += np.bincount(kind[:-1] * 6 + kind[1:], minlength=36)
        same += int((piece[1:] == piece[:-1]).sum())
    n = max(len(raw), 1)
    kinds = np.bincount(KIND, counts, 6)
    used = counts[counts > 0] / n
    words, lines = text.split(), [x for x in text.split("\n") if x]
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    n_words, n_lines = max(len(words), 1), max(len(lines), 1)
    ends = int(counts[list(b".!?")].sum())
    return [
        *(kinds / n).tolist(),
        *(pairs[[a * 6 + b for a, b in PAIRS]] / n).tolist(),
        float(np.log1p(len(raw))),
        float(np.log1p(len(words))),
        (len(text) - len(words)) / n_words,
        float(kinds[UPPER] / max(kinds[UPPER] + kinds[LOWER], 1)),
        same / n,
        float(-(used * np.log2(used)).sum()),
        len(seen) / n_words,
        max(seen.values(), default=0) / n_words,
        sum(c for c in seen.values() if c > 2) / n_words,
        sum(c for w, c in seen.items() if len(w) <= 3) / n_words,
        float(np.log1p(len(lines))),
        len(words) / n_lines,
        1 - len(set(lines)) / n_lines if lines else 0.0,
        len(words) / max(ends, 1),
    ]


@dataclass
class Additive:
    """``cuts`` between the bins of each number, ``single`` tables by number, ``double`` tables by pair of numbers."""

    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    single: list[np.ndarray] = field(default_factory=list)
    double: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, rows[:, f], side="right") for f, c in enumerate(self.cuts)], axis=1)

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        if self.cuts and len(rows):
            at = self.bins(rows)
            for f, table in enumerate(self.single):
                total += table[at[:, f]]
            for (a, b), table in self.double.items():
                total += table[at[:, a], at[:, b]]
        return total

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(rows), -30, 30)))


RIDGE = 2.0


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """The values of a tree over ordered bins with sums of slopes ``g`` and curvatures ``h``."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for part in parts:
            left_g, left_h = np.cumsum(g[slice(*part)])[:-1], np.cumsum(h[slice(*part)])[:-1]
            if not len(left_g):
                continue
            all_g, all_h = g[slice(*part)].sum(), h[slice(*part)].sum()
            more = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
            more[(left_h < 0.5) | (all_h - left_h < 0.5)] = 0
            if more.max() > best[0]:
                best = (more.max(), part, part[0] + int(more.argmax()) + 1)
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    values = np.zeros(len(g))
    for part in parts:
        values[slice(*part)] = -g[slice(*part)].sum() / (h[slice(*part)].sum() + RIDGE)
    return values


def square(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree of four leaves over a two-way table: one cut by the first number, then each
    half by the second."""
    none = float(_gain(g.sum(), h.sum()))
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    below_g, below_h = np.cumsum(g, axis=0)[:-1], np.cumsum(h, axis=0)[:-1]
    halves = []
    for half_g, half_h in ((below_g, below_h), (g.sum(axis=0) - below_g, h.sum(axis=0) - below_h)):
        left_g, left_h = np.cumsum(half_g, axis=1)[:, :-1], np.cumsum(half_h, axis=1)[:, :-1]
        all_g, all_h = half_g.sum(axis=1, keepdims=True), half_h.sum(axis=1, keepdims=True)
        halves.append(_gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h))
    total = halves[0].max(axis=1) + halves[1].max(axis=1)
    row = int(total.argmax())
    values = np.zeros(g.shape)
    for half, rows in zip(halves, (slice(0, row + 1), slice(row + 1, None)), strict=True):
        cut = int(half[row].argmax()) + 1
        for columns in (slice(0, cut), slice(cut, None)):
            values[rows, columns] = -g[rows, columns].sum() / (h[rows, columns].sum() + RIDGE)
    return float(total[row]) - none, values


def fit(rows: np.ndarray, labels: np.ndarray, rounds: int = 300, rate: float = 0.1, bins: int = 32, pairs: int = 10, patience: int = 20) -> Additive:
    """Learns the tables from ``rows`` of features and labels 0 or 1. Every fifth row is set aside to stop early."""
    y = np.asarray(labels, float)
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        return Additive(base=float(np.log(max(share, 1e-3) / max(1 - share, 1e-3))))
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    model = Additive(float(np.log(share / (1 - share))), [np.unique(np.quantile(x, quantiles)) for x in rows.T])
    at = model.bins(rows)
    sizes = [len(c) + 1 for c in model.cuts]
    model.single = [np.zeros(n) for n in sizes]
    apart = np.arange(len(y)) % 5 == 4
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return np.where(apart, 0, p - y), np.where(apart, 0, p * (1 - p))

    def loss() -> float:
        held = apart if apart.any() else ~apart
        return float(np.logaddexp(0, np.where(y > 0, -total, total))[held].mean())

    def boost(tables: list[np.ndarray], places: list, grow) -> None:
        """Rounds over all tables in turn; keeps the state with the least loss on the rows set aside."""
        nonlocal total
        best, kept, since = loss(), ([t.copy() for t in tables], total), 0
        for _ in range(rounds):
            for k, (table, place) in enumerate(zip(tables, places, strict=True)):
                g, h = slopes()
                flat = place if isinstance(place, np.ndarray) else place[0] * table.shape[1] + place[1]
                g, h = (np.bincount(flat, x, table.size).reshape(table.shape) for x in (g, h))
                tables[k] = table + rate * grow(g, h)
                total = total + (tables[k] - table).ravel()[flat]
            now, since = loss(), since + 1
            if now < best - 1e-6:
                best, kept, since = now, ([t.copy() for t in tables], total), 0
            if since >= patience:
                break
        tables[:], total = kept

    boost(model.single, [at[:, f] for f in range(len(sizes))], tree)
    g, h = slopes()
    ranked = []
    for a in range(len(sizes)):
        for b in range(a + 1, len(sizes)):
            flat, shape = at[:, a] * sizes[b] + at[:, b], (sizes[a], sizes[b])
            gain, _ = square(*(np.bincount(flat, x, sizes[a] * sizes[b]).reshape(shape) for x in (g, h)))
            ranked.append((-gain, a, b))
    chosen = [(a, b) for gain, a, b in sorted(ranked)[:pairs] if gain < 0]
    tables = [np.zeros((sizes[a], sizes[b])) for a, b in chosen]
    boost(tables, [(at[:, a], at[:, b]) for a, b in chosen], lambda g, h: square(g, h)[1])
    model.double = dict(zip(chosen, tables, strict=True))
    return model


def train(docs: DataFrame, labels: DataFrame, eligible: Column | None = None, max_rows: int = 20_000) -> Additive:
    """Fits a model to ``labels`` (doc_id, quality) for ``docs`` (doc_id, text).

    The sample is bounded: the first ``max_rows`` labelled ids in the order of a hash of the id, and of their rows again as
    many. Only features and labels reach the driver. ``eligible`` is a condition on doc_id.
    """
    wanted = F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)
    marks = labels.where(wanted if eligible is None else wanted & eligible)
    marks = marks.groupBy("doc_id").agg(F.max("quality").cast("double").alias("quality"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    marks = marks.orderBy(*order).limit(max_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")  # max_rows ids at most

    @F.pandas_udf("array<double>")
    def described(texts: pd.Series) -> pd.Series:
        return texts.map(features)

    rows = sample.select("doc_id", "quality", described("text").alias("features"))
    rows = rows.orderBy(*order, "features").limit(max_rows).toPandas()
    if not len(rows):
        return fit(np.zeros((0, len(NAMES))), np.zeros(0))
    return fit(np.stack(rows["features"].to_numpy()), rows["quality"].to_numpy())


def scored(text: str, model: Additive, spark) -> Column:
    """The chance that the text is a good one, 0 to 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def apply(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for part in parts:
            rows = np.array([features(t) for t in part]).reshape(len(part), len(NAMES))
            yield pd.Series(model.score(rows), dtype=float)

    return apply(F.col(text))
