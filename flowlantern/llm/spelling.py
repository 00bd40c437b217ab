"""Groups of spelling variants: words one edit apart, found by pivotal bigrams.

The bigrams of a vocabulary are ordered by how often they occur, rare ones first. A word's prefix are its occurrences
of the bigrams up to its third in that order; among them a dynamic program chooses the two rarest that do not
overlap, its pivots. One inserted, deleted or replaced character leaves at least one pivot whole, and of two
words one edit apart, that with the earlier prefix end finds its whole pivots in the prefix of the other. So words
are indexed by their prefix bigrams and looked up by the pivots of others. Position limits come from the edit, too: on
the side of the bigram away from the edit the words are equal, so an entry is addressed by word length, side, the
bigram's place from that end and what stands on that side. Whatever meets there is checked by edit distance.

Bigrams are kept as slots of a hash: slots of one number are one bigram of the method, which only adds candidates, and
the table of frequencies has one size for any alphabet. Addresses are hashes as well, but equality of the side is
checked on the words, and a pair that several addresses bring together counts at the first of them.

Every word then joins its most frequent neighbour, if that is at least twice as frequent. Frequencies at least double
along such a chain, so roots are found by a number of pointer jumps that is logarithmic in the logarithm of the largest
frequency.

Joins whose sides Spark sizes by a stored file, not by a shuffle, are merge joins by hint: a word becomes some twenty
entries, which Spark takes for one row, and rows of packed files are several times larger in memory. By these sizes it
would broadcast tables that the driver has no room for.

Defined cases: NULL words and those shorter than ``min_length`` (at least 4) or rarer than ``min_count`` take no part.
Ties between neighbours go to the word first in code-point order. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlantern.llm.common import stored

SLOTS = 1 << 16  # numbers that bigrams are hashed to
CELLS = 1 << 20  # characters worked on at a time
MIX = np.uint64(0x9E3779B97F4A7C15)
ENTRY = "address long, probe boolean, word string, n long, last int, place int, head int, tail boolean"


def vocabulary(words: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """word, n of the rows of ``words`` (word) that are long and frequent enough."""
    fine = words.where(F.length("word") >= min_length)
    return fine.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and code points of words of equal length, a bounded number at a time."""
    sizes = np.fromiter(map(len, words), int, len(words))
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        step = max(1, CELLS // int(size))
        for at in range(0, len(places), step):
            some = places[at : at + step]
            yield some, np.frombuffer("".join(words[i] for i in some).encode("utf-32-le"), "<u4").reshape(len(some), size)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def _slots(points: np.ndarray) -> np.ndarray:
    """The slot of each bigram."""
    points = points.astype(np.uint64)
    return (_mixed((points[:, :-1] << np.uint64(32)) | points[:, 1:]) >> np.uint64(48)).astype(np.int64) % SLOTS


def gram_ranks(vocab: DataFrame) -> np.ndarray:
    """The place of each slot in the order of rising frequency. The table sent to the driver has SLOTS rows at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for _, points in _by_length(batch["word"].to_pylist()):
                total += np.bincount(_slots(points).ravel(), minlength=SLOTS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "n"])

    total = np.zeros(SLOTS, np.int64)
    for row in vocab.select("word").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        total[row["slot"]] = row["n"]
    ranks = np.empty(SLOTS, np.int32)
    ranks[np.lexsort((np.arange(SLOTS), total))] = np.arange(SLOTS)
    return ranks


def pivots(ranks: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Two bigrams of each row's prefix that do not overlap and whose ranks have the least sum.

    One step of the dynamic program for each place: the best pair that ends here is this bigram and the best single
    one at least two places before.
    """
    far = np.int64(1 << 40)
    cost = np.where(prefix, ranks.astype(np.int64), far)
    n, rows = len(cost), np.arange(len(cost))
    one, at = np.full(n, far), np.zeros(n, int)  # the best single bigram so far and its place
    two, chosen = np.full(n, 2 * far), np.zeros((n, 2), int)
    for j in range(2, cost.shape[1]):
        better = cost[:, j - 2] < one
        one, at = np.where(better, cost[:, j - 2], one), np.where(better, j - 2, at)
        total = one + cost[:, j]
        better = total < two
        two = np.where(better, total, two)
        chosen[rows[better]] = np.stack([at, np.full(n, j)], axis=1)[better]
    return chosen


def _sides(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every head (characters up to and with a bigram) and every tail (a bigram and all behind it)."""

    def run(x: np.ndarray) -> np.ndarray:
        made = np.zeros((len(x), x.shape[1] + 1), np.uint64)
        for i in range(x.shape[1]):
            made[:, i + 1] = _mixed(made[:, i] * MIX + x[:, i] + np.uint64(1))
        return made

    points = points.astype(np.uint64)
    return run(points)[:, 2:], run(points[:, ::-1])[:, 2:][:, ::-1]


def _entries(vocab: DataFrame, ranks: np.ndarray) -> DataFrame:
    """The index entries and the probes of every word (see ENTRY). ``head``: the first pivot's place, -1 for itself."""
    shared = vocab.sparkSession.sparkContext.broadcast(ranks)
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}
    layout = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ENTRY.split(", "))])

    def addressed(hashes: np.ndarray, size: int, tail: bool) -> np.ndarray:
        return _mixed(hashes + np.uint64(2 * size + tail) * MIX).view(np.int64)

    def emit(words: np.ndarray, counts: np.ndarray, points: np.ndarray, order: np.ndarray) -> Iterator[pa.RecordBatch]:
        size = points.shape[1]
        own = order[_slots(points)]
        last = np.sort(own, axis=1)[:, 2]
        prefix = own <= last[:, None]
        chosen = pivots(own, prefix)
        heads, tails = _sides(points)
        row, place = np.nonzero(prefix)
        found = [(row, place, np.full(len(row), -1), hashes, size, tail, False) for tail, hashes in ((False, heads), (True, tails))]
        every = np.arange(len(points))
        for first in (True, False):
            place, head = chosen[:, 0 if first else 1], np.full(len(points), -1) if first else chosen[:, 0]
            for length in (size - 1, size, size + 1):
                found += [(every, place, head, hashes, length, tail, True) for tail, hashes in ((False, heads), (True, tails))]
        for row, place, head, hashes, length, tail, probe in found:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(addressed(hashes[row, place], length, tail)),
                    pa.array(np.full(len(row), probe)),
                    words.take(pa.array(row)),
                    pa.array(counts[row]),
                    pa.array(last[row].astype(np.int32)),
                    pa.array(place.astype(np.int32)),
                    pa.array(head.astype(np.int32)),
                    pa.array(np.full(len(row), tail)),
                ],
                schema=layout,
            )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches:
            words, counts = batch["word"].cast(pa.string()), batch["n"].to_numpy()
            for some, points in _by_length(words.to_pylist()):
                yield from emit(words.take(pa.array(some)), counts[some], points, order)

    return vocab.select("word", "n").mapInArrow(make, ENTRY)


def neighbours(vocab: DataFrame) -> DataFrame:
    """Each pair of words of ``vocab`` (word, n) one edit apart, once: a, n_a, b, n_b."""
    entries = _entries(vocab, gram_ranks(vocab))
    a = entries.where("probe").select("address", F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("last").alias("last_a"), "place", "head", "tail")
    b = entries.where("NOT probe").select("address", F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("last").alias("last_b"))

    def heads(place: str) -> Column:
        return F.expr(f"left(a, {place} + 2) = left(b, {place} + 2)")

    def tails(place: str) -> Column:
        return F.expr(f"right(a, length(a) - {place}) = right(b, length(a) - {place})")

    # the word with the earlier prefix end looks the other up, so a pair has one direction
    turn = (F.col("last_a") < F.col("last_b")) | ((F.col("last_a") == F.col("last_b")) & (F.col("a") < F.col("b")))
    own = F.when(F.col("tail"), tails("place") & ~heads("place")).otherwise(heads("place"))
    before = (F.col("head") >= 0) & (heads("head") | tails("head"))  # the first pivot has it already
    met = a.join(b.hint("merge"), "address").where(turn & own & ~before).where(F.levenshtein("a", "b", 1) == 1)
    return met.select("a", "n_a", "b", "n_b")


def _roots(forms: DataFrame, largest: int) -> DataFrame:
    """word, root for the words of ``forms`` (word, form), by jumps that double in length."""
    steps, span = 0, 1
    while 2**span <= largest:  # a chain has at most log2(largest) words behind its first
        steps, span = steps + 1, 2 * span
    at = forms.select("word", F.col("form").alias("root"))
    for _ in range(steps):
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        at = stored(at.join(ahead.hint("merge"), "root", "left").select("word", F.coalesce("ahead", "root").alias("root")), "roots")
    return at


def variant_groups(words: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """word, form, root, n, n_near, form_n for the vocabulary of ``words`` (a row with ``word`` for each occurrence)."""
    if min_length < 4:
        raise ValueError("two bigrams that do not overlap need words of at least 4 characters")
    vocab = stored(vocabulary(words, min_length, min_count), "vocabulary")
    pairs = neighbours(vocab)
    ends = F.explode(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
            F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
        )
    )
    near = pairs.select(ends.alias("e")).select("e.*")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    near = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = vocab.join(near, "word", "left")
    large = -F.col("best.n") >= 2 * F.col("n")
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(large, F.col("best.word")).alias("form"),
        F.when(large, -F.col("best.n")).alias("form_n"),
    )
    found = stored(found, "forms")
    roots = _roots(found.where(F.col("form").isNotNull()), found.agg(F.max("n")).first()[0] or 0)
    found = found.join(roots.hint("merge"), "word", "left").withColumn("root", F.coalesce("root", "word"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
