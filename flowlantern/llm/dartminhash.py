"""Near-duplicate documents by DartMinHash.

A document is a weighted set of five-word shingles. Each shingle's plane of weight by rank is cut into cells of unit
area; hashes of shingle and cell place a Poisson number of darts there, the same ones in every document. A document
sees the darts below its shingles' weights and throws as far up in rank as it needs about k ln k + 2k of them; each dart
belongs to one of k coordinates, which keeps the earliest. Two documents agree in a coordinate with probability equal
to their weighted Jaccard similarity.

Documents of equal words are one class member from the start (hot groups of copies cost one signature). Bands of
coordinates make candidates; the exact similarity of the shingle sets decides. All members of a band's bucket meet its
leader, the one that shares most buckets with others, as the original of a family of copies does; those that are not
linked with it meet a leader of their own, ``STARS`` times at most or until a round links nothing. Each round has a row
for a member at most, so a large bucket is not multiplied out. Where some are not linked then, a small bucket compares the rest of its pairs; what
still stands apart from most of a large bucket meets all its members by their rarest shingles: similar sets
share one of those, which leaves no pair of a bucket out. Sizes, the places of the shared shingle and parities of the
sets rule out nearly all pairs that are not similar before their sets are read. Classes are the connected components of
the links.

Defined cases: words are runs of letters and digits in lower case; a text of fewer words than a shingle is one shingle
of all its words; documents without words (NULL, empty) are classes of their own. The class id is the smallest doc_id
of the class. Rows are told apart by doc_id and text; rows that repeat both are copies of each other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlantern.llm.common import stored

SHINGLE = 5
SIMILAR = 0.8
BANDS = 32
ROWS = 6
STARS = 3  # rounds, at most, in which the members of a bucket meet a leader
SMALL = 16  # members of a bucket whose pairs are all compared
SLOTS = 1 << 20  # of the counts by which shingles are rare or common
PARITIES = 512  # of the elements of a set, by hash
DEALT = 256  # sets with a common rare shingle that one part of a join holds
WORD = re.compile(r"[^\W_]+")
TEXT_AT_ONCE = 2_000_000  # characters, of which a signature's darts count as some
#: Chances of at least 1, 2, ... darts in a cell of unit area.
_TAIL = 1 - np.cumsum([np.exp(-1.0) / float(np.prod(np.arange(1, n + 1, dtype=float))) for n in range(16)])
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> U(11)).astype(np.float64) * 2.0**-53


def darts(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, reach: np.ndarray, k: int):
    """The darts that hit: (owner, coordinate, rank, mark of the dart); ``reach`` is the highest rank by element.

    Weights are cut at powers of two: level 0 is [0, 1), level v is [2**(v-1), 2**v). A cell of a level has unit area.
    """
    found = []
    top = float(weights.max()) if len(weights) else 0.0
    level, low, high = 0, 0.0, 1.0
    while low < top:
        at = np.flatnonzero(weights > low)
        height = 1.0 / (high - low)
        cells = np.ceil(reach[at] / height).astype(np.int64)
        each = np.repeat(at, cells)
        cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
        seed = mix(elements[each] ^ mix((cell.astype(np.uint64) << U(6)) + U(level + 1)))
        count = np.searchsorted(-_TAIL, -_unit(mix(seed)), side="left")
        which = np.repeat(np.arange(len(each)), count)
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        mark = mix(seed[which] + (nth.astype(np.uint64) + U(1)) * U(0x9E3779B97F4A7C15))
        rank = (cell[which] + _unit(mark)) * height
        second = mix(mark + U(1))
        weight = low + _unit(second) * (high - low)
        own = each[which]
        hit = (weight < weights[own]) & (rank < reach[own])
        found.append((owner[own[hit]], (mix(second[hit]) % U(k)).astype(np.int64), rank[hit], mark[hit]))
        level, low, high = level + 1, high, high * 2
    if not found:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0), np.empty(0, U))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def signatures(elements: np.ndarray, weights: np.ndarray, lengths: np.ndarray, k: int) -> np.ndarray:
    """k dart marks for each of ``len(lengths)`` sets, which hold the elements one after another; all have some."""
    n = len(lengths)
    owner = np.repeat(np.arange(n), lengths)
    mass = np.bincount(owner, weights, n)
    marks = np.zeros((n, k), U)
    reach = (k * np.log(k) + 2 * k) / np.maximum(mass, 1e-12)
    todo = np.flatnonzero(lengths)
    while len(todo):
        open_ = np.zeros(n, bool)
        open_[todo] = True
        use = open_[owner]
        own, place, rank, mark = darts(elements[use], weights[use], owner[use], reach[owner[use]], k)
        late = np.argsort(-rank, kind="stable")  # the earliest dart of a coordinate is written last
        marks[own[late], place[late]] = mark[late]
        todo = todo[(marks[todo] == 0).any(axis=1)]
        reach[todo] *= 2  # a coordinate without a dart: look further up
    return marks


class Shingler:
    """Hashes of the shingles of texts; word hashes are kept."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def words(self, text: str | None) -> list[int]:
        found = WORD.findall((text or "").lower())
        ids = list(map(self.known.get, found))
        if None in ids:
            if len(self.known) > 300_000:
                self.known.clear()
            for i, word in enumerate(found):
                if ids[i] is None:
                    ids[i] = self.known[word] = xxhash.xxh3_64_intdigest(word)
        return ids

    @staticmethod
    def shingles(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes of all texts, one after another, and their number by text."""
        full = np.where(lengths >= SHINGLE, lengths - SHINGLE + 1, np.minimum(lengths, 1))
        begin = np.repeat(np.cumsum(lengths) - lengths, full)
        first = begin + np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
        left = np.repeat(lengths, full) - (first - begin)  # words from here to the text's end
        found = np.zeros(len(first), U)
        for i in range(SHINGLE):
            word = words[np.minimum(first + i, len(words) - 1)] if len(words) else found
            found = np.where(left > i, mix(found * U(0x9E3779B97F4A7C15) + word), found)
        return found, full


def weighted(elements: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct elements of each set, their number by set and how often each occurs."""
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((elements, owner))
    e, o = elements[order], owner[order]
    first = np.flatnonzero(np.r_[True, (e[1:] != e[:-1]) | (o[1:] != o[:-1])]) if len(e) else order
    return e[first], np.bincount(o[first], minlength=len(counts)), np.diff(np.r_[first, len(e)]).astype(float)


def _sets(rows: list[tuple], shingler: Shingler, k: int = 0):
    """Runs of rows of bounded text: the rows, each one's word hashes, shingles, numbers of them and weights; ``k`` is
    the length of a signature to be made of each."""
    held, size = [], 0
    for i, row in enumerate(rows):
        held.append(row)
        size += len(row[-1] or "") + 16 * k
        if size >= TEXT_AT_ONCE or i + 1 == len(rows):
            ids = [np.array(shingler.words(r[-1]), U) for r in held]
            lengths = np.array([len(x) for x in ids])
            all_words = np.concatenate(ids)
            yield held, ids, *weighted(*Shingler.shingles(all_words, lengths))
            held, size = [], 0


def _fold(marks: np.ndarray) -> np.ndarray:
    """One number for each run of marks along the last axis."""
    found = np.zeros(marks.shape[:-1], U)
    for i in range(marks.shape[-1]):
        found = mix(found + marks[..., i] + U(i + 1))
    return found


def _content(ids: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(ids.tobytes())


def _marked(docs: DataFrame, bands: int, rows: int, weights: bool) -> DataFrame:
    """doc_id, text_key, content, bands (a hash for each) and number of shingles of every row, in one reading."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            texts = list(zip(*(batch[c].to_pylist() for c in ("doc_id", "text_key", "text")), strict=True))
            for held, ids, elements, counts, times in _sets(texts, shingler, bands * rows):
                mass = times if weights else np.ones(len(times))
                marks = signatures(elements, mass, counts, bands * rows)
                folded = _fold(marks.reshape(len(held), bands, rows) + np.arange(bands, dtype=U)[None, :, None]).astype(np.int64)
                columns = [
                    pa.array([r[0] for r in held], pa.int64()),
                    pa.array([r[1] for r in held], pa.int64()),
                    pa.array([_content(i) if len(i) else None for i in ids], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(len(held) + 1, dtype=np.int32) * bands, folded.ravel()),
                    pa.array(counts.astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "content", "bands", "size"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return keyed.mapInArrow(read, "doc_id long, text_key long, content binary, bands array<long>, size long")


def _shingle_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and its sorted shingle hashes, for the nodes that have a candidate."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            texts = list(zip(*(batch[c].to_pylist() for c in ("node", "text")), strict=True))
            for held, _, elements, counts, _ in _sets(texts, shingler):
                own = np.split(elements, np.cumsum(counts)[:-1])
                columns = [pa.array([r[0] for r in held], pa.binary()), pa.array([e.tobytes() for e in own], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["node", "shingles"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    same = keyed["doc_id"].eqNullSafe(nodes["doc_id"]) & (keyed["text_key"] == nodes["text_key"])
    texts = keyed.join(nodes, same).select("node", "text").dropDuplicates(["node"])
    return texts.mapInArrow(read, "node binary, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of at least ``similar``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist(), strict=True):
                one, two = np.frombuffer(x, U), np.frombuffer(y, U)
                small, large = sorted((len(one), len(two)))
                common = len(np.intersect1d(one, two, assume_unique=True)) if small >= similar * large else 0
                keep.append(common >= similar * (small + large - common) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # Many pairs may share their b, a leader, but few their a: the sets move when the pairs are dealt by a.
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    both = both.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a binary, b binary")


def _counts(sets: DataFrame) -> np.ndarray:
    """How many sets hold a shingle, summed over the shingles of a slot."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(batch["shingles"].to_pylist()), U)
            total += np.bincount((held % U(SLOTS)).astype(np.int64), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])

    found = sets.select("shingles").mapInArrow(read, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SLOTS, np.int32)
    counts[found["slot"].to_numpy()] = np.minimum(found["n"].to_numpy(), 2**31 - 1)
    return counts


def _rare(sets: DataFrame, counts: np.ndarray, similar: float) -> DataFrame:
    """node, label, size, parities, and shingle and its place for each of a set's rarest shingles: so many that similar
    sets share one of them."""
    words = PARITIES // 64

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, label, held in zip(*(batch[c].to_pylist() for c in ("node", "label", "shingles")), strict=True):
                e = np.frombuffer(held, U)
                n = len(e)
                first = e[np.lexsort((e, counts[(e % U(SLOTS)).astype(np.int64)]))][: n - int(np.ceil(similar * n - 1e-6)) + 1]
                odd = np.bincount((mix(e) % U(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
                parities = np.packbits(odd.astype(np.uint8)).view(np.int64)
                k = len(first)
                columns = [pa.array([node] * k, pa.binary()), pa.array([label] * k, pa.binary()), pa.array(np.full(k, n, np.int64))]
                columns += [pa.array(first.view(np.int64)), pa.array(np.arange(k, dtype=np.int64))]
                columns += [pa.array(np.full(k, p)) for p in parities]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["node", "label", "size", "shingle", "place", *(f"p{i}" for i in range(words))]
    types = ["binary", "binary", *["long"] * (3 + words)]
    return sets.select("node", "label", "shingles").mapInArrow(read, ", ".join(map(" ".join, zip(names, types, strict=True))))


def _left_over(large: DataFrame, labels: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """All pairs (a, b) not linked yet that may be similar, of the members of a bucket of ``large`` (key, node): each
    member outside the class that most of the bucket belong to against all the others."""
    placed = stored(large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "left")
    home = placed.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key")
    home = home.agg(F.max_by("label", F.struct("n", "label")).alias("home"), F.count("*").alias("classes"))
    placed = placed.join(home.where(F.col("classes") > 1).select("key", "home"), "key")
    members = placed.groupBy("node", "label").agg(F.max(F.col("label") != F.col("home")).alias("apart"))
    members = stored(members.join(sets, "node"), "left")
    counts = _counts(members)
    every = stored(_rare(members, counts, similar), "rare")
    hot = every.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") > DEALT)
    hot = stored(hot.select("shingle", F.ceil(F.col("n") / DEALT).alias("parts")), "hot")
    dealt = every.join(hot, "shingle", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    one = dealt.join(members.where("apart").select("node"), "node", "left_semi")
    one = one.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    two = dealt.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).drop("parts")
    x, y = one.alias("x"), two.alias("y")
    both = F.col("x.size") + F.col("y.size")
    rest = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))  # from the shared shingle on
    unlike = sum(F.bit_count(F.col(f"x.p{i}").bitwiseXOR(F.col(f"y.p{i}"))) for i in range(PARITIES // 64))
    may = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.label") != F.col("y.label"))
    may &= F.least("x.size", "y.size") >= similar * F.greatest("x.size", "y.size") - 1e-6
    may &= rest >= both * (similar / (1 + similar)) - 1e-6
    may &= unlike <= both * ((1 - similar) / (1 + similar)) + 1e-6
    found = x.join(y, may).select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b"))
    return stored(found.distinct(), "pairs")


def components(edges: DataFrame) -> DataFrame:
    """node and the smallest node it is connected with, for the nodes of ``edges`` (a, b).

    Each step takes the smallest label among a node and its neighbours and then that label's label, so paths shorten
    by doubling; it ends with the first step that changes nothing.
    """
    both = stored(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("least"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "least").alias("next"))
        up = labels.select(F.col("node").alias("next"), F.col("label").alias("above"))
        step = step.join(up, "next", "left").select("node", "label", F.least("next", F.coalesce("above", "next")).alias("next"))
        step = stored(step, "labels")
        changed = step.where(F.col("label") != F.col("next")).limit(1).count()
        labels = step.select("node", F.col("next").alias("label"))
        if not changed:
            return labels


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``labels`` (node, label) after further ``links`` (a, b). Only links between two components count,
    so what is searched is the graph of those and not that of all nodes once more."""
    one, two = (labels.select(F.col("node").alias(end), F.col("label").alias(name)) for end, name in (("a", "x"), ("b", "y")))
    ends = links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    ends = stored(ends.where(F.col("a") != F.col("b")).distinct(), "edges")
    if ends.isEmpty():
        return labels
    above = stored(components(ends), "labels")
    moved = labels.join(above.select(F.col("node").alias("label"), F.col("label").alias("top")), "label", "left")
    # A label is a node of its component, so nodes without one are not among the labels.
    fresh = above.join(labels, "node", "left_anti")
    return stored(moved.select("node", F.coalesce("top", "label").alias("label")).union(fresh), "labels")


def _leader(value: str) -> Column:
    """``value`` of the member of the highest degree, the smallest one of those."""
    return F.min_by(value, F.struct(-F.col("degree"), F.col("node")))


def _apart(buckets: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is left to compare in buckets (key, node, degree, grade) whose members are not all linked.

    Similar sets are of similar size, their grades (by powers of 1 / similar) equal or next to each other: buckets are
    split by two grades at a time, which parts no such pair. A bucket of up to ``SMALL`` members gives its pairs (a, b);
    the larger ones (key, node) are for ``_left_over``, which compares all of a member apart that may be similar.
    """
    placed = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    facts = [F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")]
    open_ = placed.groupBy("key").agg(*facts).where(F.col("low") != F.col("high")).select("key")
    two = F.explode(F.array(F.col("grade"), F.col("grade") + 1)).alias("part")
    placed = placed.join(open_, "key").select("node", "label", "key", two)
    placed = placed.withColumn("key", F.xxhash64("key", "part")).drop("part")
    facts = placed.groupBy("key").agg(*facts).where(F.col("low") != F.col("high")).select("key", "n")
    placed = stored(placed.join(facts, "key"), "apart")
    small = placed.where(F.col("n") <= SMALL)
    one = small.select("key", F.col("node").alias("a"), F.col("label").alias("x"))
    two = small.select("key", F.col("node").alias("b"), F.col("label").alias("y"))
    pairs = one.join(two, "key").where((F.col("a") > F.col("b")) & (F.col("x") != F.col("y"))).select("a", "b").distinct()
    return pairs, placed.where(F.col("n") > SMALL).select("key", "node")


def near_duplicates(
    docs: DataFrame, similar: float = SIMILAR, bands: int = BANDS, rows: int = ROWS, weights: bool = False
) -> DataFrame:
    """doc_id, text_key, class_id, n_members, kept for every row of ``docs`` (doc_id, text).

    ``weights`` makes signatures of shingles weighted by their number; links are always judged by the sets.
    """
    marked = stored(_marked(docs, bands, rows, weights), "marked")
    known = marked.where(F.col("content").isNotNull())
    first = F.min_by(F.struct("doc_id", "text_key", "bands", "size"), F.struct(F.coalesce("doc_id", F.lit(0)), "text_key"))
    nodes = stored(known.groupBy(F.col("content").alias("node")).agg(first.alias("r")).select("node", "r.*"), "nodes")
    grade = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(1 / similar))).alias("grade")
    members = nodes.select("node", grade, F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    buckets = stored(members.join(shared, "key"), "members")
    # who shares the most buckets with others is most likely what they are copies of
    active = stored(buckets.groupBy("node").agg(F.sum("n").alias("degree")), "active")
    buckets = stored(buckets.drop("n").join(active, "node"), "members")
    sets = stored(_shingle_sets(docs, nodes.drop("bands", "size").join(active.select("node"), "node")), "sets")
    # all members of a bucket meet its leader; those that stay apart from it meet a leader of their own
    rest, labels, tried = buckets, None, None
    for _ in range(STARS):
        heads = rest.groupBy("key").agg(_leader("node").alias("leader"), _leader("grade").alias("level"))
        star = rest.join(heads, "key")
        fresh = star.where((F.col("node") != F.col("leader")) & (F.abs(F.col("grade") - F.col("level")) <= 1))
        fresh = fresh.select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
        fresh = stored(fresh if tried is None else fresh.join(tried, ["a", "b"], "left_anti"), "pairs")
        found = stored(_verified(fresh, sets, similar), "links")
        tried = fresh if tried is None else tried.union(fresh)
        if labels is not None and found.isEmpty():
            break
        labels = components(found) if labels is None else joined(labels, found)
        heads = labels.select(F.col("node").alias("leader"), F.col("label").alias("first"))
        placed = star.join(labels, "node", "left").join(heads, "leader", "left")
        own = F.coalesce("label", "node") != F.coalesce("first", "leader")
        rest = stored(placed.where(own).select("key", "node", "grade", "degree"), "rest")
    pairs, large = _apart(buckets, labels)
    fresh = stored(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
    labels = joined(labels, stored(_verified(fresh, sets, similar), "links"))
    labels = joined(labels, stored(_verified(_left_over(large, labels, sets, similar), sets, similar), "links"))
    labels = marked.join(labels.withColumnRenamed("node", "content"), "content", "left")
    labels = labels.select("doc_id", "text_key", F.coalesce("label", "content").alias("label"))
    key = F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("id"), F.col("text_key").alias("key"))
    one = [F.lit(1).cast("long").alias("n_members"), F.lit(True).alias("kept")]
    alone = labels.where(F.col("label").isNull()).select("doc_id", "text_key", F.col("doc_id").alias("class_id"), *one)
    classes = labels.where(F.col("label").isNotNull()).groupBy("label")
    classes = classes.agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_members"), F.min(key).alias("first"))
    classed = labels.join(classes, "label").withColumn("kept", key == F.col("first"))
    return classed.select(alone.columns).union(alone)


def keep_one(docs: DataFrame, **parameters) -> DataFrame:
    """The row of the smallest doc_id (and hash of its text) of every class, with all columns of ``docs``; rows that
    repeat id and text leave one."""
    kept = near_duplicates(docs, **parameters).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    kept = stored(kept.distinct(), "kept")
    keyed = docs.withColumn("_text", F.coalesce(F.xxhash64("text"), F.lit(0)))
    found = keyed.join(kept, keyed["doc_id"].cast("long").eqNullSafe(kept["_id"]) & (keyed["_text"] == kept["_key"]))
    copy = F.row_number().over(Window.partitionBy("_id", "_key").orderBy("_key"))
    return found.withColumn("_copy", copy).where(F.col("_copy") == 1).select(docs.columns)
