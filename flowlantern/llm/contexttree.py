"""Language-model scores by context-tree weighting over bytes.

A text is its UTF-8 bytes with A-Z in lower case and an end byte (0xFF, which no text holds), preceded by end bytes. A
byte is a path of eight binary decisions; every decision has a tree of contexts of 0 to ``DEPTH`` bytes before. A node
estimates its decision by Krichevsky-Trofimov from the counts of the training documents, and the estimates of all
depths are mixed with the weights that the context tree gives them: a node's own block probability against the product
of its children's. A context that training never saw adds nothing below its parent. The score is the log10 probability
of the text; divided by the bytes it is a code length.

Nothing of the corpus passes through one place: texts are cut into blocks; a block asks for its distinct strings of
DEPTH + 1 bytes, which go by the two bytes before to the shard that holds their part of the trees; the answers come
back in the order asked. Counts of more than ``FAN`` blocks are summed in steps of ``FAN``. Only the contexts of one and
no bytes, 256 * 255 decisions at most, are collected. The base score's word counts travel the same way.

Defined cases: a NULL or empty text is the end byte only. Rows without doc_id are scored but not learned from. Without
training documents every decision has probability 1/2.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlantern.llm.common import stored
from flowlantern.session import shared_dir

DEPTH = 5
BLOCK_BYTES = 8 << 20
FAN = 64
END = 0xFF
U = np.uint64
ASKED = "block long, shard int, keys binary, counts binary"


def codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the texts and their ends a number: the bytes before, nearest first, and the byte itself last;
    and the number of bytes by text, its end included."""
    lead = bytes([END]) * DEPTH
    data = np.frombuffer(lead + b"".join(t + lead for t in texts), np.uint8).astype(U)
    n = len(data) - DEPTH
    found = np.zeros(n, U)
    for back in range(1, DEPTH + 1):
        found = (found << U(8)) | data[DEPTH - back : DEPTH - back + n]
    found = (found << U(8)) | data[DEPTH:]
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    # a text is followed by DEPTH end bytes: the first is its end, the others lead the next text
    starts = np.cumsum(lengths + DEPTH - 1) - (lengths + DEPTH - 1)
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    return found[at], lengths


def shard_of_codes(keys: np.ndarray, shards: int) -> np.ndarray:
    """By the two bytes before: all contexts that share them stay together."""
    near = (keys >> U(8 * DEPTH - 8)) & U(0xFFFF)
    return ((near * U(0x9E3779B97F4A7C15)) >> U(33)).astype(np.int64) % shards


def squeeze(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def spread(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _steps(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=U(0)))


def _keys(data: bytes) -> np.ndarray:
    return np.cumsum(spread(data, "<u8"), dtype=U)


def _nodes(keys: np.ndarray, counts: np.ndarray, depth: int):
    """Of contexts of ``depth`` bytes the distinct (context, byte) rows, their counts, and each key's row."""
    short = (keys >> U(8 * (DEPTH - depth) + 8) << U(8)) | (keys & U(0xFF))
    if depth == DEPTH:
        return short, counts.astype(float), np.arange(len(keys))
    rows, inverse = np.unique(short, return_inverse=True)
    return rows, np.bincount(inverse, counts, len(rows)), inverse


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma for x >= 0.5, by the recurrence up to 8 and the asymptotic series from there."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        small = y < 8
        shift[small] -= np.log(y[small])
        y[small] += 1
    r = 1 / (y * y)
    return shift + (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y


def block_probability(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - 2 * 0.5723649429247001 - _lgamma(zeros + ones + 1.0)


class _Level:
    """One decision of all contexts of one depth."""

    def __init__(self, rows: np.ndarray, counts: np.ndarray, bit: int) -> None:
        node = rows >> U(8 - bit)  # context and the byte's first bits
        first = np.r_[True, node[1:] != node[:-1]] if len(rows) else np.empty(0, bool)
        self.of_row = np.cumsum(first) - 1
        self.context = rows[first] >> U(8)
        n = int(first.sum())
        one = (rows >> U(7 - bit)) & U(1) == 1
        self.ones = np.bincount(self.of_row, counts * one, n)
        self.zeros = np.bincount(self.of_row, counts, n) - self.ones
        self.prefix = node[first] & U((1 << bit) - 1)


def _bottom_up(keys: np.ndarray, counts: np.ndarray, top: int):
    """For the depths from ``top`` on, deepest first, and each decision: (depth, bit, level, rows by key, log of the
    level's own block probability, log of the product of its children's weighted ones, the parents' index)."""
    below: list = [None] * 8
    for depth in range(DEPTH, top - 1, -1):
        rows, total, of_key = _nodes(keys, counts, depth)
        for bit in range(8):
            level = _Level(rows, total, bit)
            own = block_probability(level.zeros, level.ones)
            if below[bit] is None:
                weighted, product = own, None
            else:
                # each child's place among this depth's decisions, found through any of its keys
                child, child_of_key, logs = below[bit]
                place = np.zeros(len(logs), np.int64)
                place[child.of_row[child_of_key]] = level.of_row[of_key]
                product = np.bincount(place, logs, len(own))
                weighted = np.logaddexp(own, product) + np.log(0.5)
            yield depth, bit, level, of_key, own, product, weighted
            below[bit] = (level, of_key, weighted)


def near_root(keys: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    """Sums over the contexts of two bytes, by the byte before and decision: (c, node, logs, zeros, ones)."""
    parts = []
    for depth, bit, level, _, _, _, weighted in _bottom_up(keys, counts, 2):
        if depth == 2:
            part = pd.DataFrame({"c": (level.context >> U(8)).astype(np.int64), "node": (level.prefix + U(1 << bit)).astype(np.int64)})
            parts.append(part.assign(logs=weighted, zeros=level.zeros, ones=level.ones))
    if not parts:
        return pd.DataFrame({c: [] for c in ("c", "node", "logs", "zeros", "ones")})
    return pd.concat(parts).groupby(["c", "node"], as_index=False).sum()


class Root:
    """The decisions of contexts of one and no bytes: estimates of a one and the weight of the own estimate."""

    def __init__(self, sums: pd.DataFrame) -> None:
        c, node = sums["c"].to_numpy(np.int64), sums["node"].to_numpy(np.int64)
        zeros, ones, logs = np.zeros((256, 256)), np.zeros((256, 256)), np.zeros((256, 256))
        for table, name in ((zeros, "zeros"), (ones, "ones"), (logs, "logs")):
            table[c, node] = sums[name]
        own = block_probability(zeros, ones)
        weighted = np.logaddexp(own, logs) + np.log(0.5)
        weighted[zeros + ones == 0] = 0
        self.seen = zeros + ones > 0
        self.one, self.weight = (ones + 0.5) / (zeros + ones + 1), 1 / (1 + np.exp(np.clip(logs - own, -700, 700)))
        zeros0, ones0 = zeros.sum(axis=0), ones.sum(axis=0)
        own0 = block_probability(zeros0, ones0)
        self.one0 = (ones0 + 0.5) / (zeros0 + ones0 + 1)
        self.weight0 = 1 / (1 + np.exp(np.clip(weighted.sum(axis=0) - own0, -700, 700)))

    def mix(self, before: np.ndarray, node: np.ndarray, deep: np.ndarray, known: np.ndarray) -> np.ndarray:
        """The probability of a one from that of the deeper contexts, where these were seen."""
        one, weight = self.one[before, node], self.weight[before, node]
        p = np.where(known, weight * one + (1 - weight) * deep, one)
        top, own = self.one0[node], self.weight0[node]
        return np.where(self.seen[before, node], own * top + (1 - own) * p, top)


def log_probabilities(keys: np.ndarray, counts: np.ndarray, root: Root) -> np.ndarray:
    """log10 of the probability of each key's byte after its context; ``keys`` are sorted and hold all of a shard."""
    logs = np.zeros(len(keys))
    deep: list = [(np.full(len(keys), 0.5), np.zeros(len(keys), bool)) for _ in range(8)]
    for depth, bit, level, of_key, own, product, _ in _bottom_up(keys, counts, 2):
        n = level.zeros + level.ones
        one = (level.ones + 0.5) / (n + 1)
        at = level.of_row[of_key]
        p, seen = deep[bit]
        if product is None:
            mixed = one[at]
        else:
            weight = (1 / (1 + np.exp(np.clip(product - own, -700, 700))))[at]
            mixed = np.where(seen, weight * one[at] + (1 - weight) * p, one[at])
        deep[bit] = (mixed, n[at] > 0)
    before = (keys >> U(8 * DEPTH)).astype(np.int64)
    byte = (keys & U(0xFF)).astype(np.int64)
    for bit in range(8):
        node = (1 << bit) | (byte >> (8 - bit))
        p = root.mix(before, node, *deep[bit])
        logs += np.log10(np.where((byte >> (7 - bit)) & 1 == 1, p, 1 - p))
    return logs


def _word_shard(words: list[bytes], shards: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) % shards for w in words], np.int64)


def _gathered(docs: DataFrame, train: Column, path: str, shards: int) -> None:
    """Writes one row of kind ``texts`` for each block, and for each block and shard what it asks for: the distinct
    ``codes`` and ``words`` with their counts in training documents."""
    names = ["kind", "block", "shard", "keys", "counts"]

    def close(block: int, held: list[tuple]) -> Iterator[tuple]:
        texts = [(r[2] or "").encode().lower() for r in held]
        facts = np.array([[r[0] or 0, r[0] is None, r[1], len(t)] for r, t in zip(held, texts, strict=True)], "<i8")
        yield "texts", block, 0, squeeze(np.frombuffer(b"".join(texts), np.uint8)), squeeze(facts)
        found, lengths = codes(texts)
        learned = np.repeat([bool(r[1]) for r in held], lengths)
        keys, n = np.unique(found[learned], return_counts=True)
        others = np.setdiff1d(np.unique(found[~learned]), keys, assume_unique=True) if not learned.all() else keys[:0]
        keys, n = np.r_[keys, others], np.r_[n, np.zeros(len(others), n.dtype)]
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        shard = shard_of_codes(keys, shards)
        for s in np.unique(shard):
            yield "codes", block, int(s), _steps(keys[shard == s]), squeeze(n[shard == s].astype("<i8"))
        total: Counter = Counter()
        for r, text in zip(held, texts, strict=True):
            if r[1]:
                total.update(text.split())
            else:
                total.update(dict.fromkeys(text.split(), 0))
        words = sorted(total)
        shard = _word_shard(words, shards)
        n = np.array([total[w] for w in words], "<i8")
        for s in np.unique(shard):
            at = np.flatnonzero(shard == s)
            joined = zstandard.ZstdCompressor(level=1).compress(b" ".join([words[i] for i in at]))
            yield "words", block, int(s), joined, squeeze(n[at])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0
        types = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

        def out(block: int) -> Iterator[pa.RecordBatch]:
            columns = zip(*close(block, held), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            for row in zip(batch["doc_id"].to_pylist(), batch["train"].to_pylist(), batch["text"], strict=True):
                held.append((row[0], row[1], row[2].as_py()))
                size += len(held[-1][2] or "")
                if size >= BLOCK_BYTES:
                    yield from out((part << 24) + n)
                    n, held, size = n + 1, [], 0
        if held:
            yield from out((part << 24) + n)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), "text")
    rows.mapInArrow(read, "kind string, " + ASKED).write.partitionBy("kind").parquet(path)


def _sum_codes(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([_keys(k) for k in group["keys"]])
    counts = np.concatenate([spread(c, "<i8") for c in group["counts"]])
    rows, inverse = np.unique(keys, return_inverse=True)
    return rows, np.bincount(inverse, counts, len(rows)).astype("<i8")


def _sum_words(group: pd.DataFrame) -> tuple[list[bytes], np.ndarray]:
    total: Counter = Counter()
    for words, counts in zip(group["keys"], group["counts"], strict=True):
        for word, n in zip(zstandard.ZstdDecompressor().decompress(words).split(), spread(counts, "<i8").tolist(), strict=True):
            total[word] += n
    words = sorted(total)
    return words, np.array([total[w] for w in words], "<i8")


def _merged(asked: DataFrame, kind: str, blocks: int) -> DataFrame:
    """(shard, keys, counts) over all blocks, summed in steps of at most ``FAN``."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        if kind == "codes":
            keys, counts = _sum_codes(group)
            packed = _steps(keys)
        else:
            words, counts = _sum_words(group)
            packed = zstandard.ZstdCompressor(level=1).compress(b" ".join(words))
        first = group.iloc[0]
        return pd.DataFrame([[first["shard"], first["batch"], packed, squeeze(counts)]], columns=["shard", "batch", "keys", "counts"])

    rows = asked.select("shard", "batch", "keys", "counts")
    while True:
        rows = rows.groupBy("shard", "batch").applyInPandas(merge, "shard int, batch long, keys binary, counts binary")
        blocks = -(-blocks // FAN)
        if blocks <= 1:
            return stored(rows.select("shard", "keys", "counts"), kind)
        rows = rows.withColumn("batch", F.floor(F.col("batch") / FAN))


def _root(model: DataFrame) -> Root:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch["keys"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                found = near_root(_keys(keys), spread(counts, "<i8"))
                yield pa.RecordBatch.from_pandas(found.astype({"c": "int64", "node": "int64"}), preserve_index=False)

    rows = model.mapInArrow(sums, "c long, node long, logs double, zeros double, ones double")
    total = rows.groupBy("c", "node").agg(*[F.sum(x).alias(x) for x in ("logs", "zeros", "ones")])
    return Root(total.toPandas())  # at most 256 * 255 rows


def _answers(asked: DataFrame, model: DataFrame, kind: str) -> DataFrame:
    """(block, shard, kind, answer): an array of the model's values in the order of what the block asked for."""

    def answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if kind == "codes":
            known, values = _keys(right["keys"].iloc[0]), spread(right["counts"].iloc[0], "<f4")
            for block, keys in zip(left["block"], left["keys"], strict=True):
                found.append((block, squeeze(values[np.searchsorted(known, _keys(keys))])))
        else:
            open_ = zstandard.ZstdDecompressor()
            words = open_.decompress(right["keys"].iloc[0]).split()
            known = dict(zip(words, spread(right["counts"].iloc[0], "<i8").tolist(), strict=True))
            for block, keys in zip(left["block"], left["keys"], strict=True):
                found.append((block, squeeze(np.array([known[w] for w in open_.decompress(keys).split()], "<i8"))))
        out = pd.DataFrame(found, columns=["block", "answer"])
        return out.assign(shard=int(right["s"].iloc[0]), kind=kind)[["block", "shard", "kind", "answer"]]

    copies = asked.select(F.col("shard").alias("s"), F.col("batch").alias("b")).distinct()
    copies = copies.join(model.withColumnRenamed("shard", "s"), "s")
    both = asked.groupBy("shard", "batch").cogroup(copies.groupBy("s", "b"))
    return both.applyInPandas(answer, "block long, shard int, kind string, answer binary")


def scores(docs: DataFrame, train: Column, shards: int | None = None) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score, n_bytes of every row of ``docs``
    (doc_id, text); ``train`` is a condition on doc_id."""
    spark = docs.sparkSession
    if shards is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = min(max(8, size // BLOCK_BYTES), 1 << 15)
    path = shared_dir(spark, "blocks")
    _gathered(docs, train, path, shards)
    rows = spark.read.schema(f"{ASKED}, kind string").parquet(path)
    texts = rows.where(F.col("kind") == "texts")
    numbers = texts.select("block")
    blocks = numbers.count()
    # blocks are dealt to batches by a hash, about FAN to each
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("block"), F.lit(-(-blocks // FAN) or 1)))
    codes_asked, words_asked = (dealt.where(F.col("kind") == k).drop("kind") for k in ("codes", "words"))
    counts, words = _merged(codes_asked, "codes", blocks), _merged(words_asked, "words", blocks)
    root = spark.sparkContext.broadcast(_root(counts))

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [
                squeeze(log_probabilities(_keys(k), spread(c, "<i8"), root.value).astype("<f4"))
                for k, c in zip(batch["keys"].to_pylist(), batch["counts"].to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch["shard"], batch["keys"], pa.array(values, pa.binary())], ["shard", "keys", "counts"])

    model = stored(counts.mapInArrow(evaluate, "shard int, keys binary, counts binary"), "model")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [spread(c, "<i8") for c in batch["counts"].to_pylist()]
            columns = [pa.array([int(x.sum()) for x in n], pa.int64()), pa.array([int((x > 0).sum()) for x in n], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["n", "v"])

    total = words.mapInArrow(add_up, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    ends = docs.where(train).count()
    n_train, distinct = (total[0] or 0) + ends, (total[1] or 0) + (ends > 0)
    answers = _answers(codes_asked, model, "codes").union(_answers(words_asked, words, "words"))
    below = n_train + 0.1 * (distinct + 1)

    def add(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame([], columns=columns)
        facts = spread(left["counts"].iloc[0], "<i8").reshape(-1, 4)
        data = zstandard.ZstdDecompressor().decompress(left["keys"].iloc[0])
        edges = np.r_[0, np.cumsum(facts[:, 3])]
        bodies = [data[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        reply = {(k, s): a for k, s, a in zip(right["kind"], right["shard"], right["answer"], strict=True)}
        found, lengths = codes(bodies)
        of, keys = pd.factorize(found)
        order = np.argsort(keys)
        shard = shard_of_codes(keys[order], shards)
        values = np.zeros(len(keys))
        for s in np.unique(shard):
            values[order[shard == s]] = spread(reply["codes", int(s)], "<f4")
        score = np.add.reduceat(values[of], np.cumsum(lengths) - lengths)
        words = [b.split() for b in bodies]
        sizes = np.array([len(w) for w in words])
        of, distinct_words = pd.factorize(np.array([w for own in words for w in own], object))
        names = list(distinct_words)
        order = np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)
        shard = _word_shard([names[i] for i in order], shards)
        known = np.zeros(len(names), np.int64)
        for s in np.unique(shard):
            known[order[shard == s]] = spread(reply["words", int(s)], "<i8")
        at = np.r_[0, np.cumsum(sizes)]
        logs = np.r_[0, np.cumsum(np.log10((known[of] + 0.1) / below))] if len(of) else np.zeros(1)
        hits = np.r_[0, np.cumsum(known[of] > 0)] if len(of) else np.zeros(1, np.int64)
        end = np.log10((ends + 0.1) / below)
        result = pd.DataFrame(
            {
                "doc_id": pd.Series(facts[:, 0]).astype("Int64").mask(facts[:, 1] == 1),
                "train": facts[:, 2] == 1,
                "n_tokens": sizes + 1,
                "n_known": hits[at[1:]] - hits[at[:-1]] + (ends > 0),
                "train_tokens": n_train,
                "base_score": logs[at[1:]] - logs[at[:-1]] + end,
                "score": score,
                "n_bytes": facts[:, 3],
            }
        )
        return result[columns]

    columns = ["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"]
    layout = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"
    whole = texts.select("block", "keys", "counts").groupBy("block").cogroup(answers.groupBy("block"))
    return whole.applyInPandas(add, layout)
