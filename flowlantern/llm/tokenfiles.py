"""Token ids on disk as directly addressable codes.

An id is cut into chunks of eight bits, lowest first. Level 0 holds the first chunk of every id, level k the next chunk
of those that are longer; a bitmap per level says which go on, and a directory holds the number of set bits before every
block of it. The position of an id on the next level is the rank of its bit, so any id or run of ids is read without
decoding what stands before it.

A file set is a table of segments. A segment holds the ids of whole documents in ascending order of their ids, at least
``SEGMENT`` of them unless it ends its part, with a directory of the documents; ``part`` and ``first`` place it in the set.

Defined cases: a NULL text is empty and has the end id only. Rows that share a doc_id stand in the order of a hash of
the text; a NULL doc_id comes first. Special tokens in a text are treated as the library does on its own.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEGMENT = 1 << 19
BLOCK = 64  # bytes of a bitmap for each entry of its rank directory
CACHE = 1_000_000
LONGEST_CACHED = 48  # characters; longer words hardly come again
TEXT_AT_ONCE = 4_000_000  # bytes
END_MARK = "</w>"
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
LAYOUT = (
    "part int, first long, n_tokens long, doc_ids array<long>, doc_starts array<long>, "
    "chunks array<binary>, flags array<binary>, ranks array<binary>"
)
ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("first", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_starts", pa.list_(pa.int64())),
        ("chunks", pa.list_(pa.binary())),
        ("flags", pa.list_(pa.binary())),
        ("ranks", pa.list_(pa.binary())),
    ]
)


class Codes:
    """The levels of a sequence of ids below 2**32."""

    def __init__(self, chunks: list[bytes], flags: list[bytes], ranks: list[bytes]) -> None:
        self.chunks = [np.frombuffer(c, np.uint8) for c in chunks]
        self.flags = [np.frombuffer(f, np.uint8) for f in flags]
        self.ranks = [np.frombuffer(r, "<u4") for r in ranks]

    @staticmethod
    def pack(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
        chunks, flags, ranks, rest = [], [], [], ids.astype(np.uint32)
        while True:
            longer = rest > 0xFF
            chunks.append((rest & 0xFF).astype(np.uint8).tobytes())
            bits = np.packbits(longer, bitorder="little")
            counts = np.bitwise_count(bits)
            before = np.r_[0, np.cumsum(np.add.reduceat(counts, np.arange(0, len(counts), BLOCK), dtype=np.int64))[:-1]] if len(counts) else []
            flags.append(bits.tobytes())
            ranks.append(np.asarray(before, "<u4").tobytes())
            rest = rest[longer] >> 8
            if not len(rest):
                return chunks, flags, ranks

    def rank(self, level: int, i: int) -> int:
        """Set bits before bit i, from the directory and the bytes of one block."""
        bits, byte = self.flags[level], i >> 3
        block = byte // BLOCK
        if block >= len(self.ranks[level]):
            block -= 1
        if block < 0:
            return 0
        found = int(self.ranks[level][block]) + int(np.bitwise_count(bits[block * BLOCK : byte]).sum())
        return found + (int(bits[byte] & ((1 << (i & 7)) - 1)).bit_count() if i & 7 else 0)

    def slice(self, start: int, stop: int, level: int = 0) -> np.ndarray:
        """The ids from start to stop, exclusive."""
        found = self.chunks[level][start:stop].astype(np.uint32)
        low = start >> 3
        bits = np.unpackbits(self.flags[level][low : (stop + 7) >> 3], bitorder="little")
        longer = bits[start - 8 * low : stop - 8 * low].astype(bool)
        n = int(longer.sum())
        if n:
            at = self.rank(level, start)
            found[longer] |= self.slice(at, at + n, level + 1) << 8
        return found

    def __getitem__(self, i: int) -> int:
        return int(self.slice(i, i + 1)[0])


class Words:
    """The tokenizer behind a cache of chunks: it drops white space and never joins across it.

    Words of plain letters give one run of tokens each, of which the last alone has the end mark of the vocabulary, so
    many of them are encoded as one text. Points and commas behind a letter start a run of their own.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(END_MARK)]] = True

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(c.ids, "<u4") for c in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, words: list[str]) -> list[bytes]:
        """The ids of words of plain letters."""
        ids = self._encode([" ".join(words)])[0] if words else np.empty(0, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):  # a vocabulary without end marks
            return [c.tobytes() for c in self._encode(words)]
        data, bounds = ids.tobytes(), [0, *(4 * stops).tolist()]
        return [data[x:y] for x, y in zip(bounds, bounds[1:], strict=False)]

    def _fresh(self, chunks: set[str]) -> dict[str, bytes]:
        known, found, tails = self.known, {}, {}
        for chunk in chunks:
            core = chunk.rstrip(".,")
            if core != chunk and PLAIN.fullmatch(core[-1:]):
                tails[chunk] = core
        wanted = (chunks - tails.keys()) | {t for c, core in tails.items() for t in (core, c[len(core) :])}
        wanted = [w for w in wanted if w not in known]
        plain = [w for w in wanted if PLAIN.fullmatch(w)]
        found.update(zip(plain, self._plain(plain), strict=True))
        rest = [w for w in wanted if w not in found]
        found.update(zip(rest, (c.tobytes() for c in self._encode(rest)), strict=True))
        for chunk, core in tails.items():
            tail = chunk[len(core) :]
            found[chunk] = (found.get(core) or known[core]) + (found.get(tail) or known[tail])
        return found

    def look_up(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks as little-endian 32-bit integers; those not seen before are encoded together."""
        found = list(map(self.known.get, chunks))
        if None not in found:
            return found
        new = self._fresh({c for c, ids in zip(chunks, found, strict=True) if ids is None})
        found = [new[c] if ids is None else ids for c, ids in zip(chunks, found, strict=True)]
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
        self.known.update((c, ids) for c, ids in new.items() if len(c) <= LONGEST_CACHED)
        return found

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another and each closed by ``end``, and their number by text.

        Texts are cut at white space and equal chunks numbered before anything is looked up.
        """
        parts = pc.ascii_split_whitespace(texts.fill_null("").cast(pa.large_string()))
        chunks = pc.dictionary_encode(parts.flatten())
        distinct = self.look_up(chunks.dictionary.to_pylist())
        which = chunks.indices.to_numpy(zero_copy_only=False)
        ends = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))
        if end is not None:
            which = np.insert(which, ends, len(distinct))
            ends = ends + np.arange(1, len(ends) + 1)
            distinct.append(np.array([end], "<u4").tobytes())
        table = np.frombuffer(b"".join(distinct), "<u4")
        sizes = np.fromiter(map(len, distinct), np.int32, len(distinct)) // 4
        size = sizes[which]
        stops = np.cumsum(size)
        # an id's place in the table: its chunk's begin there plus its place in the chunk
        shift = (np.cumsum(sizes) - sizes)[which] - (stops - size)
        ids = table[np.repeat(shift, size) + np.arange(stops[-1] if len(stops) else 0)]
        return ids, np.diff(np.r_[0, stops][np.r_[0, ends]])


_WORDS: dict[str, Words] = {}


def words(path: str) -> Words:
    """One tokenizer and cache per worker process; the file is installed on every machine."""
    if path not in _WORDS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's to share out
        _WORDS[path] = Words(path)
    return _WORDS[path]


def _segment(part: int, first: int, docs: list[int | None], counts: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    row = [part, first, len(ids), docs, np.cumsum(counts) - counts, *Codes.pack(ids)]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, ARROW, strict=True)], schema=ARROW)


def runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``TEXT_AT_ONCE`` bytes of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False))
    edges = np.flatnonzero(np.diff(sizes // TEXT_AT_ONCE, append=-1)) + 1
    for a, b in zip([0, *edges[:-1]], edges, strict=True):
        yield batch.slice(a, b - a)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, segment: int = SEGMENT) -> None:
    """Writes the ids of ``docs`` (doc_id, text), each document closed by ``end_id``, in ascending order of doc_id."""
    order = [F.col("doc_id").cast("long").asc_nulls_first(), F.xxhash64("text")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, first = words(tokenizer), TaskContext.get().partitionId(), 0
        held: list[tuple[list[int | None], np.ndarray, np.ndarray]] = []

        def close() -> pa.RecordBatch:
            names, counts, ids = zip(*held, strict=True)
            return _segment(part, first, [n for own in names for n in own], np.concatenate(counts), np.concatenate(ids))

        for run in (r for batch in batches for r in runs(batch)):
            ids, counts = encoder.encode(run["text"], end_id)
            held.append((run["doc_id"].to_pylist(), counts, ids))
            size = sum(len(x[2]) for x in held)
            if size >= segment:
                yield close()
                first, held = first + size, []
        if held:
            yield close()

    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.mapInArrow(encode, LAYOUT).write.parquet(path)


def parts(spark: SparkSession, path: str) -> DataFrame:
    """part and the number of ids in the parts before it; one row for each task that wrote."""
    sizes = spark.read.schema(LAYOUT).parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, its ids read from the files at their place."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch[name][row].as_py() for name in ARROW.names}
                codes = Codes(one["chunks"], one["flags"], one["ranks"])
                bounds = [*one["doc_starts"], one["n_tokens"]]
                runs = list(zip(bounds, bounds[1:], strict=False))
                columns = [
                    pa.array([one["part"]] * len(runs), pa.int32()),
                    pa.array(one["doc_ids"], pa.int64()),
                    pa.array([one["first"] + a for a, _ in runs], pa.int64()),
                    pa.array([b - a for a, b in runs], pa.int64()),
                    pa.array([zlib.crc32(codes.slice(a, b).astype("<u4").tobytes()) for a, b in runs], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "place", "n_tokens", "ids_crc32"])

    found = spark.read.schema(LAYOUT).parquet(path)
    found = found.mapInArrow(check, "part int, doc_id long, place long, n_tokens long, ids_crc32 long")
    found = found.join(F.broadcast(parts(spark, path)), "part")  # as many rows as writing tasks
    return found.select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def tokens(spark: SparkSession, path: str, part: int, position: int, count: int = 1) -> list[int]:
    """``count`` ids of one part from ``position`` on, by direct access to the segments that hold them."""
    held = spark.read.schema(LAYOUT).parquet(path).where(F.col("part") == part)
    held = held.where((F.col("first") < position + count) & (F.col("first") + F.col("n_tokens") > position))
    found: list[int] = []
    for row in held.orderBy("first").toLocalIterator():
        codes = Codes(row.chunks, row.flags, row.ranks)
        found += codes.slice(max(position - row.first, 0), min(position + count - row.first, row.n_tokens)).tolist()
    return found
