"""Removal of repeated passages by a distributed merge sort of suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. Of all suffixes only those at
anchors are sorted: in every string of ``LENGTH`` bytes the place whose next ``KEY`` bytes have the smallest hash. Equal
strings have their anchors at the same offset, so each repeated string meets its copies in the order of the anchors'
suffixes, and what the anchors' left sides share says how far it starts before them.

1. Anchors whose key occurs once in the corpus are dropped (keys are counted by hash; an equal hash of different keys
   only keeps an anchor longer).
2. Every task sorts the suffixes of its anchors, folds equal ones, cuts the sorted run by ranges of the key's hash (mixed
   again, as anchors have small ones) and front-codes each piece: shared prefix length with the suffix before, and the rest.
3. A range's runs are merged by a loser tree that carries common prefix lengths: two heads with different lengths are
   ordered by these alone, equal ones are compared behind the known prefix. A run's suffixes are decoded one by one,
   when they become its head.
4. The merged order and its prefix lengths group suffixes that share any number of bytes to the right; for every
   split of ``LENGTH`` into bytes left and right of the anchor, members of a group with equal left sides are repeats.

Defined cases: a NULL text is empty; texts below ``LENGTH`` bytes keep all. Matches never cross rows. Rows that repeat
doc_id and text are documents of their own and so repeat each other.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlantern.llm.common import stored

LENGTH = 200
KEY = 40
BYTES_AT_ONCE = 1 << 20
PLACES_BITS = 24  # of a position in a buffer; longer texts are cut into overlapping buffers
SUFFIXES_IN_RANGE = 20_000
SUFFIXES_IN_RUN = 20_000  # sorted at once in a task
U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
KEYED = "doc_id long, text_key long"


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            inverse = U(pow(int(BASE), -1, 1 << 64))
            self.up = np.multiply.accumulate(np.r_[U(1), np.full(n - 1, BASE, U)])
            self.down = np.multiply.accumulate(np.r_[U(1), np.full(n - 1, inverse, U)])
        return self.up[:n], self.down[:n]


POWERS = _Powers()


def key_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each position on, by differences of one running sum."""
    n = len(data)
    if n < size:
        return np.empty(0, U)
    up, down = POWERS.get(n)
    total = np.r_[U(0), np.cumsum((data.astype(U) + U(1)) * up)]
    return mix((total[size:] - total[:-size]) * down[: n - size + 1])


def row_hashes(rows: np.ndarray) -> np.ndarray:
    """The hash ``key_hashes`` gives of each row's bytes."""
    found = np.zeros(len(rows), U)
    for column, power in zip(rows.T, POWERS.get(rows.shape[1])[0], strict=True):
        found += (column.astype(U) + U(1)) * power
    return mix(found)


def anchors(data: np.ndarray, length: int = LENGTH, size: int = KEY) -> tuple[np.ndarray, np.ndarray]:
    """Positions and key hashes of the anchors of one text: the leftmost smallest key of each window."""
    span = length - size + 1
    found, hashes, begin = [], [], 0
    while len(data) - begin >= length:
        part = data[begin : begin + (1 << PLACES_BITS)]
        h = key_hashes(part, size)
        low = (h >> U(PLACES_BITS) << U(PLACES_BITS)) | np.arange(len(h), dtype=U)
        width = 1
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
        places = (low & U((1 << PLACES_BITS) - 1)).astype(np.int64)
        places = places[np.r_[True, places[1:] != places[:-1]]]
        found.append(places + begin)
        hashes.append(h[places])
        if begin + len(part) == len(data):
            break
        begin += len(part) - length + 1
    if not found:
        return np.empty(0, np.int64), np.empty(0, U)
    places, hashes = np.concatenate(found), np.concatenate(hashes)
    places, first = np.unique(places, return_index=True)
    return places, hashes[first]


def _texts(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for text in batch["text"]:
        yield np.frombuffer((text.as_py() or "").encode(), np.uint8)


def _joined(texts: list[np.ndarray], length: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, key hash) of the anchors of many texts, worked out in one buffer: windows that reach
    into the next text are left out."""
    sizes = np.array([len(t) for t in texts])
    if sizes.sum() >= 1 << PLACES_BITS:
        each = [anchors(t, length, size) for t in texts]
        number = np.repeat(np.arange(len(texts)), [len(p) for p, _ in each])
        return number, np.concatenate([p for p, _ in each]), np.concatenate([h for _, h in each])
    data = np.concatenate(texts)
    span = length - size + 1
    starts = np.cumsum(sizes) - sizes
    if len(data) < length:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, U),)
    h = key_hashes(data, size)
    low = (h >> U(PLACES_BITS) << U(PLACES_BITS)) | np.arange(len(h), dtype=U)
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(low)]
    inside = np.arange(len(low)) + length <= (starts + sizes)[owner]
    places, owner = (low[inside] & U((1 << PLACES_BITS) - 1)).astype(np.int64), owner[inside]
    first = np.r_[True, places[1:] != places[:-1]] if len(places) else np.empty(0, bool)
    places, owner = places[first], owner[first]
    return owner, places - starts[owner], h[places]


def _runs(rows: Iterator[tuple], most: int = BYTES_AT_ONCE) -> Iterator[list[tuple]]:
    """Rows (..., bytes) in lists of about ``most`` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _located(docs: DataFrame, length: int, size: int) -> DataFrame:
    """(doc_id, text_key, key, place) of every anchor."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b["doc_id"].to_pylist(), b["text_key"].to_pylist(), _texts(b), strict=True))
        for held in _runs(rows):
            number, place, hashes = _joined([r[2] for r in held], length, size)
            columns = [
                pa.array([held[i][0] for i in number], pa.int64()),
                pa.array([held[i][1] for i in number], pa.int64()),
                pa.array(hashes.view(np.int64)),
                pa.array(place.astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "key", "place"])

    return docs.mapInArrow(read, f"{KEYED}, key long, place int")


def _squeezed(docs: DataFrame) -> DataFrame:
    """The texts compressed for a shuffle."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = pa.array([press.compress((t.as_py() or "").encode()) for t in batch["text"]], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_key"], z], ["doc_id", "text_key", "z"])

    return docs.mapInArrow(squeeze, f"{KEYED}, z binary")


def _contexts(data: np.ndarray, begin: np.ndarray, end: np.ndarray, at: np.ndarray, length: int, size: int):
    """Right and left sides of anchors as fixed rows, zero behind the text's ends; the left side's nearest byte first."""
    reach = length - size
    padded = np.r_[np.zeros(reach, np.uint8), data, np.zeros(length, np.uint8)]
    right = np.lib.stride_tricks.sliding_window_view(padded, length)[at + reach]
    right[np.arange(length) >= (end - at)[:, None]] = 0
    if not reach:
        return right, np.zeros((len(at), 0), np.uint8)
    left = np.lib.stride_tricks.sliding_window_view(padded, reach)[at][:, ::-1].copy()
    left[np.arange(reach) >= (at - begin)[:, None]] = 0
    return right, left


def _order(rows: np.ndarray) -> np.ndarray:
    """The order of byte rows: by their first word, ties by the whole."""
    words = np.ascontiguousarray(rows[:, :8]).view(">u8").ravel().astype(U)
    order = np.argsort(words, kind="stable")
    first = words[order]
    edges = np.flatnonzero(np.r_[True, first[1:] != first[:-1], True])
    for x, y in zip(edges[:-1], edges[1:], strict=True):
        if y - x > 1:
            order[x:y] = sorted(order[x:y], key=lambda i: rows[i].tobytes())
    return order


def front_code(rows: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Of sorted rows the length each shares with the one before, and the bytes behind it."""
    same = rows[1:] == rows[:-1]
    shared = np.r_[0, np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1))] if len(rows) else np.empty(0, int)
    return shared.astype(np.uint16), rows[np.arange(rows.shape[1]) >= shared[:, None]].tobytes()


def front_decode(shared: list[int], rest: bytes, width: int) -> Iterator[bytes]:
    """The rows one by one."""
    row, at = b"", 0
    for same in shared:
        own = width - same
        row = row[:same] + rest[at : at + own]
        at += own
        yield row


def _pack(suffixes: np.ndarray, lefts: np.ndarray, facts: np.ndarray) -> bytes:
    """A sorted run: its distinct contexts with front-coded suffixes and left sides, and where each occurs.

    Occurrences of a context in one document whose places are at most a string's length apart repeat together and
    overlap, so they travel as one chain (document, first and last place): periodic texts have many.
    """
    length = suffixes.shape[1] - 8
    room = np.minimum(facts[:, 3:], [lefts.shape[1], length])  # text before and behind
    both = np.c_[suffixes, lefts, room.astype("<u4").view(np.uint8).reshape(len(room), 8)]
    change = np.r_[True, (both[1:] != both[:-1]).any(axis=1)]
    first, entry = np.flatnonzero(change), np.cumsum(change) - 1
    order = np.lexsort((facts[:, 3], facts[:, 1], facts[:, 0], facts[:, 2], entry))
    f, e = facts[order], entry[order]
    new = np.r_[True, (e[1:] != e[:-1]) | (f[1:, :3] != f[:-1, :3]).any(axis=1) | (np.diff(f[:, 3]) > length)]
    begin = np.flatnonzero(new)
    chains = np.c_[f[begin, :4], f[np.r_[begin[1:], len(f)] - 1, 3]]
    entries = np.c_[np.bincount(entry), np.bincount(e[begin], minlength=len(first)), room[first]]
    suffixes, lefts = suffixes[first], lefts[first]
    shared, rest = front_code(suffixes)
    head = np.array([len(shared), suffixes.shape[1], lefts.shape[1], len(rest)], "<i8").tobytes()
    body = [head, shared.astype("<u2").tobytes(), rest, lefts.tobytes(), entries.astype("<i8").tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([*body, chains.astype("<i8").tobytes()]))


def _unpack(data: bytes) -> tuple:
    """Shared lengths, an iterator of suffixes, left sides, entries (occurrences, chains, bytes before and behind) and
    chains."""
    body = zstandard.ZstdDecompressor().decompress(data)
    n, width, reach, size = np.frombuffer(body, "<i8", 4).tolist()
    at = 32
    shared = np.frombuffer(body, "<u2", n, at).tolist()
    at += 2 * n
    suffixes = front_decode(shared, body[at : at + size], width)
    at += size
    lefts = np.frombuffer(body, np.uint8, n * reach, at).reshape(n, reach).copy()
    at += n * reach
    facts = np.frombuffer(body, "<i8", -1, at).copy()  # copies, as the whole would be kept for a view
    return shared, suffixes, lefts, facts[: 4 * n].reshape(n, 4), facts[4 * n :].reshape(-1, 5)


class LoserTree:
    """Merges sorted runs of (suffix, shared length with the suffix before in its run), of which only the heads are held.

    ``known[r]`` is the length that run r's head shares with the suffix put out last. The head that shares more is the
    smaller one; heads that share the same are compared behind that length, and the loser's length becomes what it
    shares with the winner.
    """

    def __init__(self, runs: list[Iterable[bytes]], shared: list[list[int]]) -> None:
        self.runs, self.shared = list(map(iter, runs)), shared
        self.heads = [next(run, None) for run in self.runs]
        self.size = 1 << max(len(runs) - 1, 0).bit_length()
        self.at = [0] * len(runs)
        self.known = [0] * len(runs)
        self.losers = [-1] * self.size
        self.top = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            run = node - self.size
            return run if run < len(self.runs) and self.heads[run] is not None else -1
        winner, self.losers[node] = self._play(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs' heads; -1 is a run at its end."""
        if a < 0 or b < 0:
            return (b, a) if a < 0 else (a, b)
        known = self.known
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        x, y, begin = self.heads[a], self.heads[b], known[a]
        one, two = int.from_bytes(x[begin:]), int.from_bytes(y[begin:])
        same = len(x) - (((one ^ two).bit_length() + 7) >> 3)
        if one <= two:
            known[b] = same
            return a, b
        known[a] = same
        return b, a

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        """(run, place in it, length shared with the suffix before) in order."""
        while self.top >= 0:
            run = self.top
            yield run, self.at[run], self.known[run]
            self.at[run] += 1
            self.heads[run] = next(self.runs[run], None)
            if self.heads[run] is not None:
                self.known[run] = self.shared[run][self.at[run]]
                winner = run
            else:
                winner = -1
            node = (run + self.size) >> 1
            while node:
                winner, self.losers[node] = self._play(winner, self.losers[node])
                node >>= 1
            self.top = winner


def _runs_of(docs: DataFrame, places: DataFrame, ranges: int, length: int, size: int) -> DataFrame:
    """(range, run): the sorted suffixes of the remaining anchors."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        names = ("doc_id", "text_key", "places", "z")
        rows = (
            (*r[:-1], np.frombuffer(open_.decompress(r[-1]), np.uint8))
            for b in batches
            for r in zip(*(b[c].to_pylist() for c in names), strict=True)
        )
        for held in _runs(rows, 4 * BYTES_AT_ONCE):
            data = np.concatenate([r[-1] for r in held])
            sizes = np.array([len(r[-1]) for r in held])
            counts = [len(r[2]) for r in held]
            number = np.repeat(np.arange(len(held)), counts)
            documents = np.array([[r[0] or 0, r[1], r[0] is None] for r in held], np.int64)
            place = np.concatenate([np.array(r[2], np.int64) for r in held])
            begin = (np.cumsum(sizes) - sizes)[number]
            at, end = begin + place, begin + sizes[number]
            for i in range(0, len(at), SUFFIXES_IN_RUN):
                s = slice(i, i + SUFFIXES_IN_RUN)
                right, left = _contexts(data, begin[s], end[s], at[s], length, size)
                keys = mix(row_hashes(right[:, :size]))  # mixed again: anchors are where these hashes are small
                suffixes = np.c_[keys.astype(">u8").view(np.uint8).reshape(-1, 8), right]
                n = number[s]
                facts = np.c_[documents[n], place[s], end[s] - at[s]]
                order = _order(np.c_[suffixes, left])
                target = (keys[order] >> U(32)).astype(np.int64) * ranges >> 32
                edges = np.flatnonzero(np.r_[True, target[1:] != target[:-1], True])
                runs = [_pack(suffixes[o], left[o], facts[o]) for o in (order[x:y] for x, y in zip(edges[:-1], edges[1:], strict=True))]
                columns = [pa.array(target[edges[:-1]], pa.int64()), pa.array(runs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["range", "run"])

    return _with_texts(docs, places).mapInArrow(sort, "range long, run binary")


def _with_texts(docs: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """``table`` (id, key, ...) joined to the compressed texts of its documents."""
    texts = _squeezed(docs)
    same = texts["doc_id"].eqNullSafe(table["id"]) & (texts["text_key"] == table["key"])
    return texts.join(table, same, how).drop("id", "key")


def repeats(runs: Iterable[bytes], length: int, size: int) -> np.ndarray:
    """Merges the runs of a range; rows (doc_id, text_key, no doc_id, start, stop) of its repeated stretches."""
    shares, suffixes, sides, entries, chains = map(list, zip(*map(_unpack, runs), strict=True))
    offsets = np.cumsum([0] + [len(x) for x in shares]).tolist()
    order, shared = array("q"), array("q")
    for run, at, known in LoserTree(suffixes, shares):
        order.append(offsets[run] + at)
        shared.append(known)
    del shares, suffixes
    order, shared = np.frombuffer(order, np.int64), np.frombuffer(shared, np.int64) - 8  # without the key's hash
    near = np.r_[shared[1:] >= size, False] | np.r_[False, shared[1:] >= size]
    active = np.flatnonzero(near)
    rank = np.full(len(order), -1)
    rank[order[active]] = np.arange(len(active))
    lefts = np.empty((len(active), sides[0].shape[1]), np.uint8)
    while sides:  # left sides move to their places in the order run by run, so they are held once
        side = sides.pop()
        to = rank[offsets[len(sides)] :][: len(side)]
        lefts[to[to >= 0]] = side[to >= 0]
    del rank
    entries, chains = np.concatenate(entries), np.concatenate(chains)
    first = (np.cumsum(entries[:, 1]) - entries[:, 1])[order]  # the first chain of each context
    copies, many, before, behind = entries[order].T
    # a context that occurs twice repeats however it is split; the others have to meet one that shares enough
    twice = (copies > 1) & (before + behind >= length)
    low, high = np.where(twice, length - behind, length), np.where(twice, before, -1)
    group_from = shared[active]
    group_from[np.r_[True, np.diff(active) > 1][: len(active)]] = 0
    left = np.zeros(len(active), U)
    before, behind = before[active], behind[active]
    for d in range(length - size + 1 if len(active) else 0):
        if d:  # one more byte to the left
            left = mix(left * BASE + lefts[:, d - 1].astype(U) + U(1))
        use = np.flatnonzero((before >= d) & (behind >= length - d))
        if len(use) < 2:
            continue
        right = np.cumsum(group_from < length - d)[use]  # suffixes that share enough bytes to the right
        joint = mix(left[use] + right.astype(U) * BASE)
        sorted_ = np.argsort(joint)
        same = joint[sorted_][1:] == joint[sorted_][:-1]
        hit = active[use[sorted_[np.r_[same, False] | np.r_[False, same]]]]
        low[hit] = np.minimum(low[hit], d)
        high[hit] = np.maximum(high[hit], d)
    found = np.flatnonzero(high >= 0)
    each = np.repeat(found, many[found])
    nth = np.arange(len(each)) - np.repeat(np.cumsum(many[found]) - many[found], many[found])
    chains = chains[first[each] + nth]
    return _joined_spans(np.c_[chains[:, :3], chains[:, 3] - high[each], chains[:, 4] - low[each] + length])


def _joined_spans(rows: np.ndarray) -> np.ndarray:
    """Rows (document in three columns, start, stop) with the overlapping ones of a document made one."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0], rows[:, 2]))]
    document = np.cumsum(np.r_[False, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
    shift = document * (rows[:, 4].max() + 1)  # puts the documents one behind the other
    reach = np.maximum.accumulate(rows[:, 4] + shift)
    begin = np.flatnonzero(np.r_[True, rows[1:, 3] + shift[1:] > reach[:-1]])
    last = np.r_[begin[1:], len(rows)] - 1
    return np.c_[rows[begin, :4], reach[last] - shift[last]]


def _spans(runs: DataFrame, length: int, size: int) -> DataFrame:
    def merge(group: pa.Table) -> pa.Table:
        rows = repeats((r.as_buffer() for r in group["run"]), length, size)
        columns = [pa.array(rows[:, 0], mask=rows[:, 2] == 1), *(pa.array(np.ascontiguousarray(rows[:, i])) for i in (1, 3, 4))]
        return pa.Table.from_arrays(columns, ["doc_id", "text_key", "start", "stop"])

    return runs.groupBy("range").applyInArrow(merge, f"{KEYED}, start long, stop long")


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(stop, found[-1][1]))
        else:
            found.append((start, stop))
    return found


def repeated_spans(docs: DataFrame, length: int = LENGTH, size: int = KEY) -> DataFrame:
    """(id, key, spans) of the documents (doc_id, text_key, text) that hold repeated stretches."""
    located = stored(_located(docs, length, size), "anchors")
    keys = located.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("key")
    places = located.join(keys, "key").groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    places = stored(places.agg(F.collect_set("place").alias("places")), "places")
    total = places.agg(F.sum(F.size("places"))).first()[0] or 0
    runs = _runs_of(docs, places, 1 + total // SUFFIXES_IN_RANGE, length, size)
    spans = _spans(runs, length, size).groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    return spans.agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, size: int = KEY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary) of every row of ``docs`` (doc_id, text)."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    spans = stored(repeated_spans(keyed, length, size), "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for doc_id, z, found in zip(*(batch[c].to_pylist() for c in ("doc_id", "z", "spans")), strict=True):
                data = open_.decompress(z)
                gone = union([(s["start"], s["stop"]) for s in found or ()])
                edges = [0, *(x for s in gone for x in s), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((doc_id, len(data), len(data) - len(kept), len(gone), kept))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            types = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    joined = _with_texts(keyed, spans, "left").select("doc_id", "z", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
