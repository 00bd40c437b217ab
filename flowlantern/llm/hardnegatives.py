"""Hard negatives by a vertical scan over columnar fragments.

Rows are kept as fragments: a bounded number of rows stored dimension by dimension, with the least and largest value
of each. For an anchor, the dimensions of a fragment are read in the order of the anchor's largest components first.
After every step a row's product lies between its partial sum plus the least and plus the largest contribution the
unread dimensions can still make; rows whose interval misses all windows leave the candidate bitmap, and rows that are
sure to lie in a window raise its floor to the k-th best of them. What is left at the end has exact products.

Two passes use the same scan: the best rows of the anchor's own label are its positives (one window without ends);
each positive's score then gives a window of scores for rows of other labels. Blocks of anchors and fragments are
bounded, every meeting of the two is one small group, and only the best rows of a meeting are handed on. A fragment
whose longest row cannot reach what a block asks for is left out before it is sent anywhere.

Defined cases: rows whose id, label or vector is NULL, or whose vector has a NULL, NaN or infinite component, take no
part. Shorter vectors count as padded with zeros. All rows with the anchor's id are the anchor itself; otherwise rows
that repeat an id or a vector are rows of their own, as anchors and as candidates. An anchor without positives, or a
positive without rows in its window, has no rows. Products are exact; beyond a long they are held within it. Other
columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlantern.llm.common import stored

FRAGMENT = 1 << 20  # cells of a fragment
BLOCK = 1 << 16  # cells of a block of anchors
STEP = 8  # dimensions between two looks at the bitmap
LONG = 2**63 - 1
PACKED = "part long, no long, least_label long, most_label long, longest double, kind string, ids binary, labels binary, cells binary"


def _rows(vectors: DataFrame) -> DataFrame:
    whole = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("v"))
    return rows.where(fine)


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of lists as a matrix, shorter ones padded with zeros."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    cells = np.zeros((len(sizes), int(sizes.max(initial=0))))
    cells[np.arange(cells.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return cells


def _packed(rows: DataFrame, scale: int, cells: int) -> DataFrame:
    """Fragments of at most ``cells`` cells (one row at least), near in label, with components floor(scale * x)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, layout = TaskContext.get().partitionId(), 0, _layout()
        for batch in batches:
            ids, labels = (batch[c].to_numpy(zero_copy_only=False).astype("<i8") for c in ("vec_id", "label"))
            matrix = np.floor(_matrix(batch["v"]) * scale)
            size = max(1, cells // max(1, matrix.shape[1]))
            for at in range(0, len(ids), size):
                own, some = slice(at, at + size), matrix[at : at + size]
                top = np.abs(some).max(initial=0)
                kind = "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<f8"
                row = [part, no, int(labels[own].min()), int(labels[own].max())]
                row += [float(np.sqrt((some * some).sum(axis=1)).max(initial=0)), kind]
                row += [ids[own].tobytes(), labels[own].tobytes(), np.ascontiguousarray(some.T).astype(kind).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, layout, strict=True)], schema=layout)
                no += 1

    spread = F.xxhash64("vec_id", "v")
    rows = rows.repartitionByRange("label", spread).sortWithinPartitions("label", spread, "vec_id")
    return rows.mapInArrow(pack, PACKED)


def _layout() -> pa.Schema:
    """PACKED for Arrow."""
    kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in PACKED.split(", "))])


def _unpacked(ids: bytes, labels: bytes, kind: str, cells: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, labels and values by dimension."""
    ids = np.frombuffer(ids, "<i8")
    return ids, np.frombuffer(labels, "<i8"), np.frombuffer(cells, kind).reshape(-1, len(ids)).astype(float)


def _exact(columns: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with the same number of dimensions, as doubles where all sums are exact, else as whole numbers."""
    wide = max(len(columns), len(queries))
    columns, queries = (np.pad(x, ((0, wide - len(x)), (0, 0))) for x in (columns, queries))
    if wide * np.abs(columns).max(initial=0) * np.abs(queries).max(initial=0) < 2**52:
        return columns, queries
    whole = np.frompyfunc(int, 1, 1)
    return whole(columns).astype(object), whole(queries).astype(object)


def scan(
    columns: np.ndarray, query: np.ndarray, ends: np.ndarray, alive: np.ndarray, windows: list[tuple[float, float]], k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the bitmap ``alive`` that may be among the ``k`` best of any window (floor, ceiling), with products.

    ``columns`` has a row for each dimension, ``ends`` the least and largest value of each.
    """
    order = np.argsort(-np.abs(query), kind="stable")
    reach = query * ends
    reach = np.array([np.minimum(*reach), np.maximum(*reach)])[:, order]
    rest = np.zeros((2, len(order) + 1), reach.dtype)  # what the dimensions from a place on add at least and at most
    rest[:, :-1] = np.cumsum(reach[:, ::-1], axis=1)[:, ::-1]
    floors, rows = [w[0] for w in windows], np.flatnonzero(alive)
    partial = np.zeros(len(rows), columns.dtype)
    for at in range(0, len(order) + 1, STEP):
        least, most = partial + rest[0, at], partial + rest[1, at]
        keep = np.zeros(len(rows), bool)
        for w, (_, ceiling) in enumerate(windows):
            sure = least[(least >= floors[w]) & (most <= ceiling)]
            if len(sure) >= k:
                floors[w] = max(floors[w], np.sort(sure)[-k])
            keep |= (most >= floors[w]) & (least <= ceiling)
        if not keep.all():
            rows, partial = rows[keep], partial[keep]
        if not len(rows):
            break
        dims = order[at : at + STEP]
        if len(dims):
            partial = partial + query[dims] @ (columns[dims] if len(rows) == columns.shape[1] else columns[np.ix_(dims, rows)])
    else:
        if len(order) % STEP:  # the last dimensions were read behind the last look
            keep = np.zeros(len(rows), bool)
            for floor, (_, ceiling) in zip(floors, windows, strict=True):
                keep |= (partial >= floor) & (partial <= ceiling)
            rows, partial = rows[keep], partial[keep]
    return rows, partial


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


FOUND = "block_part long, block_no long, i long, anchor_id long, p long, positive_id long, positive_score long, found_id long, score long"


def _search(fragments: DataFrame, blocks: DataFrame, k: int, low: int, high: int, other: bool) -> DataFrame:
    """The ``k`` best rows of each meeting of a block and a fragment, for each anchor (``other``: each positive)."""
    fields = [c.split() for c in FOUND.split(", ")]
    layout = pa.schema([(name, pa.int64()) for name, _ in fields])

    def meet(table: pa.Table) -> pa.Table:
        found = []
        for row in table.to_pylist():
            ids, labels, columns = _unpacked(row["ids"], row["labels"], row["kind"], row["cells"])
            asked, own, queries = _unpacked(row["asked_ids"], row["asked_labels"], row["asked_kind"], row["asked_cells"])
            columns, queries = _exact(columns, queries)
            ends = np.array([columns.min(axis=1), columns.max(axis=1)]) if len(columns) else np.zeros((2, 0))
            wanted: dict[int, list] = {}
            for x in row["positives"] or ():
                wanted.setdefault(x["i"], []).append((x["p"], x["id"], x["score"]))
            for i in range(len(asked)):
                alive = (labels != own[i]) if other else (labels == own[i])
                alive &= ids != asked[i]
                goals = wanted.get(i, ()) if other else [(0, 0, 0)]
                # low * positive <= 100 * negative <= high * positive, in whole numbers
                goals = [g for g in goals if not other or -(-low * g[2] // 100) <= high * g[2] // 100]
                windows = [(-(-low * s // 100), high * s // 100) if other else (-np.inf, np.inf) for _, _, s in goals]
                if not goals or not alive.any():
                    continue
                rows, scores = scan(columns, queries[:, i], ends, alive, windows, k)
                for (p, positive, s), (floor, ceiling) in zip(goals, windows, strict=True):
                    inside = np.flatnonzero((scores >= floor) & (scores <= ceiling))
                    for b in inside[_best(ids[rows[inside]], scores[inside], k)]:
                        score = max(min(int(scores[b]), LONG), -LONG - 1)
                        found.append((row["block_part"], row["block_no"], i, int(asked[i]), p, positive, s, int(ids[rows[b]]), score))
        columns = zip(*found, strict=True) if found else [()] * len(layout)
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=layout)

    # every block meets every fragment that may matter: fragments are numbered within the tasks that packed them
    sizes = fragments.groupBy("part").agg(F.max("no").alias("last"))  # a row for each task
    tasks = fragments.agg(F.max("part")).first()[0]
    if tasks is None:
        return fragments.sparkSession.createDataFrame([], FOUND)
    pairs = blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tasks).cast("long"))))
    pairs = pairs.join(sizes, "part").withColumn("no", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).drop("last")
    overlap = (F.col("least_label") <= F.col("asked_most")) & (F.col("asked_least") <= F.col("most_label"))
    one = (F.col("least_label") == F.col("asked_most")) & (F.col("asked_least") == F.col("most_label"))
    near = F.col("longest") * F.col("asked_longest") >= F.col("need")
    pairs = pairs.join(fragments, ["part", "no"]).where((~one & near) if other else overlap)
    return pairs.groupBy("part", "no", "block_part", "block_no").applyInArrow(meet, FOUND)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors``: vec_id, embedding, label. Anchors are the rows whose id is divisible by ``every``; each has its best
    ``positives`` rows of its label, and for each of these the best ``negatives`` rows of other labels whose score is
    between ``low`` and ``high`` per cent of the positive's. Ties go to the smaller id.
    """
    rows = _rows(vectors)
    fragments = stored(_packed(rows, scale, FRAGMENT), "fragments")
    blocks = stored(_packed(rows.where(F.col("vec_id") % every == 0), scale, BLOCK), "anchors")
    blocks = blocks.select(
        F.col("part").alias("block_part"),
        F.col("no").alias("block_no"),
        F.col("least_label").alias("asked_least"),
        F.col("most_label").alias("asked_most"),
        F.col("longest").alias("asked_longest"),
        *[F.col(c).alias(f"asked_{c}") for c in ("kind", "ids", "labels", "cells")],
    )
    none = F.lit(None).cast("array<struct<i: long, p: long, id: long, score: long>>")
    same = _search(fragments, blocks.withColumn("positives", none), positives, low, high, other=False)
    same = stored(_first(same, ["block_part", "block_no", "i"], positives), "positives")
    goal = F.struct("i", F.col("rank").cast("long").alias("p"), F.col("found_id").alias("id"), "score")
    goals = same.groupBy("block_part", "block_no").agg(F.collect_list(goal).alias("positives"), F.min("score").alias("need"))
    # a negative needs low per cent of the least positive; the margin covers rounding of the lengths
    asked = blocks.join(goals, ["block_part", "block_no"]).withColumn("need", F.col("need") * (low / 100 * (1 - 1e-9)) - 1)
    found = _search(fragments, stored(asked, "asked"), negatives, low, high, other=True)
    found = _first(found, ["block_part", "block_no", "i", "p"], negatives)
    return found.select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("found_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
