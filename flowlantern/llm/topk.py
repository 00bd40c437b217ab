"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are sorted by length and cut into buckets. For a query of length q with k-th best score t so far, a bucket
whose longest vector has length m can only matter if q * m >= t; its local threshold t / (q * m) is the cosine that a
vector must reach. Within a bucket a low threshold leaves only pruning by length (a run at the bucket's head); a high
one confines the largest coordinates of the vector's direction to intervals around the query's (coordinate pruning).
What is left is verified by its product.

The bucket of the longest vectors is searched first and gives each query its first t; then every block of queries meets
the buckets its bounds allow. Buckets and blocks are bounded, each meeting is one group, results merge per query.

Defined cases: a NULL vector or one with a NULL, NaN or infinite component takes no part, neither does a NULL id. Shorter
vectors count as padded with zeros. Rows that repeat id and vector are one query, but
each is a candidate of others; another vector under the same id is a row of its own, as a query and as a candidate. Products are exact while lengths stay below 2**26; beyond,
they are worked out in whole numbers of any size and held within the range of a long. Pruning keeps a margin of
rounding, so it never drops a vector that could count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlantern.llm.common import stored

BUCKET = 2048
BLOCK = 512
COORDINATES = 6  # intervals checked for a query in a bucket
COSINE = 0.2  # local threshold from which coordinates prune better than lengths
MARGIN = 1e-9
FOUND = "query_id long, block long, i long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, v, norm of the vectors that take part; components become floor(scale * x) as doubles."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("double"))
    whole = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall(whole, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("v"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)))


def _placed(rows: DataFrame, every: int) -> DataFrame:
    """Rows by falling length with their position, and the queries with their position among queries."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, i, asked, last = TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            found = []
            for key in zip(*(batch[c].to_pylist() for c in ("vec_id", "v", "norm")), strict=True):
                # copies of a row stand next to each other; as a query they are one
                last, chosen = key, key != last and key[0] % every == 0
                found.append((part, i, asked if chosen else None, *key))
                i, asked = i + 1, asked + chosen
            columns = zip(*found, strict=True) if found else [()] * len(layout)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, layout, strict=True)], schema=layout)

    layout = pa.schema(
        [("part", pa.int64()), ("i", pa.int64()), ("asked", pa.int64()), ("vec_id", pa.int64())]
        + [("v", pa.list_(pa.float64())), ("norm", pa.float64())]
    )
    order = [F.desc("norm"), F.col("vec_id"), F.col("v")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(rows.mapInArrow(number, "part long, i long, asked long, vec_id long, v array<double>, norm double"), "vectors")
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"), F.count("asked").alias("m"))  # a row for each task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("n", "m")])
    placed = rows.join(F.broadcast(sizes), "part")
    return placed.select("vec_id", "v", "norm", (F.col("i") + F.col("n")).alias("place"), (F.col("asked") + F.col("m")).alias("asked"))


def _packed(rows: DataFrame, key: str) -> DataFrame:
    """The rows of each ``key`` as one row of ids and a matrix; longest and shortest are lengths."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        width = max(map(len, group["v"]))
        m = np.zeros((len(group), width))
        for row, v in zip(m, group["v"], strict=True):
            row[: len(v)] = v
        ids = group["vec_id"].to_numpy("<i8").tobytes()
        ends = [float(group["norm"].max()), float(group["norm"].min())]
        return pd.DataFrame([[int(group[key].iloc[0]), *ends, ids, m.tobytes()]], columns=[key, "longest", "shortest", "ids", "vectors"])

    layout = f"{key} long, longest double, shortest double, ids binary, vectors binary"
    return rows.select(key, "place", "vec_id", "v", "norm").groupBy(key).applyInPandas(pack, layout)


def _products(a: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whole-number products of the rows of ``a`` with ``q``."""
    if np.linalg.norm(q) * (np.sqrt((a * a).sum(axis=1)).max() if len(a) else 0) < 2**52:
        return (a @ q).astype(np.int64)
    big = [[int(x) for x in row] for row in a]
    whole = [int(x) for x in q]
    return np.array([max(min(sum(x * y for x, y in zip(row, whole, strict=True)), 2**63 - 1), -(2**63)) for row in big], np.int64)


def candidates(vectors: np.ndarray, norms: np.ndarray, query: np.ndarray, bound: float) -> np.ndarray:
    """Rows of a bucket (by falling norm) that may reach ``bound``: by length, and by coordinates where the local
    threshold is high."""
    length = float(np.linalg.norm(query))
    if bound <= 0 or not length:
        return np.arange(len(vectors)) if bound <= 0 else np.arange(0)
    slack = bound * (1 - MARGIN) - MARGIN
    if length * norms[0] < slack:
        return np.arange(0)
    local = slack / (length * norms[0])
    head = int(np.searchsorted(-norms, -slack / length, side="right"))  # length >= bound / query's length
    rows = np.arange(head)
    if local < COSINE:
        return rows
    direction = query / length
    spread = np.sqrt(max(1 - local * local, 0.0))
    for c in np.argsort(-np.abs(direction))[:COORDINATES]:
        centre, reach = direction[c] * local, spread * np.sqrt(max(1 - direction[c] ** 2, 0.0)) + 1e-6
        # cosine >= local confines a coordinate of the unit vector; only the side towards the query always binds
        x = vectors[rows, c] / np.maximum(norms[rows], 1e-300)
        if direction[c] >= 0:
            rows = rows[x >= centre - reach]
        else:
            rows = rows[x <= centre + reach]
    return rows


def _search(pair: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best rows of one bucket for each query of one block that may have any."""
    pair = pair.iloc[0]
    ids, asked = np.frombuffer(pair["ids"], "<i8"), np.frombuffer(pair["asked_ids"], "<i8")
    vectors = np.frombuffer(pair["vectors"]).reshape(len(ids), -1)
    queries = np.frombuffer(pair["asked_vectors"]).reshape(len(asked), -1)
    width = max(vectors.shape[1], queries.shape[1])
    vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
    queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    bounds = np.full(len(asked), -np.inf)
    for known in pair["bounds"] if pair["bounds"] is not None else ():
        bounds[known["i"]] = known["score"]
    found = []
    for i, (own, query) in enumerate(zip(asked, queries, strict=True)):
        rows = candidates(vectors, norms, query, bounds[i])
        rows = rows[ids[rows] != own]
        if len(rows):
            scores = _products(vectors[rows], query)
            best = np.lexsort((ids[rows], -scores))[:k]
            found += [(int(own), pair["block"], i, int(ids[rows[b]]), int(scores[b])) for b in best]
    return pd.DataFrame(found, columns=["query_id", "block", "i", "vec_id", "score"]).astype("int64")


def _meet(pairs: DataFrame, buckets: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Searches each (bucket, block) pair; a group holds one bucket and one block."""
    names = {"ids": "asked_ids", "vectors": "asked_vectors"}
    asked = blocks.withColumnsRenamed(names).drop("longest", "shortest", "need")
    both = pairs.select("bucket", "block").join(buckets, "bucket").join(asked, "block")
    return both.groupBy("bucket", "block").applyInPandas(lambda pair: _search(pair, k), FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("block", "i").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_products(vectors: DataFrame, every: int = 50, k: int = 5, bucket: int = BUCKET) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest products of each row whose id is divisible by ``every`` with
    the other rows of ``vectors`` (vec_id, embedding), ties to the smaller id."""
    placed = stored(_placed(quantised(vectors), every), "placed")
    buckets = placed.withColumn("bucket", F.floor(F.col("place") / bucket))
    buckets = stored(_packed(buckets, "bucket"), "buckets")
    blocks = placed.where(F.col("asked").isNotNull()).withColumn("block", F.floor(F.col("asked") / BLOCK))
    blocks = stored(_packed(blocks, "block"), "blocks")
    none = F.lit(None).cast("array<struct<i: long, score: long>>")
    head = blocks.select("block", F.lit(0).cast("long").alias("bucket"))
    first = stored(_best(_meet(head, buckets, blocks.withColumn("bounds", none), k), k), "first")
    # a query needs products of at least its k-th best so far; a block what its least demanding query needs
    kth = first.where(F.col("rank") == k).groupBy("block")
    kth = kth.agg(F.collect_list(F.struct("i", "score")).alias("bounds"), F.min("score").alias("least"), F.count("*").alias("n"))
    bounded = blocks.join(kth, "block", "left")
    settled = (F.col("n") * 8 == F.octet_length("ids")) & (F.col("least") > 0)
    need = F.when(settled, F.col("least") / F.col("longest") * (1 - MARGIN))
    bounded = stored(bounded.withColumn("need", F.coalesce(need, F.lit(-1.0))).drop("n", "least"), "bounded")
    marks = bounded.select("block", "need")
    pairs = buckets.where(F.col("bucket") > 0).select("bucket", "longest").join(marks, F.col("longest") >= F.col("need"))
    found = _best(first.drop("rank").union(_meet(pairs, buckets, bounded, k)), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
