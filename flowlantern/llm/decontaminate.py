"""Benchmark decontamination: a prefix-filtered join of word shingles, all in DataFrame expressions.

An item is cut into windows of consecutive words, a window into shingles of three words (fewer if it is shorter). A
window lies in a document only if each of its shingles does, so one is enough to look for: the rarest by its count
over all documents. Where that shingle occurs in a document, its place in the window gives the window's place; a
place that does not fit into the document is dropped, and the words there are compared with the window's.

The windows are broadcast in parts of at most ``BROADCAST_BYTES``; a larger benchmark takes more than one pass.

Defined cases: a NULL or empty text has no words. Items without id or words take no part; texts under one id count as
one item. Windows shared by items are compared once. Documents are told apart by id and text; a row that repeats both
is returned as often as it occurs. A NULL document id is kept.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlantern.llm.common import stored

WINDOW = 13
SHINGLE = 3
SHARE = 20  # contaminated if a document's hit words times this reach its words
BROADCAST_BYTES = 64 << 20
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case and other letters as they are."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")


def _shingle(tokens: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(tokens, at + i) for i in range(size)])


def _windows(items: DataFrame, size: int) -> DataFrame:
    """Distinct windows with the ids of their items."""
    cut = items.where(F.col("item_id").isNotNull()).select("item_id", words(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    cut = cut.where(F.size("w") > 0).select("item_id", "w", F.explode(starts).alias("i"))
    cut = cut.select("item_id", F.slice("w", F.col("i") + 1, F.lit(size)).alias("window"))
    return cut.groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def _positions(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """A row for each shingle of a document, and one more with ``token`` 0 and ``pos`` -1.

    Hashes are taken after the words were listed, in compiled code; the shingles at the end of a text that lack words
    match no window.
    """
    tokens = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("w"))
    rows = tokens.withColumn("size", F.explode(F.array(*map(F.lit, sizes))) if len(sizes) > 1 else F.lit(max(sizes, default=1)))
    listed = F.posexplode(F.concat("w", F.array(F.lit("")))).alias("p", "word")  # the last one marks the end
    rows = rows.select("*", listed)
    at, end = F.col("p"), F.col("p") == F.size("w")
    token = F.lit(None)
    for size in sizes or [1]:
        rest = [F.get("w", at + i) for i in range(1, size)]
        token = F.when(F.col("size") == size, F.xxhash64("word", *rest)).otherwise(token)
    rows = rows.where(~end | (F.col("size") == (sizes or [1])[0]))
    return rows.withColumn("token", F.when(end, F.lit(0)).otherwise(token)).withColumn("pos", F.when(end, -1).otherwise(at)).drop("p", "word", "size")


def _anchors(docs: DataFrame, windows: DataFrame, sizes: list[int], parts: int) -> DataFrame:
    """Each window with its rarest shingle and that shingle's offset."""
    span = F.least(F.size("window"), F.lit(SHINGLE))
    offsets = F.sequence(F.lit(0), F.size("window") - span)
    cut = windows.select("window", "items", F.explode(offsets).alias("offset"))
    by_size = [F.when(span == k, _shingle(F.col("window"), F.col("offset"), k)) for k in sizes]
    cut = cut.withColumn("token", F.coalesce(*by_size))
    wanted = cut.select("token").distinct()
    places = _positions(docs, sizes).where(F.col("pos") >= 0).select("token")
    hits = [places.join(F.broadcast(part), "token") for part in _parts(wanted, "token", parts)]  # bounded: see _parts
    counts = reduce(DataFrame.union, hits).groupBy("token").agg(F.count("*").alias("n"))
    order = F.struct(F.coalesce("n", F.lit(0)), "offset")
    best = cut.join(counts, "token", "left").groupBy("window", "items")
    best = best.agg(F.min_by(F.struct("offset", "token"), order).alias("best"))
    return best.select("window", "items", "best.offset", "best.token")


def _parts(table: DataFrame, key: str, parts: int) -> list[DataFrame]:
    """``table`` in slices, so that each is small enough to broadcast."""
    return [table.where(F.pmod(F.xxhash64(key), F.lit(parts)) == i) for i in range(parts)] if parts > 1 else [table]


def _covered(spans: str) -> Column:
    """Words in the union of (start, stop) spans."""
    total = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("reach")),
        lambda a, s: F.struct(
            (a.sum + F.greatest(s.stop - F.greatest(s.start, a.reach), F.lit(0))).alias("sum"),
            F.greatest(a.reach, s.stop).alias("reach"),
        ),
        lambda a: a.sum,
    )
    return total.cast("long")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, n_items, item_ids, contaminated for every row of ``docs`` (doc_id, text)."""
    windows = stored(_windows(items, window), "windows")
    weight = F.sum(F.aggregate("window", F.lit(0), lambda a, w: a + 24 + F.octet_length(w)) + 8 * F.size("items") + 64)
    facts = windows.agg(weight.alias("bytes"), F.collect_set(F.least(F.size("window"), F.lit(SHINGLE))).alias("sizes"))
    size, sizes = facts.first()
    sizes = sorted(sizes)
    parts = 1 + (size or 0) // BROADCAST_BYTES
    anchors = stored(_anchors(docs, windows, sizes, parts), "anchors") if sizes else None
    none = "array<string>"
    rows = _positions(docs, sizes)
    ends = rows.where(F.col("pos") < 0)
    own = ["doc_id", "text_key", F.size("w").alias("n_words")]
    if anchors is None:
        found = ends.select(*own, F.lit(-1).alias("start"), F.lit(-1).alias("stop"), F.lit(None).cast("array<long>").alias("items"))
    else:
        start = F.col("pos") - F.col("offset")
        stop = start + F.size("window")
        fits = F.when(
            (start >= 0) & (stop <= F.size("w")),
            F.slice("w", F.greatest(start, F.lit(0)) + 1, F.size("window")) == F.col("window"),
        )
        mark = anchors.select(
            F.lit(None).cast(none).alias("window"),
            F.lit(None).cast(anchors.schema["items"].dataType).alias("items"),
            F.lit(0).alias("offset"),
            F.lit(0).cast("long").alias("token"),
        ).limit(1)
        slices = _parts(anchors, "token", parts)
        slices[0] = slices[0].union(mark)
        matched = [rows.join(F.broadcast(part), "token") for part in slices]  # bounded: see _parts
        ended = (F.col("pos") < 0) & F.col("window").isNull()
        found = reduce(DataFrame.union, [m.where(ended | ((F.col("pos") >= 0) & fits)) for m in matched])
        found = found.select(*own, F.when(ended, -1).otherwise(start).alias("start"), F.when(ended, -1).otherwise(stop).alias("stop"), "items")
    hit = F.col("start") >= 0
    per = found.groupBy("doc_id", "text_key", "n_words").agg(
        F.count(F.when(~hit, 1)).alias("copies"),
        F.collect_set(F.when(hit, F.struct("start", "stop"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set(F.when(hit, F.col("items"))))).alias("items"),
    )
    n_hit = _covered("spans")
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    result = per.select(
        "doc_id",
        "text_key",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        ids.alias("item_ids"),
        F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")
    return result.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated, with all their columns."""
    bad = contamination(docs, items, window).where("contaminated").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
    return docs.join(bad.distinct(), same, "left_anti")
