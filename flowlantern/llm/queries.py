"""The operators with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlantern.llm import bpe, contexttree, dartminhash, decontaminate, hardnegatives, langid, quality, spelling, suffixes, surrogates, tokenfiles, topk, toxicity
from flowlantern.llm.common import held_out, read, remainder
from flowlantern.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.NoisyOr:
    return toxicity.train(docs, read(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity_model(spark, docs, sf_dir)
    found = docs.select("doc_id", toxicity.scored("text", model, spark).alias("r"))
    return found.select(
        "doc_id",
        held_out("doc_id", 5, 0).alias("held_out"),
        "r.score",
        (F.col("r.score") >= 0.5).cast("int").alias("predicted"),
        F.size("r.spans").alias("n_suspicious"),
    )


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.train(docs, remainder("doc_id", 4) != 2)
    found = docs.select("doc_id", langid.predicted("text", model, spark).alias("r"))
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "r.*")


BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = bpe.digests("text", public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)
    return read(spark, sf_dir, "documents").select("doc_id", digests.alias("r")).select("doc_id", "r.*")


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


# The words of a text, as decontaminate.words() finds them.
_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
ORACLE["op1_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[p:p + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS p FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw))),
m AS (SELECT doc_id, dw.n, p, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY 1),
t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


WORD_TOKENIZER = "word_bpe_49k.json"
END_ID = 2


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "tokens")
    tokenfiles.write(read(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_TOKENIZER), END_ID)
    return tokenfiles.digests(spark, path)


@query
def op2_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(read(spark, sf_dir, "embeddings"), every=50, k=5)


ORACLE["op2_top_products"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dartminhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_members")


SURROGATE_KEY = b"flowlantern"  # a deployment sets its own


@query
def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    again = surrogates.redrawn(docs, SURROGATE_KEY)
    found = docs.select("doc_id", surrogates.replaced("text", SURROGATE_KEY, again).alias("r"))
    kinds = F.array_join(F.array_sort(F.array_distinct("r.entities.kind")), ",").alias("kinds")
    return found.select("doc_id", "r.text", F.size("r.entities").alias("n_entities"), kinds)


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(read(spark, sf_dir, "documents"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", digest)


@query
def op9_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contexttree.scores(read(spark, sf_dir, "documents"), remainder("doc_id", 10) != 0)
    bits = (-F.col("score") / F.log10(F.lit(2.0)) / (F.col("n_bytes") + 1)).alias("bits_per_byte")
    own = held_out("doc_id", 10, 0).alias("held_out")
    return found.select("doc_id", own, "n_tokens", "n_known", "train_tokens", "base_score", "score", bits)


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    wrong = (F.col("label") + 1) % 10  # some labels are made wrong on purpose
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, wrong).otherwise(F.col("label")))
    return hardnegatives.hard_negatives(vectors, every=100)


ORACLE["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS p FROM s WHERE same),
n AS (
  SELECT anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, p ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE p <= 5 AND NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(misspelt_runs(read(spark, sf_dir, "documents")))


def misspelt_runs(docs: DataFrame) -> DataFrame:
    """The runs of letters of all texts, A-Z in lower case; about one in 97 of them has lost a character."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all("lowered", F.lit("[a-z\u00C0-\u00FF]+"), F.lit(0))
    runs = docs.select("doc_id", lowered.alias("lowered")).select("doc_id", F.explode(found).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    runs = runs.withColumn("h", h)
    lost = F.expr("concat(left(run, CAST(h % length(run) AS INT)), substring(run, CAST(h % length(run) AS INT) + 2))")
    return runs.select(F.when(F.col("h") % 97 == 0, lost).otherwise(F.col("run")).alias("word"))


@query
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, read(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    found = docs.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), quality.scored("text", model, spark).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
