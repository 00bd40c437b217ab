"""Small helpers the text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlantern.session import shared_dir


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def held_out(doc_id: str, modulus: int, fold: int) -> Column:
    """Whether the id falls into ``fold``; a row without id is never held out."""
    return F.coalesce(remainder(doc_id, modulus) == fold, F.lit(False))


def stored(table: DataFrame, name: str) -> DataFrame:
    """``table`` written below ``spark.checkpoint.dir`` and read back: later jobs start from the files,
    so neither a lost executor nor a second use runs its plan again."""
    spark = table.sparkSession
    path = shared_dir(spark, name)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
