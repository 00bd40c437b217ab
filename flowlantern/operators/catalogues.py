"""Text catalogues (class, reference and threshold lines) as tables. Input: ``line_no``, ``line``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_CLASS_LINE = r"^\s*config classification:\s*([^,]+),(.*),\s*(\d+)\s*$"
_REFERENCE_LINE = r"^\s*config reference:\s*(\S+)\s+(\S+)\s*$"
_THRESHOLD_LINE = r"^\s*(threshold|event_filter|suppress)\s+\S"


def _group(pattern: str, index: int) -> Column:
    return F.trim(F.regexp_extract("line", pattern, index))


def classification_dim(lines: DataFrame) -> DataFrame:
    """``(line_no, shortname, description, priority)``, the last line of a class wins; comments and blank lines
    give no row."""
    found = lines.filter(F.col("line").rlike(_CLASS_LINE)).select(
        "line_no",
        _group(_CLASS_LINE, 1).alias("shortname"),
        _group(_CLASS_LINE, 2).alias("description"),
        _group(_CLASS_LINE, 3).try_cast("int").alias("priority"),
    )
    return last_by_line(found, "shortname")


def reference_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("line").rlike(_REFERENCE_LINE)).select(
        "line_no", F.lower(_group(_REFERENCE_LINE, 1)).alias("system"), _group(_REFERENCE_LINE, 2).alias("url")
    )


def last_by_line(rows: DataFrame, *key: str) -> DataFrame:
    """The last definition of each key. The rank limit is applied before the shuffle as well, so each
    task sends at most one row per key."""
    newest = Window.partitionBy(*key).orderBy(F.col("line_no").desc())
    return rows.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") == 1).drop("rank")


def reference_dim(lines: DataFrame) -> DataFrame:
    """``(system, url)``, systems in lower case; the last line of a system wins."""
    return last_by_line(reference_lines(lines), "system").select("system", "url")


def threshold_dim(lines: DataFrame) -> DataFrame:
    """Threshold, event_filter and suppress lines as columns; absent settings are NULL."""

    def setting(name: str, value: str = r"[^\s,]+") -> Column:
        return F.nullif(F.regexp_extract("line", rf"[\s,]{name}\s+({value})", 1), F.lit(""))

    return lines.filter(F.col("line").rlike(_THRESHOLD_LINE)).select(
        "line_no",
        _group(_THRESHOLD_LINE, 1).alias("kind"),
        setting("gen_id").try_cast("bigint").alias("gen_id"),
        setting("sig_id").try_cast("bigint").alias("sig_id"),
        setting("type").alias("type"),
        setting("track").alias("track"),
        setting("count").try_cast("int").alias("count"),
        setting("seconds").try_cast("int").alias("seconds"),
        setting("ip", r"\[[^\]]*\]|[^\s,]+").alias("ip"),
    )


def rule_file_names(lines: DataFrame) -> DataFrame:
    """The entries of a YAML list of rule files."""
    entry = r"^\s*- (.*\S)\s*$"
    return lines.filter(F.col("line").rlike(entry)).select("line_no", F.regexp_extract("line", entry, 1).alias("name"))


def distinct_rule_files(lines: DataFrame) -> DataFrame:
    """Each rule file once, with the number of times it is listed."""
    return rule_file_names(lines).groupBy("name").agg(F.count(F.lit(1)).alias("copies"))


def catalogue_diff(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows by which two versions differ, with multiplicity: ``change`` is removed or added.

    One signed count over the union answers both directions of EXCEPT ALL with a single shuffle.
    """
    signed = old.select(*columns, F.lit(1).alias("sign")).unionByName(new.select(*columns, F.lit(-1).alias("sign")))
    balance = signed.groupBy(*columns).agg(F.sum("sign").alias("balance")).filter(F.col("balance") != 0)
    return balance.select(
        *columns,
        F.when(F.col("balance") > 0, "removed").otherwise("added").alias("change"),
        F.abs("balance").alias("copies"),
    )
