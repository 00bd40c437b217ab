"""Detection rules as a text table (``line_no``, ``line``): pruning, disabling, parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# action, protocol, source, source port, arrow, target, target port, options
_PLACE = r"(!?\[[^\]]*\]|\S+)"
_RULE = rf"^\s*([a-z]+)\s+(\S+)\s+{_PLACE}\s+{_PLACE}\s+(->|<>)\s+{_PLACE}\s+{_PLACE}\s+\((.*)\)\s*$"
_HEADER = ["action", "proto", "src", "sport", "direction", "dst", "dport", "options"]


def prune_rules(rules: DataFrame, proto: str = "dnp3") -> DataFrame:
    """Removes rules that mention the protocol as a word or alert on it."""
    line = F.coalesce("line", F.lit(""))
    return rules.filter(~(line.contains(f" {proto} ") | line.startswith(f"alert {proto}")))


def disable_rules(rules: DataFrame, pattern: str = r"alert .*dnp3.*\(.*\)") -> DataFrame:
    """Comments out the lines the pattern is found in (also those already commented out)."""
    return rules.withColumn("line", F.when(F.col("line").rlike(pattern), F.concat(F.lit("#"), "line")).otherwise(F.col("line")))


def parse_rules(rules: DataFrame) -> DataFrame:
    """Active rules as columns; commented and unreadable lines give no row."""
    # One pass over the header: the groups are rewritten with a separator no rule contains.
    fields = F.split(F.regexp_replace("line", _RULE, "\u0001".join(f"${i + 1}" for i in range(len(_HEADER)))), "\u0001")
    active = rules.filter(F.col("line").rlike(_RULE))
    header = active.select("line_no", *[F.get(fields, F.lit(i)).alias(name) for i, name in enumerate(_HEADER)])

    def option(pattern: str) -> Column:
        return F.nullif(F.regexp_extract("options", pattern, 1), F.lit(""))

    return header.select(
        "line_no",
        *_HEADER[:-1],
        option(r'(?:^|(?<!\\);)\s*msg:\s*"((?:[^"\\]|\\.)*)"').alias("msg"),
        option(r"(?:^|(?<!\\);)\s*sid:\s*(\d+)").try_cast("bigint").alias("sid"),
        option(r"(?:^|(?<!\\);)\s*rev:\s*(\d+)").try_cast("int").alias("rev"),
        option(r"(?:^|(?<!\\);)\s*classtype:\s*([^;\s]+)").alias("classtype"),
        F.regexp_extract_all("options", F.lit(r"(?:^|(?<!\\);)\s*reference:\s*([^;]+)"), F.lit(1)).alias("references"),
    )


def unparsed_rules(rules: DataFrame) -> DataFrame:
    """Active lines ``parse_rules`` gives no row for: neither blank, nor a comment, nor readable."""
    return rules.filter(F.col("line").rlike(r"^\s*[^\s#]") & ~F.col("line").rlike(_RULE))


def rule_references(parsed: DataFrame) -> DataFrame:
    """One row per reference of a rule."""
    return parsed.select("sid", F.explode("references").alias("reference"))
