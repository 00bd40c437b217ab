"""Derived measures, keys and clock parts shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def aligned(number: Column, width: int) -> Column:
    """Start of the interval of ``width`` a whole number falls into, in whole numbers throughout."""
    return number - F.pmod(number, F.lit(width).cast("bigint"))


def bytes_per_packet(total_bytes: Column | str, total_packets: Column | str) -> Column:
    """Ratio with two decimals; NULL instead of an error for zero packets."""
    return F.round(F.try_divide(total_bytes, total_packets), 2)


def behaviour_label(unique_ports: Column, ratio: Column, min_ports: int = 10, max_ratio: float = 100) -> Column:
    """Many ports and small packets mark a scanner. Both bounds are strict; a NULL ratio is normal."""
    return F.when((unique_ports > min_ports) & (ratio < max_ratio), "ANOMALIA_BOTNET").otherwise("NORMAL")


def utc_parts(moment: Column) -> dict[str, Column]:
    """Hour, minute, second and date of an instant in UTC, whatever the session time zone is."""
    second_of_day = F.pmod(F.unix_seconds(moment), F.lit(86400))
    return {
        "hour": F.floor(second_of_day / 3600).cast("int"),
        "minute": F.floor(F.pmod(second_of_day, F.lit(3600)) / 60).cast("int"),
        "seconds": F.pmod(second_of_day, F.lit(60)).cast("int"),
        "event_date": F.date_from_unix_date(F.floor(F.unix_seconds(moment) / 86400).cast("int")),
    }


def row_hash(*parts: Column | str) -> Column:
    """SHA-256 over the parts, each written as its length, a colon and its text, or as ``-`` when it is NULL: different
    parts never give one text, whatever characters they hold."""
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    written = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*written), 256)
