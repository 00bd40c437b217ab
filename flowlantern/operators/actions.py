"""Response actions: documents with commands and how to undo them, judged against an allow-list.

A document is one row (``doc_id``, ``body``) and stays one until its items are listed, so none of the
jobs here needs a shuffle. Commands are data; nothing is executed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlantern.schemas import ACTION_JSON

# Commands a host accepts. The strict list also knows nft and wants a space after the word.
LOOSE_ALLOWED = r"^(iptables|pkill|usermod|chmod|kill|firewall-cmd)"
STRICT_ALLOWED = r"^(nft|iptables|pkill|usermod|chmod|kill|firewall-cmd)\s"
ALLOWED = {"prefix": LOOSE_ALLOWED, "word": STRICT_ALLOWED}


def valid_actions(documents: DataFrame) -> DataFrame:
    """Documents whose whole body is one JSON value."""
    return documents.filter(F.try_parse_json("body").isNotNull())


def _texts() -> Column:
    """The items of an array, or the values of an object, as JSON text with their positions."""
    values = F.coalesce(F.from_json("body", "array<string>"), F.map_values(F.from_json("body", "map<string,string>")))
    return F.transform(values, lambda text, pos: F.struct(pos.alias("pos"), text.alias("text")))


def _is_object(entry: Column) -> Column:
    return F.coalesce(entry["text"].startswith("{"), F.lit(False))


def _items() -> Column:
    """(pos, item) of the items that are objects; each is read on its own."""
    read = F.filter(_texts(), _is_object)
    return F.transform(read, lambda e: F.struct(e["pos"].alias("pos"), F.from_json(e["text"], ACTION_JSON).alias("item")))


def odd_items(documents: DataFrame) -> DataFrame:
    """Items that are no objects and hence no actions: ``doc_id, pos, text``."""
    odd = F.filter(_texts(), lambda entry: ~_is_object(entry))
    return documents.select("doc_id", F.inline(odd))


def actions(documents: DataFrame) -> DataFrame:
    """One row per item: ``doc_id, pos, comando, desfazer``. A missing key reads as the text ``null``; items that
    are no objects are left out, see ``odd_items``."""
    listed = documents.select("doc_id", F.inline(_items()))
    return listed.select(
        "doc_id",
        "pos",
        F.coalesce("item.comando", F.lit("null")).alias("comando"),
        F.coalesce("item.desfazer", F.lit("null")).alias("desfazer"),
    )


def _verdict(command: Column, mode: str) -> Column:
    return F.when(command.rlike(ALLOWED[mode]), "allowed").otherwise("denied")


def action_verdict(items: DataFrame, mode: str = "prefix", column: str = "comando") -> DataFrame:
    """Adds ``verdict`` to the non-empty commands (``column="desfazer"`` judges the undo commands)."""
    command = F.col(column)
    return items.filter(command != "").withColumn("verdict", _verdict(command, mode))


def strict_prefix(documents: DataFrame) -> DataFrame:
    """Commands that run when the first denied one stops its document.

    The first denied position is found inside the item array, so a long document is neither exploded
    twice nor gathered by a window.
    """

    def stops(item: Column) -> Column:
        command = F.coalesce(item["item"]["comando"], F.lit("null"))
        return (command != "") & ~command.rlike(STRICT_ALLOWED)

    bodies = documents.select("doc_id", F.inline(F.array(F.struct(_items().alias("items")))))
    first = F.array_position(F.transform("items", stops), True)
    run = F.when(first > 0, F.slice("items", F.lit(1), (first - 1).cast("int"))).otherwise(F.col("items"))
    listed = bodies.select("doc_id", F.inline(run))
    return listed.select("doc_id", "pos", F.col("item.comando").alias("comando")).filter(F.col("comando") != "")
