"""Batch jobs over stored tables: refinement, audit and the dashboard view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlantern.operators import flows, ids
from flowlantern.sources.readers import read_table
from flowlantern.sources.writers import write_table


def _bronze(spark: SparkSession, path: str) -> DataFrame:
    """The bronze table; without a single VLAN its partition column has no type of its own."""
    table = read_table(spark, path)
    return table.withColumn("vlan", table["vlan"].cast("int"))


def refine_silver(spark: SparkSession, bronze: str, silver: str, dedupe: str = "row", dynamic: bool = False) -> None:
    """Rewrites the silver table; ``dynamic`` replaces only the VLANs found in ``bronze``."""
    write_table(flows.clean_flows(_bronze(spark, bronze), dedupe), silver, ["vlan"], dynamic=dynamic, rebalance=True)


def refine_gold(spark: SparkSession, silver: str, gold: str, **thresholds: float) -> DataFrame:
    """Rewrites the gold table and returns it as stored, so that a look at it does not compute it again."""
    features = flows.gold_features(_bronze(spark, silver))
    write_table(flows.label_behaviour(features, **thresholds), gold)
    return read_table(spark, gold)


def refine(spark: SparkSession, bronze: str, silver: str, gold: str, dedupe: str = "row") -> DataFrame:
    refine_silver(spark, bronze, silver, dedupe)
    return refine_gold(spark, silver, gold)


def audit(spark: SparkSession, bronze: str, newest: int = 20) -> dict[str, DataFrame]:
    """What a bronze table holds: its size, the newest rows and the volume per VLAN."""
    table = _bronze(spark, bronze)
    return {
        "total": flows.bronze_total(table),
        "latest": flows.latest(table, newest),
        "volume_by_vlan": flows.volume_by_vlan(table),
    }


def register_views(trafego: DataFrame, classificados: DataFrame) -> None:
    """Makes ``trafego``, ``classificados`` and ``v_trafego_dash`` known to SQL."""
    trafego.createOrReplaceTempView("trafego")
    classificados.createOrReplaceTempView("classificados")
    ids.traffic_dashboard(trafego, classificados).createOrReplaceTempView("v_trafego_dash")
