"""Directed port pairs and their published ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from harborline.operators.ranking import rank_within

PAIR = ("from_portid", "to_portid")


def ranked_pairs(connections: DataFrame) -> DataFrame:
    """Port pairs with their rank by capacity among those of either port."""
    capacity = "daily_capacity_at_risk"
    ranked = rank_within(connections, "from_portid", capacity, "to_portid", "rank_from_port")
    return rank_within(ranked, "to_portid", capacity, "from_portid", "rank_to_port")


def connection_mart(connections: DataFrame, ports: DataFrame) -> DataFrame:
    """Port pairs ranked by capacity at each end, with the far continent and a domestic flag.

    The flag is NULL where either country is unknown.
    """
    capacity = "daily_capacity_at_risk"
    far = ports.select(F.col("portid").alias("to_portid"), F.col("continent").alias("to_continent"))
    return ranked_pairs(connections).join(far, "to_portid", "left").select(
        "from_portid", "from_portname", "from_country", "from_iso3",
        "to_portid", "to_portname", "to_country", "to_iso3", "to_continent",
        "average_transit_days", capacity, "relative_capacity_at_risk",
        (F.col("from_iso3") == F.col("to_iso3")).alias("is_domestic"),
        "rank_from_port", "rank_to_port",
    )
