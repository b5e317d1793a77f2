"""The test tables in the shapes of the landed data and of the stored tables.

Suppliers stand in for ports, nations for countries, order lines for daily vessel
calls, and yearly order totals for container traffic. The oddities (unreadable
coordinates, unreported years, unknown countries, legs from a port to itself) are
put in on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harborline.operators.calls import roll_up_months
from harborline.session import stage
from harborline.sources.schemas import VESSEL_TYPES

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PAGE_RECORDS = 400

# Stated, so that opening a table costs no job to find its columns out.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, event_type string, value double, props string",
}


class Tables:
    """The driver's tables and the views over them; nothing runs until a result is asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(COLUMNS[name]).parquet(f"{self.folder}/{name}.parquet")

    # ---- country reference and traffic ---------------------------------------

    def country_records(self) -> DataFrame:
        regions = self.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return self.table("nation").join(regions, "n_regionkey").selectExpr(
            "n_name AS id",
            "substring(n_name, 1, 2) AS iso2Code",
            "n_name AS name",
            """named_struct('id', CAST(n_regionkey AS STRING), 'value', CASE
                 WHEN r_name = 'MIDDLE EAST' THEN 'Aggregates' WHEN n_nationkey <> 20 THEN r_name END) AS region""",
            "n_name AS capitalCity",
            """CASE WHEN n_nationkey % 5 = 0 THEN '' WHEN n_nationkey % 7 = 0 THEN 'n/a'
                 ELSE CAST(n_nationkey AS STRING) END AS longitude""",
            "CAST(n_nationkey AS STRING) AS latitude",
            "n_nationkey AS nationkey",
        )

    def traffic_records(self) -> DataFrame:
        orders = self.table("orders").selectExpr(
            "o_custkey AS c_custkey", "year(o_orderdate) AS year", "CAST(o_totalprice AS DECIMAL(18,2)) AS price"
        )
        customers = self.table("customer").selectExpr("c_custkey", "c_nationkey AS n_nationkey")
        sums = orders.join(customers, "c_custkey").groupBy("n_nationkey", "year").agg(F.sum("price").alias("total"))
        nations = self.table("nation").select("n_nationkey", "n_name")
        return sums.join(nations, "n_nationkey").selectExpr(
            "named_struct('id', n_nationkey, 'value', n_name) AS country",
            "n_name AS countryiso3code",
            "CAST(year AS STRING) AS date",
            "CASE WHEN (n_nationkey + year) % 11 <> 0 THEN CAST(total AS DOUBLE) END AS value",
        )

    # ---- ports, calls, connections --------------------------------------------

    def port_records(self) -> DataFrame:
        nations = self.table("nation").withColumnRenamed("n_nationkey", "s_nationkey")
        regions = self.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return self.table("supplier").join(nations, "s_nationkey").join(regions, "n_regionkey").selectExpr(
            "s_suppkey AS portid", "s_name AS portname", "n_name AS country", "n_name AS ISO3", "r_name AS continent",
            "s_acctbal AS lat", "s_acctbal AS lon", "concat('L', s_suppkey) AS LOCODE",
            "CAST(floor(s_acctbal) AS DOUBLE) AS vessel_count_total",
        )

    def ports(self) -> DataFrame:
        return self.port_records().select(
            "portid", "portname", "country", F.col("ISO3").alias("country_iso3"), "continent"
        )

    def daily_calls(self, day: str = "l_shipdate") -> DataFrame:
        """One call for each order line, on its ship date or another date of the line or order."""
        lines, orders = self.table("lineitem"), self.table("orders")
        dated = [f"year({day}) AS year", f"month({day}) AS month"]
        lines = lines.selectExpr(
            "l_orderkey AS o_orderkey", "l_suppkey AS portid", *(dated if day in lines.columns else [])
        )
        orders = orders.selectExpr("o_orderkey", "o_orderpriority", *(dated if day in orders.columns else []))
        flags = [
            f"CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END AS portcalls_{t}"
            for t, p in zip(VESSEL_TYPES, PRIORITIES)
        ]
        return lines.join(orders, "o_orderkey").selectExpr("portid", "year", "month", *flags, "1 AS portcalls")

    def calls_monthly(self) -> DataFrame:
        return roll_up_months(self.daily_calls())

    def stored_calls(self) -> DataFrame:
        """The monthly table as stored, one folder per year, for queries that use it more than once."""
        return stage(self.calls_monthly(), "calls", ("calls_year",))

    def connections(self) -> DataFrame:
        """Pairs of nations, supplier side to customer side.

        Lines are reduced to (supplier, customer nation) before the supplier join, so a
        supplier with very many lines is a handful of rows by then.
        """
        orders = self.table("orders").selectExpr("o_orderkey", "o_custkey AS c_custkey")
        buyers = orders.join(self.table("customer").select("c_custkey", "c_nationkey"), "c_custkey")
        lines = self.table("lineitem").selectExpr(
            "l_orderkey AS o_orderkey", "l_suppkey AS s_suppkey", "l_linenumber", "CAST(l_quantity AS DECIMAL(18,2)) AS quantity"
        )
        per_supplier = lines.join(buyers.select("o_orderkey", "c_nationkey"), "o_orderkey").groupBy(
            "s_suppkey", "c_nationkey"
        ).agg(F.min("l_linenumber").alias("days"), F.sum("quantity").alias("quantity"))
        suppliers = self.table("supplier").select("s_suppkey", "s_nationkey")
        pairs = per_supplier.join(suppliers, "s_suppkey").groupBy("s_nationkey", "c_nationkey").agg(
            F.min("days").alias("days"), F.sum("quantity").alias("quantity")
        )
        near = self.table("nation").toDF("s_nationkey", "from_name", "from_region")
        far = self.table("nation").toDF("c_nationkey", "to_name", "to_region")
        named = pairs.join(near, "s_nationkey").join(far, "c_nationkey").selectExpr(
            "s_nationkey AS from_portid", "from_name AS from_portname", "from_name AS from_country",
            "CASE WHEN s_nationkey <> 24 THEN CAST(from_region AS STRING) END AS from_iso3",
            "c_nationkey AS to_portid", "to_name AS to_portname", "to_name AS to_country",
            "CAST(to_region AS STRING) AS to_iso3",
            "CAST(days - 1 AS DOUBLE) AS average_transit_days",
            """CASE WHEN (s_nationkey * 25 + c_nationkey) % 50 <> 7 THEN CAST(quantity AS BIGINT) END
                 AS daily_capacity_at_risk""",
        )
        return named.selectExpr("*", "daily_capacity_at_risk / 100.0D AS relative_capacity_at_risk")

    def stored_connections(self) -> DataFrame:
        return stage(self.connections(), "connections")


# ---- landed pages out of records ------------------------------------------------


def indicator_bodies(records: DataFrame, page: Column) -> DataFrame:
    """Records as ``[meta, records]`` bodies; ``page`` must put a bounded number on each."""
    columns = [F.col(c) for c in records.columns]
    pages = stage(
        records.groupBy(page.cast("int").alias("page")).agg(F.collect_list(F.struct(*columns)).alias("records")), "pages"
    )
    meta = F.to_json(F.struct("page", F.col("last").alias("pages")))
    last = pages.agg(F.max("page")).scalar()
    body = F.concat(F.lit("["), meta, F.lit(","), F.to_json("records"), F.lit("]"))
    return pages.withColumn("last", last).select(
        F.format_string("page-%d", "page").alias("source"), "page", body.alias("body")
    )


def feature_bodies(records: DataFrame, page: Column, part: Column | None = None) -> DataFrame:
    """Records as feature bodies; ``part`` splits a page that would not be of bounded size."""
    part = F.lit(0) if part is None else part
    feature = F.struct(F.struct(*[F.col(c) for c in records.columns]).alias("attributes"))
    pages = stage(
        records.groupBy(page.cast("int").alias("page"), part.alias("part")).agg(F.collect_list(feature).alias("features")),
        "pages",
    )
    last = pages.agg(F.max("page")).scalar()
    body = F.to_json(F.struct("features", (F.col("page") < F.col("last")).alias("exceededTransferLimit")))
    return pages.withColumn("last", last).select(
        F.format_string("page-%d-%d", "page", "part").alias("source"), "page", body.alias("body")
    )
