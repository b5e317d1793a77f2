
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_views  # noqa: E402
from harborline.adapters import PAGE_RECORDS, Tables, feature_bodies, indicator_bodies  # noqa: E402
from harborline.functions.columns import lenient_double  # noqa: E402
from harborline.operators import calls, connections, quality as q, traffic, upserts  # noqa: E402
from harborline.operators.observed import SKETCH_BITS  # noqa: E402
from harborline.operators.ranking import rank_min_desc, rank_within  # noqa: E402
from harborline.plans import assets as published, catalog  # noqa: E402
from harborline.plans.jobs import landed_inputs, run_jobs  # noqa: E402
from harborline.plans.marts import MartText, tables_read  # noqa: E402
from harborline.session import apply_settings, scratch_path, spread, stage  # noqa: E402
from harborline.sinks.files import write_csv  # noqa: E402
from harborline.sinks.tables import TableStore  # noqa: E402
from harborline.sources import landed, schemas  # noqa: E402

RUN_AT = datetime(2024, 1, 1, tzinfo=timezone.utc)

# The test tables use numbers where the services deliver text.
SHAPES = {
    "traffic": schemas.INDICATOR_RECORD.replace("id: string", "id: int"),
    "ports": schemas.PORT_ATTRIBUTES.replace("portid string", "portid bigint"),
    "connections": schemas.CONNECTION_ATTRIBUTES.replace("portid string", "portid int").replace(
        "daily_capacity_at_risk double", "daily_capacity_at_risk bigint"
    ),
}


# Years that the test orders have figures for.
SUMMARY_YEARS = (1996, 2000)


# ---- country traffic -----------------------------------------------------------


def _countries(t: Tables) -> DataFrame:
    return traffic.country_dim(t.country_records())


def _traffic(t: Tables) -> DataFrame:
    return traffic.clean_traffic(t.traffic_records(), _countries(t))


def _raw_traffic(t: Tables) -> DataFrame:
    return traffic.enrich_traffic(_traffic(t), _countries(t))


def _region_totals(t: Tables) -> DataFrame:
    return traffic.region_totals(_traffic(t), _countries(t))


def _summary(t: Tables) -> DataFrame:
    return _named_summary(traffic.country_summary(_raw_traffic(t), *SUMMARY_YEARS))


def _named_summary(found: DataFrame) -> DataFrame:
    base, compare = SUMMARY_YEARS
    names = {
        f"teu_{compare}": "teu_cmp", f"teu_{base}": "teu_base", f"cagr_{base}_{compare}": "cagr", f"rank_{compare}": "rank_cmp"
    }
    return found.select(*[F.col(c).alias(names.get(c, c)) for c in found.columns])


def _country_dim_derive(t: Tables) -> DataFrame:
    return _countries(t)


def _dim_stats(t: Tables) -> DataFrame:
    return traffic.country_dim_stats(_countries(t))


def _summary_stats(t: Tables) -> DataFrame:
    found = traffic.country_summary(_raw_traffic(t), base_year=1996, compare_year=2000)
    return traffic.country_summary_stats(found, base_year=1996, compare_year=2000)


def _stats(t: Tables) -> DataFrame:
    return traffic.clean_traffic_stats(t.traffic_records(), _countries(t))


# ---- ranks ---------------------------------------------------------------------


def _rank_global(t: Tables) -> DataFrame:
    spend = F.floor(F.col("o_totalprice") / 100).cast("bigint")
    orders = t.table("orders").select(
        "o_orderkey", spend.alias("spend"), F.when(F.col("o_orderstatus") != "P", spend).alias("ranked")
    )
    return rank_min_desc(orders, "ranked", "spend_rank").drop("ranked")


def _rank_hot_groups(t: Tables) -> DataFrame:
    """Orders ranked within one of three return flags, so that each group is a third of the rows."""
    sums = t.table("lineitem").groupBy(F.col("l_returnflag").alias("flag"), F.col("l_orderkey").alias("orderkey")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("bigint").alias("quantity")
    )
    return rank_within(stage(sums, "sums"), "flag", "quantity", "orderkey", "place")


# ---- calls and connections -----------------------------------------------------


def _calls_max_year(t: Tables) -> DataFrame:
    return calls.max_year(t.daily_calls())


def _calls_rollup(t: Tables) -> DataFrame:
    return calls.roll_up_months(calls.latest_years(t.daily_calls(), "year"))


def _union_years(t: Tables) -> DataFrame:
    def one(year: int) -> DataFrame:
        monthly = calls.roll_up_months(t.daily_calls().where(F.col("year") == year))
        return monthly.select("portid", "calls_year", "calls_month", "calls_total")

    return calls.concat_years([one(year) for year in (2000, 2001)])


def _mart_port_calls(t: Tables) -> DataFrame:
    return calls.port_calls_mart(t.calls_monthly(), t.ports())


def _mart_connections(t: Tables) -> DataFrame:
    return connections.connection_mart(t.stored_connections(), t.ports())


def _row_parity(t: Tables) -> DataFrame:
    stored = t.stored_calls()
    return q.row_parity(calls.port_calls_mart(stored, t.ports()), stored).select("passed", "raw_rows")


# ---- quality -------------------------------------------------------------------


def _checked(df: DataFrame, name: str, checks, *more: str) -> DataFrame:
    return q.run_checks(stage(df, name), name, checks, RUN_AT).select("check_name", "passed", "bad", *more)


def _suite(build: Callable[[Tables], DataFrame], key: str) -> Callable[[Tables], DataFrame]:
    checks = next(a.checks for a in published.ASSETS if a.key == key)
    return lambda t: _checked(build(t), key.replace(".", "-"), checks)


def _summary_checks(t: Tables) -> DataFrame:
    found = traffic.country_summary(_raw_traffic(t), base_year=1996, compare_year=2000)
    suite = (
        q.HasRows(),
        q.UniqueKey("unique_country", ("country_iso3",)),
        q.NoNulls("key_fields_present", ("country_iso3", "country_name")),
        q.NonNegative("teu_2000_non_negative", "teu_2000"),
    )
    return _checked(found, "summary", suite)


def _checks_with_a_crash(t: Tables) -> DataFrame:
    """A check that crashes while it runs fails alone; the others keep their results."""
    suite = (
        q.HasRows(),
        q.CountOf("port_name_is_a_number", "CAST(portname AS INT) < 0", "below zero"),
        q.UniqueKey("one_port_a_country", ("country",)),
        q.NoNulls("key_fields_present", ("portid", "portname")),
        q.NonNegative("portid_non_negative", "portid"),
    )
    found = _checked(t.ports(), "ports", suite, "detail")
    # What follows the colon is Spark's own error text.
    return found.withColumn("detail", F.regexp_replace("detail", "(?s)^(check crashed):.*", "$1"))


def _check_details(t: Tables) -> DataFrame:
    """Every kind of check on data that breaks it, with the text that says so."""
    broken = t.connections().select(
        F.when(F.col("from_portid") % 4 != 1, F.col("from_iso3")).alias("from_iso3"), "to_iso3", "from_portid", "to_portid",
        (F.col("daily_capacity_at_risk") - 6000).alias("margin"), "average_transit_days",
    )
    suite = (
        q.HasRows(),
        q.NoNulls("countries_present", ("from_iso3", "to_iso3")),
        q.NonNegative("margin_non_negative", "margin"),
        q.Positive("days_positive", "average_transit_days"),
        q.NotEqual("no_domestic_legs", "from_iso3", "to_iso3"),
        q.UniqueKey("one_leg_a_port", ("from_portid",)),
    )
    return _checked(broken, "details", suite, "detail")


def _lazy_checks(t: Tables) -> DataFrame:
    """Checks of one's own that join the plan of the others: a join, a distinct count and a bound on a share."""

    def known_ports(df: DataFrame) -> DataFrame:
        bad = F.count("*")
        return df.join(t.table("supplier"), F.col("portid") == F.col("s_suppkey"), "left_anti").agg(
            (bad == 0).alias("passed"), bad.alias("bad"), F.concat(bad.cast("string"), F.lit(" without a port")).alias("detail")
        )

    def twelve_months(df: DataFrame) -> DataFrame:
        short = df.groupBy("calls_year").agg(F.count_distinct("calls_month").alias("months")).where("months < 12")
        bad = F.count("*")
        years = F.array_join(F.array_sort(F.collect_list(F.col("calls_year").cast("string"))), ", ")
        return short.agg((bad == 0).alias("passed"), bad.alias("bad"), F.concat(F.lit("short years: "), years).alias("detail"))

    def even_types(df: DataFrame) -> DataFrame:
        share = F.sum("calls_tanker") * 100 >= F.sum("calls_total") * 10
        return df.agg(share.alias("passed"), F.sum("calls_tanker").alias("bad"), F.lit("tankers are a tenth or more").alias("detail"))

    suite = (
        q.HasRows(), q.Query("ports_known", known_ports), q.Query("whole_years", twelve_months),
        q.Query("tankers_common", even_types),
    )
    return _checked(t.calls_monthly(), "lazy", suite, "detail")


def _orphans(t: Tables) -> DataFrame:
    """Calls of ports that the port table lacks, and that the mart therefore drops."""
    ports = t.ports().where("portid % 7 <> 0")
    return calls.calls_without_port(t.calls_monthly(), ports).select("portid", "calls_year", "calls_month", "calls_total")


def _lost_parity(t: Tables) -> DataFrame:
    stored = t.stored_calls()
    mart = calls.port_calls_mart(stored, t.ports().where("portid % 7 <> 0"))
    return q.row_parity(mart, stored)


def _distinct_sketches(t: Tables) -> DataFrame:
    """Customers of each year as sketches; their union over all years against the exact count, and each year's own."""
    orders = t.table("orders").select(F.year("o_orderdate").alias("year"), "o_custkey")
    exact = F.count_distinct("o_custkey").alias("customers")
    per_year = stage(orders.groupBy("year").agg(F.hll_sketch_agg("o_custkey", SKETCH_BITS).alias("sketch")), "sketches")
    about = per_year.select("year", F.hll_sketch_estimate("sketch").alias("about")).union(
        per_year.agg(F.lit(None).cast("int"), F.hll_sketch_estimate(F.hll_union_agg("sketch")))
    )
    counted = orders.groupBy("year").agg(exact).union(orders.agg(F.lit(None).cast("int"), exact))
    both = about.withColumnRenamed("year", "of").join(counted, F.col("of").eqNullSafe(F.col("year")))
    close = F.abs(F.col("about") - F.col("customers")) <= F.col("customers") * 0.02
    return both.select("year", "customers", close.alias("within_two_percent"))


def _duplicates(t: Tables) -> DataFrame:
    return q.duplicate_rows(t.table("lineitem"), ("l_orderkey", "l_linenumber"))


def _key_violations(t: Tables) -> DataFrame:
    return upserts.key_violations(t.table("lineitem"), ("l_orderkey", "l_linenumber"))


def _null_counts(t: Tables) -> DataFrame:
    return q.null_counts(t.connections(), ("from_iso3", "daily_capacity_at_risk", "to_portid"))


def _profile(t: Tables) -> DataFrame:
    pairs = t.connections().select("from_iso3", "to_iso3", "daily_capacity_at_risk")
    return catalog.profile_fields(pairs, published.CONNECTIONS).select("field_name", "is_nullable")


# ---- merges and sinks ----------------------------------------------------------


def _store(t: Tables) -> TableStore:
    # Each query has tables of its own in the session's catalog.
    return TableStore(t.spark, scratch_path(t.spark, "tables"), f"q{uuid.uuid4().hex[:12]}_")


def _upsert_calls(t: Tables) -> DataFrame:
    """Calls by ship date are stored; the newest two years, counted by order date, replace theirs."""
    store = _store(t)
    stored = store.replace(published.CALLS, t.calls_monthly(), ("calls_year",))
    batch = calls.roll_up_months(calls.latest_years(t.daily_calls("o_orderdate"), "year"))
    return store.upsert(published.CALLS, batch.select(*stored.columns), calls.CALL_KEYS, "calls_year")


def _upsert_last_wins(t: Tables) -> DataFrame:
    store = _store(t)
    ports = t.table("supplier").select(F.col("s_suppkey").alias("portid"), F.col("s_name").alias("portname"))
    store.replace(published.PORTS, ports)
    batch = t.table("customer").select(
        F.col("c_nationkey").cast("bigint").alias("portid"), F.col("c_name").alias("portname"), "c_custkey"
    )
    return store.upsert(published.PORTS, batch, ("portid",), position=("c_custkey",))


def _partial_upsert(t: Tables) -> DataFrame:
    def by_order(other: str, description) -> DataFrame:
        lines = t.table("lineitem").where(F.col("l_returnflag") != other)
        return lines.groupBy(F.col("l_orderkey").alias("asset_key")).agg(
            description.alias("description"), F.count("*").alias("last_row_count")
        )

    known = by_order("A", F.max(F.lit(None).cast("string")))
    return upserts.partial_upsert(known, by_order("R", F.max("l_linestatus")), ("asset_key",), ("last_row_count",))


def _edges(t: Tables) -> DataFrame:
    def edges(other: str) -> DataFrame:
        lines = t.table("lineitem").where(F.col("l_returnflag") != other)
        return lines.select(
            F.col("l_suppkey").alias("from_asset"), F.col("l_partkey").alias("to_asset"),
            F.lit(catalog.FEEDS).alias("edge_type"),
        )

    return upserts.insert_ignore(edges("A"), edges("R"))


def _sink_replace(t: Tables) -> DataFrame:
    store = _store(t)
    store.replace(published.PORTS, t.table("nation"))
    return store.replace(published.PORTS, t.ports())


def _sink_reload(t: Tables) -> DataFrame:
    store, ports = _store(t), t.ports()
    store.reload(published.PORTS, ports.withColumn("portname", F.lower("portname")))
    return store.reload(published.PORTS, ports)


def _sink_csv(t: Tables) -> DataFrame:
    path, ports = scratch_path(t.spark, "csv"), t.ports()
    write_csv(ports, path)
    return t.spark.read.schema(ports.schema).option("header", "true").csv(path)


# ---- landed pages --------------------------------------------------------------


def _traffic_bodies(t: Tables) -> DataFrame:
    return indicator_bodies(t.traffic_records(), F.col("country.id") + 1)


def _port_bodies(t: Tables) -> DataFrame:
    return feature_bodies(t.port_records(), F.floor(F.col("portid") / PAGE_RECORDS) + 1)


def _indicator_flatten(t: Tables) -> DataFrame:
    records = landed.read_indicator_pages(_traffic_bodies(t), SHAPES["traffic"])
    return records.select(
        "countryiso3code", F.col("country.id").alias("country_id"), F.col("country.value").alias("country_value"),
        "date", "value",
    )


def _feature_flatten(t: Tables) -> DataFrame:
    rows = landed.read_feature_pages(_port_bodies(t), SHAPES["ports"])
    return rows.select("portid", "portname", "country", F.col("ISO3").alias("country_iso3"), "continent")


def _page_audit(t: Tables) -> DataFrame:
    """Suppliers on pages of their own, but for pages that are missing, landed twice, without a number or cut off."""
    numbered = F.when(F.col("portid") % 11 != 6, F.col("portid"))
    bodies = feature_bodies(t.port_records(), numbered).where("page IS NULL OR page % 5 <> 3")
    twice = bodies.where("page % 7 = 1").withColumn("source", F.concat("source", F.lit("-again")))
    return landed.audit_feature_pages(bodies.union(twice))


def _page_audit_indicator(t: Tables) -> DataFrame:
    """Traffic pages of which every fourth is not landed, and every sixth twice."""
    bodies = _traffic_bodies(t)
    kept = bodies.where("page % 4 <> 2 OR page = 1")
    return landed.audit_indicator_pages(kept.union(kept.where("page % 6 = 1")))


def _page_gaps(t: Tables) -> DataFrame:
    """Port pages numbered by offset, many of them absent, and one stray page far out."""
    offset = ((F.col("s_suppkey") - 1) * 1000).cast("bigint")
    kept = t.table("supplier").where("s_suppkey % 5 <> 3 AND s_suppkey % 7 > 1").select(offset.alias("page"))
    stray = t.spark.range(1).select(F.lit(2_000_000_000).cast("bigint").alias("page"))
    return landed.page_gaps(kept.union(stray), step=1000)


def _rich_port_pages(t: Tables) -> DataFrame:
    """Port pages whose features carry more than the listed attributes."""
    key = F.col("portid")
    records = t.port_records().select(
        "*", F.concat(F.lit("Port of "), "portname").alias("fullname"),
        F.when(key % 3 == 0, key * 10).alias("berths"), (key % 2 == 0).alias("open"),
        F.when(key % 4 == 1, F.array(F.lit("a"), F.col("country"))).alias("lines"),
        F.when(key % 5 == 2, F.struct(key.alias("grade"))).alias("rating"),
    )
    bodies = feature_bodies(records, F.floor(key / PAGE_RECORDS) + 1)
    return landed.stage_pages(bodies, "features")[0]


def _unlisted_fields(t: Tables) -> DataFrame:
    return landed.unlisted_fields(landed.field_inventory(_rich_port_pages(t)), schemas.PORT_COLUMNS)


def _unlisted_kept(t: Tables) -> DataFrame:
    """What a fixed list of columns leaves behind stays in a VARIANT column and can be asked for later."""
    rows = stage(landed.page_attributes(_rich_port_pages(t), SHAPES["ports"]), "rich-ports")
    rest = F.col("unlisted")
    return rows.select(
        "portid", "portname", F.variant_get(rest, "$.fullname", "string").alias("fullname"),
        F.variant_get(rest, "$.berths", "bigint").alias("berths"), F.variant_get(rest, "$.open", "boolean").alias("is_open"),
        F.variant_get(rest, "$.lines[1]", "string").alias("second_line"),
        F.variant_get(rest, "$.rating.grade", "bigint").alias("grade"),
    )


def _event_bodies(t: Tables) -> DataFrame:
    kind, props = F.col("event_type"), F.col("props")
    body = (
        F.when(kind == "error", F.concat(F.lit('{"error":'), props, F.lit("}")))
        .when(kind == "signup", F.lit("<html>busy</html>"))
        .otherwise(F.concat(F.lit('{"features":[{"attributes":'), props, F.lit("}]}")))
    )
    return t.table("events").select(
        F.col("event_id").cast("string").alias("source"), F.lit(None).cast("int").alias("page"), body.alias("body")
    )


def _body_quarantine(t: Tables) -> DataFrame:
    return landed.quarantine_features(_event_bodies(t)).select("source", "problem")


def _body_features(t: Tables) -> DataFrame:
    return landed.read_feature_pages(landed.readable_features(_event_bodies(t)), "k bigint")


def _lenient_numbers(t: Tables) -> DataFrame:
    value = F.col("value").cast("string")
    text = F.when(F.col("event_type") == "error", F.concat(value, F.lit("d"))).otherwise(
        F.concat(F.lit(" "), value, F.lit(" "))
    )
    return t.table("events").select("event_id", lenient_double(text).alias("number"))


# ---- whole jobs, from landed pages to published tables ---------------------------


def _mart_from_text(t: Tables) -> DataFrame:
    """A mart of one's own as SQL text with a parameter, over stored tables, with the tables its plan reads."""
    store = _store(t)
    store.replace(published.PORTS, t.ports())
    store.replace(published.CALLS, t.calls_monthly(), ("calls_year",))
    text = MartText(
        """SELECT continent, calls_year, sum(calls_total) AS calls, count(DISTINCT portid) AS ports
           FROM {calls} JOIN {ports} USING (portid) WHERE calls_month <= :until AND calls_year >=
             (SELECT max(calls_year) - 2 FROM {calls}) GROUP BY continent, calls_year""",
        {"calls": published.CALLS, "ports": published.PORTS}, {"until": 6},
    )
    mart = text.build(t.spark, store.read)
    read = ", ".join(sorted(name.removeprefix(store.namespace) for name in tables_read(mart)))
    return mart.withColumn("built_from", F.lit(read))


def _job_mart_edges(t: Tables) -> DataFrame:
    """Lineage of the marts stated as SQL, with the rows at either end."""
    store = _run(t, *dict.fromkeys((*CALLS_JOBS, *CONNECTION_JOBS)))
    rows = store.read(catalog.ASSET_TABLE).select("asset_key", "last_row_count")
    return (
        store.read(catalog.EDGE_TABLE)
        .join(rows.toDF("from_asset", "from_rows"), "from_asset").join(rows.toDF("to_asset", "to_rows"), "to_asset")
    )


def _job_write_metrics(t: Tables) -> DataFrame:
    return _run(t, *TRAFFIC_JOBS).read(catalog.METRIC_TABLE)


def _job_registered_names(t: Tables) -> DataFrame:
    """The registry's names of tables lead, in SQL, to the tables; every run carries one time."""
    store = _run(t, *TRAFFIC_JOBS)
    found = store.read(catalog.ASSET_TABLE).where(F.col("asset_key") == published.TRAFFIC)
    asked = t.spark.sql(
        f"SELECT traffic_year, count(*) AS countries FROM {store.name(published.TRAFFIC)} GROUP BY traffic_year"
    )
    return asked.join(found.select("schema_name", "table_name", F.date_format("last_run_at", "yyyy-MM-dd").alias("run_day")))


def _job_offset_pages(t: Tables) -> DataFrame:
    """Ports on pages of ten, numbered by offset, every fourth page not landed."""
    folder, store = scratch_path(t.spark, "landed"), _store(t)
    offset = F.floor(F.col("portid") / 10) * 1000
    feature_bodies(t.port_records(), offset).where("(page / 1000) % 4 <> 2").write.parquet(f"{folder}/ports")
    inputs = landed_inputs(t.spark, folder, store, packed=True, shapes=SHAPES, page_steps={"ports": 1000})
    chosen = [a for a in published.ASSETS if a.key == published.PORTS]
    run_jobs(store, inputs, catalog.Run(at=RUN_AT, pipeline_uuid="spark_entry"), chosen)
    return store.read(catalog.CHECK_TABLE).select("check_name", "passed", "bad", "detail")


def _run(t: Tables, *keys: str) -> TableStore:
    """Land the tables as pages and a daily layer, then run the named assets."""
    folder, store = scratch_path(t.spark, "landed"), _store(t)

    def land(name: str, bodies: DataFrame) -> None:
        bodies.write.parquet(f"{folder}/{name}")

    if published.TRAFFIC in keys:
        countries = t.country_records()
        page = F.floor(F.col("nationkey") / PAGE_RECORDS) + 1
        land("countries", indicator_bodies(countries, page))
        land("traffic", _traffic_bodies(t))
    if published.PORTS in keys:
        land("ports", _port_bodies(t))
    if published.CONNECTIONS in keys:
        land("connections", feature_bodies(t.stored_connections(), F.col("from_portid") + 1))
    if published.CALLS in keys:
        spread(t.daily_calls(), ("year",)).write.partitionBy("year").parquet(f"{folder}/daily_calls")
    inputs = landed_inputs(t.spark, folder, store, packed=True, shapes=SHAPES)
    chosen = [published.summary_asset(*SUMMARY_YEARS) if a.key == published.SUMMARY else a for a in published.ASSETS]
    chosen = [a for a in chosen if a.key in keys]
    run_jobs(store, inputs, catalog.Run(at=RUN_AT, pipeline_uuid="spark_entry"), chosen)
    return store


TRAFFIC_JOBS = (published.COUNTRY_DIM, published.TRAFFIC, published.REGION_TOTALS)
CALLS_JOBS = (published.PORTS, published.CALLS, published.CALLS_MART)
CONNECTION_JOBS = (published.PORTS, published.CONNECTIONS, published.CONNECTION_MART)


def _job_asset_rows(t: Tables) -> DataFrame:
    return _run(t, *TRAFFIC_JOBS).read(catalog.ASSET_TABLE).select("asset_key", "layer", "last_row_count")


def _job_field_profile(t: Tables) -> DataFrame:
    fields = _run(t, *TRAFFIC_JOBS).read(catalog.FIELD_TABLE)
    return fields.where(F.col("asset_key") == published.REGION_TOTALS).select(
        "asset_key", "field_name", "data_type", "unit", "is_nullable"
    )


def _job_check_results(t: Tables) -> DataFrame:
    return _run(t, *CALLS_JOBS).read(catalog.CHECK_TABLE).select("asset_key", "check_name", "passed", "bad")


# The training-data operators live in a subpackage that may be absent.
try:
    from corpus_pipeline import ORACLE_SQL as PIPELINE_SQL, run as run_pipeline  # noqa: E402
    from harborline.llm.queries import ORACLE_SQL as LLM_SQL, QUERIES as LLM_QUERIES  # noqa: E402
except ImportError:
    # The subpackage, the pipeline or a library that only they need is not here; the other queries do without.
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES = {**LLM_QUERIES, "pipeline": run_pipeline}
    LLM_SQL = {**LLM_SQL, **({"pipeline": PIPELINE_SQL} if PIPELINE_SQL else {})}

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "country_dim_derive": _country_dim_derive,
    "country_dim_stats": _dim_stats,
    "clean_traffic": _traffic,
    "clean_traffic_stats": _stats,
    "raw_traffic_join": _raw_traffic,
    "region_totals": _region_totals,
    "country_summary": _summary,
    "country_summary_stats": _summary_stats,
    "rank_global": _rank_global,
    "rank_hot_groups": _rank_hot_groups,
    "calls_max_year": _calls_max_year,
    "calls_monthly_rollup": _calls_rollup,
    "union_years": _union_years,
    "mart_port_calls": _mart_port_calls,
    "mart_connections": _mart_connections,
    "mart_row_parity": _row_parity,
    "quality_country_dim": _suite(_countries, published.COUNTRY_DIM),
    "quality_traffic": _suite(_traffic, published.TRAFFIC),
    "quality_country_summary": _summary_checks,
    "quality_region_totals": _suite(_region_totals, published.REGION_TOTALS),
    "quality_ports": _suite(Tables.ports, published.PORTS),
    "quality_calls": _suite(Tables.calls_monthly, published.CALLS),
    "quality_connections": _suite(Tables.connections, published.CONNECTIONS),
    "quality_with_a_crash": _checks_with_a_crash,
    "quality_duplicates": _duplicates,
    "key_violations": _key_violations,
    "quality_null_counts": _null_counts,
    "profile_fields": _profile,
    "upsert_calls": _upsert_calls,
    "upsert_last_wins": _upsert_last_wins,
    "registry_partial_upsert": _partial_upsert,
    "edges_insert_ignore": _edges,
    "wb_pages_flatten": _indicator_flatten,
    "feature_pages_flatten": _feature_flatten,
    "page_audit": _page_audit,
    "page_audit_indicator": _page_audit_indicator,
    "page_gaps": _page_gaps,
    "unlisted_fields": _unlisted_fields,
    "unlisted_kept": _unlisted_kept,
    "check_details": _check_details,
    "lazy_checks": _lazy_checks,
    "orphan_calls": _orphans,
    "lost_row_parity": _lost_parity,
    "distinct_sketches": _distinct_sketches,
    "body_quarantine": _body_quarantine,
    "body_features": _body_features,
    "lenient_numbers": _lenient_numbers,
    "sink_replace": _sink_replace,
    "sink_reload": _sink_reload,
    "sink_csv": _sink_csv,
    "job_region_totals": lambda t: _run(t, *TRAFFIC_JOBS).read(published.REGION_TOTALS),
    "job_country_summary": lambda t: _named_summary(_run(t, *TRAFFIC_JOBS, published.SUMMARY).read(published.SUMMARY)),
    "job_edges": lambda t: _run(t, *TRAFFIC_JOBS, published.SUMMARY).read(catalog.EDGE_TABLE),
    "job_port_calls": lambda t: _run(t, *CALLS_JOBS).read(published.CALLS_MART),
    "job_connections": lambda t: _run(t, *CONNECTION_JOBS).read(published.CONNECTION_MART),
    "job_asset_rows": _job_asset_rows,
    "job_check_results": _job_check_results,
    "job_field_profile": _job_field_profile,
    "job_write_metrics": _job_write_metrics,
    "job_registered_names": _job_registered_names,
    "job_offset_pages": _job_offset_pages,
    "job_mart_edges": _job_mart_edges,
    "mart_from_text": _mart_from_text,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: container traffic by region and year."""
    return queries()["region_totals"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Tables(apply_settings(spark), sf_dir))

    return {name: bind(build) for name, build in QUERIES.items()} | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    return {name: oracle_views.compose(name) for name in QUERIES} | LLM_SQL
