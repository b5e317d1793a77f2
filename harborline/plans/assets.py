"""The published tables: build, key, checks, documentation and upstreams of each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from harborline.operators import calls, connections, quality as q, traffic
from harborline.plans.marts import MartText, calls_by_month, connection_summary
from harborline.sinks.layout import Layout
from harborline.sources import landed, schemas

# Asset keys, key columns, check names and units of the published tables,
# and the public data sets they come from.
COUNTRY_DIM = "port_raw.country_dim"
TRAFFIC = "port_raw.country_port_traffic"
PORTS = "port_raw.portwatch_ports"
CONNECTIONS = "port_raw.port_connections"
CALLS = "port_raw.port_calls_monthly"
SUMMARY = "port_mart.country_traffic_summary"
REGION_TOTALS = "port_mart.traffic_by_region_year"
CALLS_MART = "port_mart.port_calls_by_type_month"
CONNECTION_MART = "port_mart.port_connection_summary"

INDICATORS = "World Bank Indicators API"
PORT_SERVICE = "IMF PortWatch"
DERIVED = "Derived"


@dataclass(frozen=True)
class Asset:
    """A published table. ``build`` takes the job's inputs and gives the new batch."""

    key: str
    build: Callable[["Inputs"], DataFrame]
    write: str
    keys: tuple[str, ...]
    checks: tuple
    description: str
    source: str
    source_detail: str
    grain: str
    upstreams: tuple[str, ...] = ()
    partition_by: str | None = None
    layout: Layout | None = None
    # Columns whose smallest and largest value, and whose distinct values, each run records.
    spans: tuple[str, ...] = ()
    distincts: tuple[str, ...] = ()
    position: tuple[str, ...] = ()
    docs: dict[str, tuple[str, str | None]] = field(default_factory=dict)
    landed: str | None = None
    required: tuple[str, ...] = ()
    enforce_key: bool = False
    parity_with: str | None = None

    @property
    def layer(self) -> str:
        return "mart" if self.key.startswith("port_mart.") else "raw"


@dataclass
class Inputs:
    """Where a build reads: landed bodies by name, the daily layer, and stored tables."""

    spark: SparkSession
    bodies: Callable[[str], DataFrame]
    daily: Callable[[], DataFrame]
    stored: Callable[[str], DataFrame]
    record_shapes: dict[str, str]
    # Step between page numbers: 1 where pages are counted, the page size where they are numbered by offset.
    page_steps: dict[str, int] = field(default_factory=dict)
    _parsed: dict[str, tuple[DataFrame, dict[str, int]]] = field(default_factory=dict)

    def parsed(self, name: str) -> tuple[DataFrame, dict[str, int]]:
        """The landed pages of a name, parsed once in a run, and the counts of that pass."""
        if name not in self._parsed:
            self._parsed[name] = landed.stage_pages(self.bodies(name), page_shape(name), f"pages-{name}")
        return self._parsed[name]

    def records(self, name: str, positions: bool = False) -> DataFrame:
        return landed.page_records(self.parsed(name)[0], self.record_shapes[name], positions)

    def forget(self) -> None:
        """Parse anew from here on: the staged pages of a run go with its scratch folder."""
        self._parsed.clear()


def page_shape(name: str) -> str:
    return "indicator" if name in ("countries", "traffic") else "features"


def _country_dim(inputs: Inputs) -> DataFrame:
    return traffic.country_dim(inputs.records("countries"))


def _traffic(inputs: Inputs) -> DataFrame:
    return traffic.clean_traffic(inputs.records("traffic"), inputs.stored(COUNTRY_DIM))


def _ports(inputs: Inputs) -> DataFrame:
    rows = inputs.records("ports", positions=True)
    renamed = [F.col(old).alias(new) for old, new in schemas.PORT_COLUMNS.items()]
    return rows.select(*renamed, "page", "position")


def _connections(inputs: Inputs) -> DataFrame:
    return schemas.require_columns(inputs.records("connections"), schemas.CONNECTION_COLUMNS)


def _calls(inputs: Inputs) -> DataFrame:
    return calls.roll_up_months(calls.latest_years(inputs.daily(), "year"))


def summary_asset(base_year: int = traffic.BASE_YEAR, compare_year: int = traffic.COMPARE_YEAR) -> Asset:
    """The country summary for a pair of years."""
    base, compare, growth = f"teu_{base_year}", f"teu_{compare_year}", f"cagr_{base_year}_{compare_year}"

    def build(inputs: Inputs) -> DataFrame:
        figures = traffic.enrich_traffic(inputs.stored(TRAFFIC), inputs.stored(COUNTRY_DIM))
        return traffic.country_summary(figures, base_year, compare_year)

    return Asset(
        key=SUMMARY, build=build, write="replace", keys=("country_iso3",),
        checks=(
            q.HasRows(),
            q.UniqueKey("unique_country", ("country_iso3",)),
            q.NoNulls("key_fields_present", ("country_iso3", "country_name")),
            q.NonNegative(f"{compare}_non_negative", compare),
        ),
        description="Container traffic of each country: latest, growth and rank",
        source=DERIVED, source_detail=f"From {TRAFFIC} and {COUNTRY_DIM}", grain="one row per country",
        upstreams=(TRAFFIC, COUNTRY_DIM),
        docs={
            "country_iso3": ("Three-letter code of the country", None),
            "country_name": ("Name in the newest year with a figure", None),
            "region_code": ("Region code in that year", None),
            "region_name": ("Region name in that year", None),
            "longitude": ("Where the capital lies; NULL if the source text is no number", "degrees"),
            "latitude": ("Where the capital lies; NULL if the source text is no number", "degrees"),
            "latest_year": ("Newest year with a figure", "year"),
            "latest_teu": ("Figure of that year", "TEU"),
            compare: (f"Figure of {compare_year}, NULL without one", "TEU"),
            base: (f"Figure of {base_year}, NULL without one", "TEU"),
            growth: (f"Yearly growth from {base_year} to {compare_year}; NULL where the ratio is undefined", "fraction"),
            f"rank_{compare_year}": (f"One plus the countries with a larger figure of {compare_year}", None),
        },
    )


def _region_totals(inputs: Inputs) -> DataFrame:
    return traffic.region_totals(inputs.stored(TRAFFIC), inputs.stored(COUNTRY_DIM))


def mart_asset(key: str, text: MartText, **other) -> Asset:
    """A mart stated as SQL: what it is built from is what its text declares."""
    return Asset(
        key=key, build=lambda inputs: text.build(inputs.spark, inputs.stored), write="replace", enforce_key=True,
        upstreams=text.tables, source=DERIVED, source_detail="Rebuilt whole on every run", **other,
    )


ASSETS = (
    Asset(
        key=COUNTRY_DIM, build=_country_dim, write="replace", keys=("country_iso3",),
        checks=(
            q.HasRows(),
            q.UniqueKey("unique_entity", ("country_iso3",)),
            q.NoNulls("key_fields_present", ("country_iso3", "country_name", "is_aggregate")),
        ),
        description="Countries and country groupings with their region and capital coordinates",
        source=INDICATORS, source_detail="/v2/country", grain="one row per entity",
        landed="countries", required=schemas.COUNTRY_FIELDS,
        docs={
            "country_iso3": ("Three-letter code of the entity", None),
            "country_iso2": ("Two-letter code of the entity", None),
            "country_name": ("Name to display", None),
            "region_code": ("Code of the region; NA on groupings", None),
            "region_name": ("Name of the region; Aggregates on groupings", None),
            "capital_city": ("Name of the capital", None),
            "longitude": ("Longitude of the capital, not of a port", "degrees"),
            "latitude": ("Latitude of the capital, not of a port", "degrees"),
            "is_aggregate": ("Whether the entity groups countries by region or income", None),
        },
    ),
    Asset(
        key=TRAFFIC, build=_traffic, write="replace", keys=("country_iso3", "traffic_year"),
        checks=(
            q.HasRows(),
            q.UniqueKey("unique_country_year", ("country_iso3", "traffic_year")),
            q.NoNulls("key_fields_present", ("country_iso3", "traffic_year", "teu")),
            q.NonNegative("teu_non_negative", "teu"),
        ),
        description="Yearly container traffic of each country",
        source=INDICATORS, source_detail="IS.SHP.GOOD.TU", grain="one row per country and year",
        upstreams=(COUNTRY_DIM,), landed="traffic", required=schemas.INDICATOR_FIELDS, spans=("traffic_year",),
        distincts=("country_iso3",),
        docs={
            "country_iso3": ("Three-letter code of the country", None),
            "country_id": ("Two-character code the source uses", None),
            "country_name": ("Name to display", None),
            "traffic_year": ("Year the figure is for", "year"),
            "teu": ("Containers handled by the ports of the country", "TEU"),
        },
    ),
    Asset(
        key=PORTS, build=_ports, write="upsert", keys=("portid",), position=("page", "position"),
        checks=(
            q.HasRows(),
            q.UniqueKey("unique_port", ("portid",)),
            q.NoNulls("key_fields_present", ("portid", "portname")),
        ),
        description="Ports with their own coordinates",
        source=PORT_SERVICE, source_detail="PortWatch_ports_database", grain="one row per port",
        landed="ports", required=tuple(schemas.PORT_COLUMNS),
    ),
    Asset(
        key=CONNECTIONS, build=_connections, write="reload", keys=connections.PAIR,
        checks=(
            q.HasRows(),
            q.UniqueKey("unique_pair", connections.PAIR),
            q.NoNulls("key_fields_present", connections.PAIR),
            q.NotEqual("no_self_legs", *connections.PAIR),
            q.NonNegative("capacity_non_negative", "daily_capacity_at_risk"),
            q.Positive("transit_days_positive", "average_transit_days"),
        ),
        description="Port pairs in sailing direction with the capacity seen between them",
        source=PORT_SERVICE, source_detail="spillovers_port_level_impact", grain="one row per directed pair of ports",
        landed="connections", required=schemas.CONNECTION_COLUMNS,
    ),
    Asset(
        key=CALLS, build=_calls, write="upsert", keys=calls.CALL_KEYS, partition_by="calls_year",
        checks=(
            q.HasRows(),
            q.UniqueKey("unique_port_month", calls.CALL_KEYS),
            q.NoNulls("key_fields_present", calls.CALL_KEYS),
            q.NonNegative("calls_non_negative", "calls_total"),
        ),
        description="Vessel calls per port and month by vessel type, summed from the daily layer",
        source=PORT_SERVICE, source_detail="Daily_Ports_Data", grain="one row per port, year and month",
    ),
    summary_asset(),
    Asset(
        key=REGION_TOTALS, build=_region_totals, write="replace", keys=("region_code", "traffic_year"),
        checks=(
            q.HasRows(),
            q.UniqueKey("unique_region_year", ("region_code", "traffic_year")),
            q.NoNulls("key_fields_present", ("region_code", "region_name", "traffic_year")),
            q.NonNegative("total_teu_non_negative", "total_teu"),
        ),
        description="Container traffic by region and year",
        source=DERIVED, source_detail=f"From {TRAFFIC} and {COUNTRY_DIM}", grain="one row per region and year",
        upstreams=(TRAFFIC, COUNTRY_DIM),
        docs={
            "region_code": ("Code of the region", None),
            "region_name": ("Name of the region", None),
            "traffic_year": ("Year the figure is for", "year"),
            "total_teu": ("Sum over the countries that reported", "TEU"),
            "countries_reporting": ("Rows behind the sum; totals of years that differ here do not compare", "count"),
            "mean_teu": ("Mean over the countries that reported", "TEU"),
        },
    ),
    mart_asset(
        CALLS_MART, calls_by_month(CALLS, PORTS), keys=calls.CALL_KEYS, checks=(q.HasRows(),), parity_with=CALLS,
        layout=Layout(("country_iso3", "portid"), ("portid",)), spans=("calls_year",),
        description="Monthly calls by vessel type with the port they belong to", grain="one row per port, year and month",
    ),
    mart_asset(
        CONNECTION_MART, connection_summary(CONNECTIONS, PORTS), keys=connections.PAIR, checks=(q.HasRows(),),
        layout=Layout(("from_portid", "rank_from_port"), ("to_portid",)),
        description="Port pairs ranked by capacity at either end, with a domestic flag", grain="one row per directed pair of ports",
    ),
)
