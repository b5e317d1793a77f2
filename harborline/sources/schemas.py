"""Schemas of the landed records and the columns each table must have."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Field names and shapes as the two public services deliver them.
INDICATOR_RECORD = (
    "country struct<id: string, value: string>, countryiso3code string, date string, value double"
)
COUNTRY_RECORD = (
    "id string, iso2Code string, name string, region struct<id: string, value: string>, "
    "capitalCity string, longitude string, latitude string"
)
PORT_ATTRIBUTES = (
    "portid string, portname string, country string, ISO3 string, continent string, "
    "lat double, lon double, LOCODE string, vessel_count_total double"
)
CONNECTION_ATTRIBUTES = (
    "from_portid string, from_portname string, from_country string, from_iso3 string, "
    "to_portid string, to_portname string, to_country string, to_iso3 string, "
    "average_transit_days double, daily_capacity_at_risk double, relative_capacity_at_risk double"
)
VESSEL_TYPES = ("container", "dry_bulk", "general_cargo", "roro", "tanker")

PORT_COLUMNS = {
    "portid": "portid",
    "portname": "portname",
    "country": "country",
    "ISO3": "country_iso3",
    "continent": "continent",
    "lat": "latitude",
    "lon": "longitude",
    "LOCODE": "locode",
    "vessel_count_total": "vessel_count_total",
}
CONNECTION_COLUMNS = (
    "from_portid", "from_portname", "from_country", "from_iso3",
    "to_portid", "to_portname", "to_country", "to_iso3",
    "average_transit_days", "daily_capacity_at_risk", "relative_capacity_at_risk",
)

INDICATOR_FIELDS = ("countryiso3code", "country.id", "country.value", "date", "value")
COUNTRY_FIELDS = (
    "id", "iso2Code", "name", "region.id", "region.value", "capitalCity", "longitude", "latitude",
)


def require_columns(df: DataFrame, columns) -> DataFrame:
    """Project to the listed columns; a missing one is an error, extra ones are dropped."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")
    return df.select(*columns)
