"""Marts stated as SQL text over declared inputs, with their lineage read off the analysed plan.

A new mart is a text, its inputs and its parameters; no function is written for it. In the text, ``{name}`` stands for an
input and ``:name`` for a parameter. An input is a stored table, or a frame that an operator makes of stored tables where
SQL alone would put a whole group into one task (ranks within a hot port).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from harborline.operators.connections import ranked_pairs


@dataclass(frozen=True)
class Derived:
    """An input that an operator makes of stored tables."""

    make: Callable[..., DataFrame]
    tables: tuple[str, ...]


@dataclass(frozen=True)
class MartText:
    """A mart: its SQL, what the names in it stand for, and the values of its parameters."""

    text: str
    inputs: dict[str, str | Derived]
    parameters: dict[str, object] = field(default_factory=dict)

    def __post_init__(self):
        used = set(re.findall(r"\{(\w+)\}", self.text))
        if used != set(self.inputs):
            raise ValueError(f"the text uses {sorted(used)}, declared are {sorted(self.inputs)}")

    @property
    def tables(self) -> tuple[str, ...]:
        """Keys of all stored tables behind the inputs, in the order they are declared."""
        each = [(i,) if isinstance(i, str) else i.tables for i in self.inputs.values()]
        return tuple(dict.fromkeys(key for keys in each for key in keys))

    def frames(self, stored: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
        return {
            name: stored(i) if isinstance(i, str) else i.make(*map(stored, i.tables)) for name, i in self.inputs.items()
        }

    def build(self, spark: SparkSession, stored: Callable[[str], DataFrame]) -> DataFrame:
        """The mart as a lazy frame."""
        return spark.sql(self.text, args=self.parameters or None, **self.frames(stored))


def tables_read(df: DataFrame) -> set[str]:
    """Names (database.table) of the catalog's tables in the analysed plan of a frame, subqueries included."""
    plan = df._jdf.queryExecution().analyzed()
    found, plans = set(), [plan]
    inner = plan.subqueriesAll()
    plans += [inner.apply(i) for i in range(inner.size())]
    for each in plans:
        leaves = each.collectLeaves()
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.catalogTable().isDefined():
                name = leaf.catalogTable().get().identifier()
                found.add(f"{name.database().get()}.{name.table()}")
    return found


class Reads:
    """The stored tables that a build read: those in its plan, and those that an operator read on the way.

    What an operator writes and reads back is a scratch table, behind which the plan shows nothing; the frames it was
    given are looked at when they are handed out.
    """

    def __init__(self, stored: Callable[[str], DataFrame]):
        self._stored, self.seen = stored, set()

    def __call__(self, key: str) -> DataFrame:
        df = self._stored(key)
        self.seen |= tables_read(df)
        return df


# Column names of the published marts.
CALLS_TEXT = """
SELECT portid, portname, country, country_iso3, continent, calls_year, calls_month,
       make_date(calls_year, calls_month, :first_day) AS month_start,
       calls_container, calls_dry_bulk, calls_general_cargo, calls_roro, calls_tanker, calls_total
FROM {calls} INNER JOIN {ports} USING (portid)
"""

CONNECTIONS_TEXT = """
WITH far AS (SELECT portid AS to_portid, continent AS to_continent FROM {ports})
SELECT from_portid, from_portname, from_country, from_iso3, to_portid, to_portname, to_country, to_iso3, to_continent,
       average_transit_days, daily_capacity_at_risk, relative_capacity_at_risk,
       from_iso3 = to_iso3 AS is_domestic, rank_from_port, rank_to_port
FROM {ranked} LEFT JOIN far USING (to_portid)
"""


def calls_by_month(calls: str, ports: str) -> MartText:
    """Monthly calls with the port they belong to, from the keys of the two tables."""
    return MartText(CALLS_TEXT, {"calls": calls, "ports": ports}, {"first_day": 1})


def connection_summary(pairs: str, ports: str) -> MartText:
    """Port pairs with their ranks at either end and the far continent."""
    return MartText(CONNECTIONS_TEXT, {"ranked": Derived(ranked_pairs, (pairs,)), "ports": ports})
