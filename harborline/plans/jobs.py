"""Run the published tables in the order their upstreams ask for."""

from __future__ import annotations

from dataclasses import replace
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession, functions as F

from harborline.operators.observed import TableFigures
from harborline.operators.quality import Query, row_parity, run_checks
from harborline.operators.upserts import assert_key
from harborline.plans import catalog
from harborline.plans.assets import ASSETS, Asset, Inputs, page_shape
from harborline.plans.catalog import Catalog, Run
from harborline.plans.marts import Reads, tables_read
from harborline.session import scratch_scope, stage
from harborline.sinks.tables import TableStore
from harborline.sources import landed, schemas

RECORD_SHAPES = {
    "countries": schemas.COUNTRY_RECORD,
    "traffic": schemas.INDICATOR_RECORD,
    "ports": schemas.PORT_ATTRIBUTES,
    "connections": schemas.CONNECTION_ATTRIBUTES,
}


class QualityFailure(RuntimeError):
    """A check failed and the run was told to enforce checks."""


def landed_inputs(
    spark: SparkSession, folder: str, store: TableStore, packed: bool = False, shapes=None, page_steps=None
) -> Inputs:
    """Inputs from ``<folder>/<name>`` page bodies and the daily layer in ``<folder>/daily_calls``.

    ``page_steps`` names the page size of landings whose pages are numbered by offset (0, 1000, 2000, ...).
    """
    return Inputs(
        spark=spark,
        bodies=lambda name: landed.read_bodies(spark, f"{folder}/{name}", packed),
        daily=lambda: spark.read.parquet(f"{folder}/daily_calls"),
        stored=store.read,
        record_shapes={**RECORD_SHAPES, **(shapes or {})},
        page_steps=dict(page_steps or {}),
    )


def in_order(assets) -> list[Asset]:
    """Upstreams first; an upstream outside the selection is taken as stored already."""
    by_key = {a.key: a for a in assets}
    graph = {a.key: [u for u in a.upstreams if u in by_key] for a in by_key.values()}
    return [by_key[k] for k in TopologicalSorter(graph).static_order()]


def run_jobs(
    store: TableStore, inputs: Inputs, run: Run, assets=ASSETS, enforce: bool = False, refresh_docs: bool = False
) -> None:
    """Build, check and publish every asset; what was done is recorded even if a later one fails.

    ``enforce`` turns the advisory checks into a gate before publication. Scratch tables of the run are deleted.
    """
    record = Catalog(store)
    inputs.forget()
    with scratch_scope(store.spark):
        try:
            for asset in in_order(assets):
                _run_one(asset, store, inputs, run, record, enforce)
        finally:
            record.flush(refresh_docs)
            inputs.forget()


def _run_one(asset: Asset, store: TableStore, inputs: Inputs, run: Run, record: Catalog, enforce: bool) -> None:
    """One asset. Its batch is written once, and that write takes every figure the registry and the checks need."""
    spark = store.spark
    pages, landed_counts, unlisted = _landed_checks(asset, inputs)
    reads = Reads(inputs.stored)
    built = asset.build(replace(inputs, stored=reads))
    upstreams = _upstreams(asset, store, reads.seen | tables_read(built))
    built = catalog.with_docs(built, asset.docs)
    figures = TableFigures(built, asset.checks, asset.spans, asset.distincts)
    content = None
    if asset.write == "replace":
        # Written as the table's next content, and published after the checks.
        content = store.prepare(asset.key, built, figures=figures, layout=asset.layout)
        incoming = store.prepared(content)
    else:
        incoming = stage(figures.on(built), asset.key.replace(".", "-"))
    batch = incoming.drop(*asset.position)
    if asset.enforce_key:
        assert_key(batch, asset.keys, asset.key)
    results = run_checks(batch, asset.key, (*pages, *asset.checks), run.at, figures.measured())
    record.add(catalog.CHECK_TABLE, results)
    failed = [r["check_name"] for r in results.where(~F.col("passed")).collect()] if enforce else []
    if failed:
        raise QualityFailure(f"{asset.key}: {', '.join(failed)}")

    if content:
        store.publish(content)
        stored, stored_rows = batch, figures.rows
    elif asset.write == "reload":
        stored, stored_rows = store.reload(asset.key, batch), figures.rows
    else:
        stored = store.upsert(asset.key, incoming, asset.keys, asset.partition_by, asset.position, staged=True)
        # Counted from file footers: no column is read.
        stored_rows = stored.count()

    record.add(catalog.ASSET_TABLE, catalog.asset_row(spark, asset, run, stored_rows, figures.rows))
    metrics = [(f"landed_{name}", n) for name, n in landed_counts.items()]
    metrics += [(m, n) for m, n in figures.metrics() if m.removeprefix("nulls.") not in asset.position]
    record.add(catalog.METRIC_TABLE, catalog.metric_rows(spark, asset.key, metrics))
    if figures.sketches():
        record.add(catalog.SKETCH_TABLE, catalog.sketch_rows(spark, asset.key, run, figures.sketches()))
    if asset.docs:
        fields = catalog.written_fields(spark, batch.schema, asset.key, asset.docs, figures.rows, figures.filled())
        record.add(catalog.FIELD_TABLE, fields)
    if asset.layer == "mart":
        record.add(catalog.EDGE_TABLE, catalog.edges_to(spark, asset.key, upstreams))
    if unlisted is not None:
        record.add(catalog.UNLISTED_TABLE, unlisted.select(F.lit(asset.key).alias("asset_key"), "*"))
    if asset.parity_with:
        record.add(catalog.CHECK_TABLE, _parity_result(asset, stored, store.read(asset.parity_with), run))


def _upstreams(asset: Asset, store: TableStore, found: set[str]) -> list[str]:
    """The published tables a build really read. One it did not declare may not have been built yet: an error."""
    keys = sorted(name.removeprefix(store.namespace) for name in found)
    undeclared = [key for key in keys if key not in asset.upstreams]
    if undeclared:
        raise ValueError(f"{asset.key} reads {', '.join(undeclared)} without declaring it")
    return keys


def _parity_result(asset: Asset, stored: DataFrame, raw: DataFrame, run: Run) -> DataFrame:
    found = row_parity(stored, raw).select(
        F.lit(asset.key).alias("asset_key"), F.lit("every_row_has_a_named_port").alias("check_name"), "passed",
        F.abs(F.col("raw_rows") - F.col("mart_rows")).alias("bad"), "detail",
        F.lit(run.at).cast("timestamp").alias("checked_at"),
    )
    return stored.sparkSession.createDataFrame(found.collect(), found.schema)


def _landed_checks(asset: Asset, inputs: Inputs) -> tuple[tuple[Query, ...], dict[str, int], DataFrame | None]:
    """What the landed pages of an asset must hold before anything is filtered, the counts of their one parse, and the
    fields that the asset's list of columns leaves behind.

    A field that no landed record carries is schema drift and stops the job. Pages that
    are missing, repeated or cut off are a failed check, and under ``enforce`` a gate.
    """
    if not asset.landed:
        return (), {}, None
    pages, counts = inputs.parsed(asset.landed)
    # As many rows as the records have fields and types.
    inventory = stage(landed.field_inventory(pages, landed.parents_of(asset.required)), "fields")
    names = [r["field"] for r in landed.absent_fields(inventory, asset.required).collect()] if counts["records"] else []
    if names:
        raise ValueError(f"{asset.key}: landed records never carry {', '.join(sorted(names))}")
    step = inputs.page_steps.get(asset.landed, 1)

    def complete(_: DataFrame) -> DataFrame:
        issues = landed.page_problems(pages, page_shape(asset.landed), step)
        text = F.concat_ws(": ", "issue", F.col("pages").cast("string"))
        # As many rows as there are kinds of issue.
        found = issues.agg(F.array_join(F.array_sort(F.collect_list(text)), "; ").alias("found"), F.sum("pages").alias("bad"))
        return found.select(
            F.col("bad").isNull().alias("passed"), F.coalesce("bad", F.lit(0)).alias("bad"),
            F.when(F.col("bad").isNull(), "all pages are there").otherwise(F.col("found")).alias("detail"),
        )

    return (Query("pages_complete", complete),), counts, landed.unlisted_fields(inventory, asset.required)
