"""The daily run: land, ingest, stage, snapshot, publish, check.

Steps share only table and folder names, so each can be run again on its own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import new_run_id
from ..operators.aggregates import batch_counts
from ..operators.quality import check_not_null, settle
from ..operators.stamp import enrich
from ..schemas import ENTITY_SPECS, HISTORY_SPECS, REQUIRED_COLUMNS, entity_spec
from ..sources.catalog import attach_table, ensure_namespaces, publish_partitions, publish_table, publish_view
from ..sources.json_batches import bronze_batches, committed_batches, land_json, read_bronze
from ..sources.latest_store import LatestStore
from ..sources.ledger import BatchLedger
from ..sources.run_store import RUN, RunStore
from ..sources.seed_csv import read_seed
from ..sources.snapshot_store import SnapshotStore
from ..streaming.ingest import ingest_new_files
from .marts import build_fact, dim_customer, dim_date, dim_product
from .staging import stg_carts, stg_products, stg_users

_STAGING: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "staging.stg_products": ("products", stg_products),
    "staging.stg_users": ("users", stg_users),
    "staging.stg_carts": ("carts", stg_carts),
}
_SNAPSHOT_SOURCE = {"products": "staging.stg_products", "customers": "staging.stg_users"}


@dataclass(frozen=True)
class Lake:
    """Folders of one deployment; every one must be reachable by all executors."""

    landing: str
    root: str
    seed: str

    def history(self, spark: SparkSession, name: str) -> SnapshotStore:
        return SnapshotStore(spark, f"{self.root}/snapshots/{name}", HISTORY_SPECS[name])


def land(
    frames: Mapping[str, DataFrame], lake: Lake, source: str, now: datetime, run_id: str | None = None
) -> tuple[dict[str, str], str]:
    """Stamp and land one extract of every entity; returns the locations and the run id.

    All entities of a run share its id and instant. The locations can be handed to ``load_run``,
    or left for ``ingest`` to find.
    """
    run_id = run_id or new_run_id()
    for entity in frames:
        entity_spec(entity)
    locations = {
        entity: land_json(enrich(df, entity, source, run_id, now), entity, lake.landing, now)
        for entity, df in frames.items()
    }
    return locations, run_id


def ingest(spark: SparkSession, lake: Lake, layout: str | None = None) -> dict[str, dict[str, int]]:
    """Load landed files not loaded before, each in the layout it has; returns the counts per entity."""
    return {
        entity: ingest_new_files(spark, entity, lake.landing, lake.root, layout)
        for entity in ENTITY_SPECS
    }


def stage(spark: SparkSession, lake: Lake, incremental: bool = False) -> None:
    """Rebuild the staging tables.

    By default from all of bronze. ``incremental`` starts products and users from the latest
    row per key of the previous run and reads only the batches loaded since; of carts, which are keyed by run, only the
    runs that those batches touch are rebuilt. The history of full extracts is not scanned again.
    """
    ensure_namespaces(spark)
    for table, (entity, model) in _STAGING.items():
        if incremental and entity == "carts":
            store = cart_runs(spark, lake)
            changed = store.advance()
            publish_partitions(spark, table, store.schema(), RUN, store.paths("model"), changed, f"{lake.root}/tables")
            continue
        if incremental:
            bronze = LatestStore(spark, lake.root, entity, ["id"]).advance()
        else:
            bronze = read_bronze(spark, entity, lake.root)
        publish_table(model(bronze), table, f"{lake.root}/tables")


def cart_runs(spark: SparkSession, lake: Lake) -> RunStore:
    return RunStore(spark, lake.root, "carts", ["id"], stg_carts)


def attach(spark: SparkSession, lake: Lake) -> None:
    """Register the staging tables of earlier runs in a session without a metastore; known ones stay as they are."""
    ensure_namespaces(spark)
    for table, (entity, _) in _STAGING.items():
        if entity == "carts" and not spark.catalog.tableExists(table):
            store = cart_runs(spark, lake)
            if store.runs():
                publish_partitions(spark, table, store.schema(), RUN, store.paths("model"), (), f"{lake.root}/tables")
                continue
        attach_table(spark, table, f"{lake.root}/tables")


def snapshot(spark: SparkSession, lake: Lake, now: datetime) -> None:
    """Compare staging with the open versions and record what changed."""
    attach(spark, lake)
    for name, table in _SNAPSHOT_SOURCE.items():
        lake.history(spark, name).advance(spark.table(table), now)


def publish(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Publish the star as views over the latest snapshots and staging tables."""
    attach(spark, lake)
    products = dim_product(lake.history(spark, "products").read())
    customers = dim_customer(lake.history(spark, "customers").read())
    dates = dim_date(spark)
    fact = build_fact(
        spark.table("staging.stg_carts"), read_seed(spark, lake.seed), products, customers, dates
    )
    views = {
        "dim_date": dates,
        "dim_product": products,
        "dim_customer": customers,
        "fact_order_items": fact,
    }
    for name, df in views.items():
        publish_view(df, name)
    return views


def check(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """The required columns of the bronze tables; raises ``CheckFailed`` on any NULL.

    NULLs were counted while each batch was loaded; only batches without such a note are scanned.
    """
    results: dict[str, int] = {}
    scans = []
    for entity, columns in REQUIRED_COLUMNS.items():
        done, _ = committed_batches(spark, entity, lake.root)
        notes = BatchLedger(spark, lake.root, entity).notes()
        for column in columns:
            known = sum(notes[b]["nulls"].get(column, 0) for b in done if b in notes)
            results[f"raw.{entity}.{column} not_null"] = known
        unknown = [b for b in done if b not in notes]
        if unknown:
            rows = bronze_batches(spark, entity, lake.root).filter(F.col("batch").isin(*unknown))
            scans.append(check_not_null(rows, columns, f"raw.{entity}."))
    return settle(results, scans)


def refresh(
    spark: SparkSession,
    lake: Lake,
    now: datetime,
    layout: str | None = None,
    incremental: bool = False,
) -> dict[str, dict[str, int]]:
    """All steps in order. A failing step stops the run; rerun from that step."""
    loaded = ingest(spark, lake, layout)
    stage(spark, lake, incremental)
    snapshot(spark, lake, now)
    publish(spark, lake)
    check(spark, lake)
    return loaded


def loaded_rows(spark: SparkSession, lake: Lake, entity: str) -> int:
    """Rows of a bronze table, added up from the notes of its batches; batches without one are counted."""
    done, _ = committed_batches(spark, entity, lake.root)
    notes = BatchLedger(spark, lake.root, entity).notes()
    unknown = [b for b in done if b not in notes]
    rows = sum(notes[b]["counts"]["loaded"] for b in done if b in notes)
    if unknown:
        rows += bronze_batches(spark, entity, lake.root).filter(F.col("batch").isin(*unknown)).count()
    return rows


def expected_counts(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Rows per table after a run: of bronze from the batches' notes, the others counted in one job."""
    frames = {table: spark.table(table) for table in _STAGING}
    frames |= {f"snapshot.{n}": lake.history(spark, n).read() for n in HISTORY_SPECS}
    frames |= {n: spark.table(n) for n in ("dim_date", "dim_product", "dim_customer", "fact_order_items")}
    counts = batch_counts(frames).filter(F.col("entity") != "total").collect()
    found = {f"raw.{e}": loaded_rows(spark, lake, e) for e in ENTITY_SPECS}
    return found | {row["entity"]: row["records"] for row in counts}
