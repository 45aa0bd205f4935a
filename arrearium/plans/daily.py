"""The daily job: bronze -> silver -> unified contracts -> snapshot of the day."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from time import monotonic

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearium.operators.fold import fold_versions, upsert_touched
from arrearium.operators.slices import replace_slice
from arrearium.operators.versioned import BucketTable, Merged
from arrearium.plans.contracts import b_financials, unified_contracts
from arrearium.plans.snapshots import daily_snapshot
from arrearium.rules import PortfolioRules
from arrearium.session import scratch_path, shuffles_freed
from arrearium.sources import bronze
from arrearium.sources.ingest import append_ledger, ledger_row
from arrearium.sources.specs import (
    A_ASSETS, A_CONTRACTS, A_PAYMENTS, B_ASSET_MAP, B_CONTRACTS, B_LEASE_LEDGER, B_PAYMENTS, B_PRODUCTS, EntitySpec,
)


def refresh_silver(
    spark: SparkSession,
    spec: EntitySpec,
    bronze_path: str,
    out_path: str,
    previous_path: str | None = None,
    ingest_date: str | None = None,
) -> DataFrame:
    """Write a new version of a silver table and return it.

    With a previous version only the items of ``ingest_date`` are read, and only the
    keys they touch are folded.  Without one, all landed pages are replayed.  A run that
    is repeated replaces what the last attempt wrote.  ``loaded_at`` and ``updated_at``
    are the ingest dates of a key's first and last version.
    """
    if out_path == previous_path:
        raise ValueError("a new version needs a path of its own")
    read = bronze.read_items if spec.raw_schema is not None else bronze.read_csv_export
    rows = spec.rows(read(spark, bronze_path, ingest_date=ingest_date if previous_path else None))
    times = F.col("ingest_date").cast("timestamp")
    rows = spec.batch_rows(rows).withColumns({"loaded_at": times, "updated_at": times})
    changing = [c for c in spec.changing(rows) if c not in ("loaded_at", "updated_at")] + ["updated_at"]
    order = [c for c in bronze.ITEM_ORDER if c in rows.columns]
    if previous_path is None:
        table = fold_versions(rows, spec.keys, changing, order)
    else:
        # Stored once: the batch is read twice below, and its file size tells the
        # planner whether its keys can be broadcast.
        staged = scratch_path(spark, "batch")
        rows.write.parquet(staged)
        table = upsert_touched(
            spark.read.parquet(previous_path), spark.read.parquet(staged), spec.keys, changing, order
        )
    table.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def refresh_table(
    spark: SparkSession, spec: EntitySpec, bronze_path: str, table: BucketTable, upto: str | None = None
) -> Merged | None:
    """Fold every landing into a silver table that its newest version does not hold yet; None if there is none.

    The versions know the landings they were made from, so a day whose job failed, a day that landed late and a landing
    that grew are read by the next run, whatever its date.  Items take their place by date, landing and position: a late
    old item does not override a newer one.  Landings after ``upto`` wait.
    """
    held = table.manifest().sources
    found = {place: size for place, size in bronze.landings(spark, bronze_path).items() if held.get(place) != size}
    if upto is not None:
        found = {place: size for place, size in found.items() if place.split("/")[0].removeprefix("ingest_date=") <= upto}
    if not found:
        return None
    read = bronze.read_items if spec.raw_schema is not None else bronze.read_csv_export
    one_date = len({place.split("/")[0] for place in found}) == 1
    rows = spec.batch_rows(spec.rows(read(spark, bronze_path, only=sorted(found))), one_date)
    times = F.col("ingest_date").cast("timestamp")
    rows = rows.withColumns({"loaded_at": times, "updated_at": times})
    changing = [c for c in spec.changing(rows) if c not in ("loaded_at", "updated_at")] + ["updated_at"]
    # Copies of a key are resolved within a date, so those of one date are one row a key.
    one_a_key = spec.in_batch != "all" and one_date
    return table.merge(rows, changing, [c for c in bronze.ITEM_ORDER if c in rows.columns], found, one_a_key)


def run_daily(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    snapshot_path: str,
    ledger_path: str,
    b_contracts: DataFrame | None,
    b_payments: DataFrame | None,
    asset_map: DataFrame | None,
    lease_ledger: DataFrame | None,
    products: DataFrame | None,
    excluded: DataFrame,
    paid_off: DataFrame,
    as_of: date,
    rules: PortfolioRules,
    entities: tuple[EntitySpec, ...] = (A_CONTRACTS, A_PAYMENTS, A_ASSETS),
) -> DataFrame:
    """One day, in order; the first failure ends the run.  Returns the day's snapshot.

    Silver tables live below ``silver_root`` from day to day, a version for each run that finds new landings.  A table of
    system B that is None is refreshed from its landed exports like the entities.  Each entity and the snapshot get a row
    in the ledger with the rows landed, also the one that fails, so an entity's watermark moves with its own success
    only.  A day can be run again.
    """
    day = as_of.isoformat()
    run_at = datetime(as_of.year, as_of.month, as_of.day)
    given = [
        (B_CONTRACTS, b_contracts), (B_PAYMENTS, b_payments), (B_ASSET_MAP, asset_map), (B_LEASE_LEDGER, lease_ledger),
        (B_PRODUCTS, products),
    ]

    def step(source: str, entity: str, path: str, work: Callable[[], int]) -> None:
        started = monotonic()

        def log(status: str, rows: int = 0, error: str | None = None) -> None:
            row = ledger_row(
                spark, f"{entity}-{day}", source, entity, run_at, status, rows_count=rows, landed_path=path,
                error_message=error, duration_sec=monotonic() - started,
            )
            append_ledger(row, ledger_path)

        try:
            with shuffles_freed(spark):
                rows = work()
        except Exception as e:
            log("error", error=str(e)[:1000])
            raise
        log("success", rows)

    silver = {spec.name: table for spec, table in given if table is not None}

    def refresh(spec: EntitySpec) -> int:
        source, name = spec.name.split("_", 1)
        table = BucketTable(spark, f"{silver_root}/{spec.name}", spec.keys)
        done = refresh_table(spark, spec, bronze.entity_path(bronze_root, source, name), table, day)
        silver[spec.name] = table.read()
        return done.rows if done else 0

    def snapshot() -> int:
        # Stored once for the snapshot and for whoever reports on the day.
        unified_contracts(
            silver["a_contracts"],
            silver["a_assets"],
            silver["b_contracts"],
            b_financials(silver["b_payments"], silver["b_asset_map"], silver["b_lease_ledger"]),
            silver["b_products"],
            excluded,
            paid_off,
            rules,
            as_of,
        ).write.mode("overwrite").parquet(f"{silver_root}/unified_contracts")
        contracts = spark.read.parquet(f"{silver_root}/unified_contracts")
        return replace_slice(daily_snapshot(contracts, as_of), snapshot_path, "snapshot_date", day)

    for spec in (*entities, *(spec for spec, table in given if table is None)):
        step(spec.name.split("_", 1)[0], spec.name, f"{silver_root}/{spec.name}", lambda spec=spec: refresh(spec))
    step("gold", "unified_snapshot", snapshot_path, snapshot)
    snapshots = spark.read.parquet(snapshot_path)
    return snapshots.filter(snapshots["snapshot_date"] == as_of)
