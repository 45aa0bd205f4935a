"""Landing, reading back, incremental loading and the daily job."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from arrearium.plans import daily
from arrearium.session import scratch_path
from arrearium.sources import bronze, ingest
from arrearium.sources.specs import A_PAYMENTS, B_PAYMENTS, FEEDS, item_id
from catalog.kpis import SNAP
from catalog.registry import dbl, query, ts, txt
from catalog.tables import AS_OF, RULES, VIEWS, Tables, present

# ---- raw shapes built from the silver views ----------------------------------------


def _z(c: str):
    return F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def raw_payments(t: Tables, day=None):
    p = t.a_payments
    return p.select(
        F.lit(day or AS_OF).cast("date").alias("ingest_date"),
        F.col("transaction_id").alias("transactionId"),
        F.col("contract_number").alias("contractNumber"),
        _z("payment_date").alias("date"),
        F.format_number("amount", 2).alias("amount"),
        "status",
        F.col("payment_code").alias("paymentCode"),
        F.struct(F.lit("E1").alias("name")).alias("entity"),
    )


def raw_contracts(t: Tables):
    return t.a_contracts.select(
        F.lit(AS_OF).alias("ingest_date"),
        F.col("contract_number").alias("contractNumber"),
        "status",
        F.col("deal_type").alias("type"),
        _z("signing_date").alias("signingDate"),
        _z("last_status_update").alias("lastStatusUpdate"),
        _z("next_status_update").alias("nextStatusUpdate"),
        _z("paid_off_date").alias("paidOffDate"),
        _z("repossession_date").alias("repossessionDate"),
        F.col("total_cost").cast("string").alias("totalCost"),
        F.col("total_paid").cast("string").alias("totalPaid"),
        F.col("remaining_debt").cast("string").alias("remainingDebt"),
        F.struct(F.col("paid_off_status").alias("status")).alias("paidOff"),
        F.struct(
            F.col("upfront_payment").cast("string").alias("upfrontPayment"),
            F.col("monthly_payment").cast("string").alias("recurrentPayment"),
        ).alias("pricingSchedule"),
        F.struct(F.col("product_name").alias("name")).alias("product"),
        F.col("asset_number").alias("paygNumber"),
        F.struct(F.col("entity_name").alias("name")).alias("entity"),
        F.struct(
            F.col("client_number").alias("clientNumber"),
            F.struct(
                F.col("customer_name").alias("firstName"), "region",
                F.col("sub_prefecture").alias("commune"), "district", "village",
            ).alias("profile"),
        ).alias("client"),
        F.struct(
            F.col("agent_number").alias("agentNumber"),
            F.struct(F.col("agent_name").alias("firstName")).alias("profile"),
        ).alias("agent"),
    )


def raw_assets(t: Tables):
    return t.a_assets.select(
        F.lit(AS_OF).alias("ingest_date"),
        F.col("payg_number").alias("paygNumber"),
        F.col("serial_number").alias("serialNumber"),
        "status",
        _z("deploy_date").alias("deployDate"),
        _z("date_added").alias("dateAdded"),
        F.struct(F.col("contract_number").alias("contractNumber")).alias("contract"),
    )


PAYMENT_SQL = f"""
    SELECT transaction_id, contract_number, {ts('payment_date')} AS payment_date, {dbl('amount')} AS amount,
     status, payment_code, 'E1' AS entity_name FROM a_payments"""


@query("src_json_pages", PAYMENT_SQL)
def src_json_pages(t: Tables):
    path = scratch_path(t.spark, "pages")
    bronze.land_items(raw_payments(t), path)
    items = bronze.read_items(t.spark, path)
    return present(
        A_PAYMENTS.rows(items).select(
            "transaction_id", "contract_number", "payment_date", "amount", "status", "payment_code", "entity_name"
        )
    )


@query(
    "src_json_typed",
    f"""SELECT status, payment_code, count(*) AS n, {dbl('sum(amount)')} AS amount FROM a_payments GROUP BY 1, 2""",
)
def src_json_typed(t: Tables):
    path = scratch_path(t.spark, "pages")
    bronze.land_items(raw_payments(t), path)
    typed = bronze.read_pages(t.spark, path, "amount string, status string, paymentCode string")
    return present(
        typed.groupBy("status", F.col("paymentCode").alias("payment_code")).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.translate("amount", ",", "").cast("decimal(18,2)")).alias("amount"),
        )
    )


@query(
    "src_csv_strings",
    f"""SELECT transaction_id, {ts('paid_time')} AS paid_time, payment_status, account, {dbl('amount')} AS amount FROM b_payments""",
)
def src_csv_strings(t: Tables):
    path = scratch_path(t.spark, "csv")
    export = t.b_payments.select(
        F.lit(AS_OF).alias("ingest_date"),
        F.col("transaction_id").alias("ID"),
        F.col("paid_time").cast("string").alias("Paid Time"),
        F.coalesce("payment_status", F.lit("N/A")).alias("Payment Status"),
        F.concat(F.lit(" "), "account").alias("Account"),
        F.format_number("amount", 2).alias("Amount"),
    )
    bronze.land_csv(export, path)
    rows = B_PAYMENTS.rows(bronze.read_csv_export(t.spark, path))
    return present(B_PAYMENTS.current(rows).select("transaction_id", "paid_time", "payment_status", "account", "amount"))


def _land_events(t: Tables):
    path = scratch_path(t.spark, "events")
    raw = t.fx_events.select(
        F.col("ts").cast("date").alias("ingest_date"), F.col("event_id").cast("string").alias("_id"),
        F.col("event_type").alias("type"), F.col("amount").cast("string").alias("value"),
    )
    # One shuffle by day, so each day's folder gets few files.
    bronze.land_items(raw.hint("rebalance", "ingest_date"), path)
    return path


@query(
    "src_latest_partition",
    f"""SELECT event_id, event_type, {txt('ts')} AS ingest_date FROM fx_events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM fx_events)""",
)
def src_latest_partition(t: Tables):
    path = _land_events(t)
    newest = bronze.latest_date(t.spark, path)
    items = bronze.read_items(t.spark, path, ingest_date=newest)
    from arrearium.functions.jsonpath import json_text

    raw = F.col("raw")
    return present(
        items.select(
            json_text(raw, "_id").cast("bigint").alias("event_id"), json_text(raw, "type").alias("event_type"),
            "ingest_date",
        )
    )


@query(
    "sink_bronze_landing",
    f"""SELECT {txt('ts')} AS ingest_date, event_type, count(*) AS n, {dbl('sum(amount)')} AS value FROM fx_events GROUP BY 1, 2""",
)
def sink_bronze_landing(t: Tables):
    path = _land_events(t)
    back = bronze.read_pages(t.spark, path, "_id string, type string, value string, ingest_date date")
    return present(
        back.groupBy("ingest_date", F.col("type").alias("event_type")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value")
        )
    )


@query(
    "incremental_or_filter",
    f"""SELECT contract_number, {ts('signing_date')} AS signing_date, {ts('next_status_update')} AS next_status_update FROM a_contracts
    WHERE signing_date >= TIMESTAMP '2001-01-01' OR last_status_update >= TIMESTAMP '2001-01-01'
     OR next_status_update >= TIMESTAMP '2001-06-01' AND next_status_update >= TIMESTAMP '2001-01-01'
     OR next_status_update >= TIMESTAMP '2001-01-01'""",
)
def incremental_or_filter(t: Tables):
    changed = ingest.changed_since(
        t.a_contracts, ["signing_date", "last_status_update", "next_status_update"], "2001-01-01"
    )
    return present(changed.select("contract_number", "signing_date", "next_status_update"))


@query(
    "watermark_ledger",
    f"""SELECT source, entity, {txt('run_date - INTERVAL 1 DAY')} AS watermark FROM (
      SELECT *, row_number() OVER (PARTITION BY source, entity ORDER BY run_at DESC) AS pos FROM run_log
      WHERE status = 'success') WHERE pos = 1
    UNION ALL SELECT 'nobody', 'nothing', '2023-08-01'""",
)
def watermark_ledger(t: Tables):
    first_run = ingest.watermark_for(t.run_log, "nobody", "nothing", "2023-08-01").select(
        F.lit("nobody").alias("source"), F.lit("nothing").alias("entity"), "watermark"
    )
    return present(ingest.watermarks(t.run_log).unionByName(first_run))


@query(
    "watermark_from_data",
    f"""SELECT 'three columns' AS rule, {txt('''greatest(max(signing_date), max(paid_off_date), max(repossession_date))
      - INTERVAL 1 DAY''')} AS watermark FROM a_contracts
    UNION ALL SELECT 'empty table', '1969-12-31' UNION ALL SELECT 'default', '2020-01-01'""",
)
def watermark_from_data(t: Tables):
    cols = ["signing_date", "paid_off_date", "repossession_date"]
    none = t.a_contracts.filter("contract_number = 'none'")
    parts = [
        ("three columns", ingest.watermark_from_data(t.a_contracts, cols)),
        ("empty table", ingest.watermark_from_data(none, cols)),
        ("default", ingest.watermark_from_data(none, cols[:1], epoch_when_empty=False, default_start="2020-01-01")),
    ]
    rows = [df.select(F.lit(rule).alias("rule"), "watermark") for rule, df in parts]
    return present(rows[0].unionByName(rows[1]).unionByName(rows[2]))


@query(
    "watermark_from_footers",
    f"""SELECT {txt('max(paid_time) - INTERVAL 1 DAY')} AS watermark, true AS in_footers FROM b_payments""",
)
def watermark_from_footers(t: Tables):
    """The newest date of a stored table without reading its rows."""
    path = scratch_path(t.spark, "payments")
    t.b_payments.write.parquet(path)
    plan = ingest.newest_in_footers(t.spark, path, ["paid_time"])._jdf.queryExecution().executedPlan().toString()
    pushed = "PushedAggregation: [MAX(paid_time)]" in plan
    mark = ingest.watermark_from_footers(t.spark, path, ["paid_time"])
    return present(mark.withColumn("in_footers", F.lit(pushed)))


VIEWS["paged_events"] = "SELECT CAST(floor(event_id / 50) AS INT) AS page, asset_id FROM fx_events"


@query(
    "audit_duplicate_pages",
    """SELECT page, count(*) AS n_rows, count(DISTINCT CASE WHEN first_page = page THEN asset_id END) AS new_ids,
     count(DISTINCT CASE WHEN first_page = page THEN asset_id END) = 0 AS is_replay
    FROM (SELECT page, asset_id, min(page) OVER (PARTITION BY asset_id) AS first_page FROM paged_events) GROUP BY page""",
)
def audit_duplicate_pages(t: Tables):
    return ingest.page_audit(t.paged_events, "page", "asset_id")


@query(
    "audit_item_ids",
    """SELECT CAST(event_id AS VARCHAR) AS item_id, count(*) AS n FROM fx_events GROUP BY 1""",
)
def audit_item_ids(t: Tables):
    items = bronze.read_items(t.spark, _land_events(t))
    return items.groupBy(item_id(FEEDS["asset_events"], F.col("raw")).alias("item_id")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "run_ledger",
    f"""SELECT 'a' AS source, 'events' AS entity, '2001-08-31' AS run_date, 'success' AS status, count(*) AS rows_count,
     {dbl('sum(amount)')} AS landed_value FROM fx_events
    UNION ALL SELECT 'a', 'tasks', '2001-08-31', 'partial', 0, NULL""",
)
def run_ledger(t: Tables):
    path, ledger = scratch_path(t.spark, "landed"), scratch_path(t.spark, "ledger")
    seen = Observation()
    rows = t.fx_events.observe(seen, F.count(F.lit(1)).alias("n"), F.sum("amount").alias("value"))
    rows.write.parquet(path)
    at = datetime(2001, 8, 31, 6)
    done = ingest.ledger_row(t.spark, "r1", "a", "events", at, "success", rows_count=seen.get["n"], landed_path=path)
    stopped = ingest.ledger_row(t.spark, "r2", "a", "tasks", at, "partial", error_message="page 3")
    for row in (done, stopped):
        ingest.append_ledger(row, ledger)
    log = t.spark.read.parquet(ledger)
    return present(
        log.select(
            "source", "entity", "run_date", "status", "rows_count",
            F.when(F.col("run_id") == "r1", F.lit(seen.get["value"])).alias("landed_value"),
        )
    )


@query(
    "daily_medallion",
    f"SELECT '2001-08-31' AS snapshot_date, {SNAP} FROM g1 WHERE contract_status <> 'CANCELLED'",
)
def daily_medallion(t: Tables):
    root = scratch_path(t.spark, "lake")
    for name, raw in (("contracts", raw_contracts(t)), ("payments", raw_payments(t)), ("assets", raw_assets(t))):
        bronze.land_items(raw, bronze.entity_path(f"{root}/bronze", "a", name))
    snapshot = daily.run_daily(
        t.spark, f"{root}/bronze", f"{root}/silver", f"{root}/snapshots", f"{root}/ledger",
        t.b_contracts, t.b_payments, t.fx_asset_map, t.b_ledger, t.b_products, t.fx_exclusions, t.b_paid_off,
        AS_OF, RULES,
    )
    return present(snapshot)


@query(
    "daily_rerun",
    f"SELECT '2001-08-31' AS snapshot_date, {SNAP} FROM g1 WHERE contract_status <> 'CANCELLED'",
)
def daily_rerun(t: Tables):
    """Day one with half of the items, day two with all of them, and day two again."""
    root = scratch_path(t.spark, "lake")
    items = {"contracts": raw_contracts(t), "payments": raw_payments(t), "assets": raw_assets(t)}
    first = date(2001, 8, 30)

    def land(part, day: date) -> None:
        for name, raw in items.items():
            rows = raw.where(part).withColumn("ingest_date", F.lit(day))
            bronze.land_items(rows, bronze.entity_path(f"{root}/bronze", "a", name))

    def run(day: date):
        return daily.run_daily(
            t.spark, f"{root}/bronze", f"{root}/silver", f"{root}/snapshots", f"{root}/ledger",
            t.b_contracts, t.b_payments, t.fx_asset_map, t.b_ledger, t.b_products, t.fx_exclusions, t.b_paid_off,
            day, RULES,
        )

    land(F.col("status").isNotNull() & (F.length("status") % 2 == 0), first)
    run(first)
    land(F.lit(True), AS_OF)
    for _ in range(2):
        snapshot = run(AS_OF)
    return present(snapshot)


def _exports(t: Tables) -> dict[str, DataFrame]:
    """The tables of system B as their exports write them."""
    def texts(df: DataFrame, names: dict[str, str]) -> DataFrame:
        return df.select(F.lit(AS_OF).alias("ingest_date"), *[F.col(c).cast("string").alias(header) for c, header in names.items()])

    same = ("customer_id", "customer_name", "status", "region", "district", "ward", "financial_type", "unlocked_until", "paid_at", "activated_at", "removed_at", "installed_by")
    products = {"installation_id": "contract_number"} | {c: c for c in ("asset_number", "product_name", "deal_type", "total_contract_value", "upfront_payment", "monthly_payment")}
    ledger = {
        "contract_ogc": "Contract", "installation_id": "Installation Id", "posting_date": "Posting Date",
        "total_cash_collected": "Total Cash Collected from Customer", "ending_principal": "Ending Balance Principal",
    }
    return {
        "contracts": texts(t.b_contracts, {"installation_id": "id"} | {c: c for c in same}),
        "payments": texts(t.b_payments, {"transaction_id": "ID", "paid_time": "Paid Time", "payment_status": "Payment Status", "account": "Account", "amount": "Amount"}),
        "asset_map": texts(t.fx_asset_map, {"asset_number": "asset_number", "installation_id": "contract_number"}),
        "lease_ledger": texts(t.b_ledger, ledger),
        "products": texts(t.b_products, products),
    }


@query(
    "daily_both_systems",
    f"""SELECT '2001-08-31' AS snapshot_date, {SNAP} FROM g1 WHERE contract_status <> 'CANCELLED'
     AND contract_number NOT IN (SELECT installation_id FROM b_contracts WHERE activated_at IS NULL)""",
)
def daily_both_systems(t: Tables):
    """The daily job from landed pages of system A and landed exports of system B, which leave out what was never activated."""
    root = scratch_path(t.spark, "lake")
    for name, raw in (("contracts", raw_contracts(t)), ("payments", raw_payments(t)), ("assets", raw_assets(t))):
        bronze.land_items(raw, bronze.entity_path(f"{root}/bronze", "a", name))
    for name, raw in _exports(t).items():
        bronze.land_csv(raw, bronze.entity_path(f"{root}/bronze", "b", name), compressed=True)
    snapshot = daily.run_daily(
        t.spark, f"{root}/bronze", f"{root}/silver", f"{root}/snapshots", f"{root}/ledger", None, None, None, None, None,
        t.fx_exclusions, t.b_paid_off, AS_OF, RULES,
    )
    return present(snapshot)
