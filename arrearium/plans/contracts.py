"""The unified contract table over both systems."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium.functions.amounts import ZERO, zero_if_null
from arrearium.functions.cleaning import has_text, normal_deal, normal_flag, normal_status
from arrearium.functions.dates import as_timestamp, whole_days_since
from arrearium.operators.fold import latest_per_key
from arrearium.operators.joins import mark, primary_else_fallback
from arrearium.rules import PortfolioRules

COLUMNS = (
    "contract_number", "entite", "source", "categorie", "client_number", "customer_name",
    "agent_number", "agent_name", "paid_date", "registration_date", "last_status_update",
    "next_status_update", "paid_off_date", "repossession_date", "product_name", "asset_number",
    "deal_type", "total_contract_value", "upfront_payment", "monthly_payment", "total_paid",
    "remaining_debt", "contract_status", "paid_off", "region", "sub_prefecture", "village",
    "consecutive_locked_days", "computed_at",
)

MONEY = "decimal(18,2)"


def latest_deployment(a_assets: DataFrame, deployed_only: bool = True) -> DataFrame:
    """Per contract its newest asset by deployment date, undated ones last.

    With ``deployed_only`` only deployed assets count and the date an asset was added
    stands in for a missing deployment date; without it (older definition) any asset
    counts and nothing stands in.
    """
    assets = a_assets.filter(F.col("contract_number").isNotNull())
    day = F.col("deploy_date")
    if deployed_only:
        assets = assets.filter(F.col("status") == "DEPLOYED")
        day = F.coalesce("deploy_date", "date_added")
    rows = assets.select(
        "contract_number", "payg_number", day.alias("deploy_date"), "serial_number",
        F.col("status").alias("asset_status"),
    )
    return latest_per_key(rows, ["contract_number"], F.col("deploy_date"), ["payg_number"])


def deploy_reference(asset_events: DataFrame, a_assets: DataFrame) -> DataFrame:
    """(contract_number, deploy_date): when a contract's first asset was deployed, by the log of asset events.

    Events collapse to an asset's first deployment before they meet the assets, so an asset with many events is one row
    per task.  Undated events, and assets without a contract, say nothing.
    """
    first = (
        asset_events.filter((F.col("event_type") == "DEPLOYED") & F.col("event_date").isNotNull())
        .groupBy(F.col("payg_number").alias("_payg"))
        .agg(F.min("event_date").alias("deploy_date"))
    )
    held = a_assets.filter(F.col("contract_number").isNotNull()).select("payg_number", "contract_number")
    return (
        held.join(first, F.col("payg_number") == F.col("_payg"), "inner")
        .groupBy("contract_number")
        .agg(F.min("deploy_date").cast("date").alias("deploy_date"))
    )


def b_payment_totals(b_payments: DataFrame, asset_map: DataFrame) -> DataFrame:
    """Per installation: sum and newest time of the payments that were not reversed.

    Payments collapse to one row per account before the bridge join.
    """
    per_account = (
        b_payments.filter(F.col("payment_status") != "REVERSED")
        .groupBy("account")
        .agg(F.sum("amount").alias("total_paid"), F.max("paid_time").alias("last_payment_date"))
    )
    link = asset_map.select("asset_number", F.col("installation_id").cast("string").alias("installation_id"))
    return (
        per_account.join(link, per_account["account"] == link["asset_number"], "inner")
        .groupBy("installation_id")
        .agg(
            F.sum("total_paid").cast(MONEY).alias("total_paid"),
            F.max("last_payment_date").cast("timestamp").alias("last_payment_date"),
        )
    )


def ledger_totals(lease_ledger: DataFrame, latest: bool = False) -> DataFrame:
    """Per installation: collected cash in the lease ledger and its newest posting.

    The ledger column is cumulative.  The default sums it over postings, as the source
    tables' consumers do; ``latest`` takes the value of the newest posting instead.
    """
    if latest:
        paid = F.max_by("total_cash_collected", F.struct("posting_date", "contract_ogc"))
    else:
        paid = F.sum("total_cash_collected")
    return (
        lease_ledger.filter(F.col("installation_id").isNotNull())
        .groupBy(F.col("installation_id").cast("string").alias("installation_id"))
        .agg(
            paid.cast(MONEY).alias("total_paid"),
            F.max("posting_date").cast("timestamp").alias("last_payment_date"),
        )
    )


def b_financials(
    b_payments: DataFrame, asset_map: DataFrame, lease_ledger: DataFrame, latest: bool = False
) -> DataFrame:
    """Paid totals per installation: payments, else the ledger where there are none."""
    return primary_else_fallback(
        b_payment_totals(b_payments, asset_map),
        ledger_totals(lease_ledger, latest),
        "installation_id",
        ["total_paid", "last_payment_date"],
    )


def a_category(entity: Column, rules: PortfolioRules) -> Column:
    return F.when(entity == rules.entity_other, rules.category_a_other).otherwise(rules.category_a_main)


def b_category(excluded: Column, paid_at: Column, rules: PortfolioRules) -> Column:
    recent = paid_at >= F.lit(rules.b_recent_from)
    return (
        F.when(excluded, rules.category_b_excluded)
        .when(recent, rules.category_b_recent)
        .otherwise(rules.category_b_old)
    )


def locked_days(
    deal_type: Column, status: Column, paid_off: Column, next_update: Column, as_of: Column
) -> Column:
    """Full days since the next status date; null where lateness has no meaning."""
    no_meaning = (deal_type == "FULL") | status.isin("REPOSSESSED", "CANCELLED") | (paid_off == "true")
    # An unknown status does not exempt a contract.
    return F.when(
        ~F.coalesce(no_meaning, F.lit(False)) & next_update.isNotNull(),
        whole_days_since(next_update, as_of),
    )


def a_side(a_contracts: DataFrame, deployments: DataFrame, rules: PortfolioRules) -> DataFrame:
    d = deployments.select(
        F.col("contract_number").alias("_c"), F.col("deploy_date").alias("_deployed"), "payg_number"
    )
    c = a_contracts.filter(has_text(F.col("contract_number")) & F.col("signing_date").isNotNull())
    e = F.col("entity_name")
    return c.join(d, F.col("contract_number") == F.col("_c"), "left").select(
        "contract_number",
        F.when(e == rules.entity_other, rules.entity_other).otherwise(rules.entity_main).alias("entite"),
        F.lit(rules.source_a).alias("source"),
        a_category(e, rules).alias("categorie"),
        "client_number",
        "customer_name",
        "agent_number",
        "agent_name",
        F.col("signing_date").cast("timestamp").alias("paid_date"),
        F.col("_deployed").cast("timestamp").alias("registration_date"),
        F.col("last_status_update").cast("timestamp").alias("last_status_update"),
        F.col("next_status_update").cast("timestamp").alias("next_status_update"),
        F.col("paid_off_date").cast("timestamp").alias("paid_off_date"),
        F.col("repossession_date").cast("timestamp").alias("repossession_date"),
        F.coalesce("payg_number", "asset_number").alias("asset_number"),
        F.col("deal_type").alias("deal_type_raw"),
        F.col("total_cost").cast(MONEY).alias("total_contract_value"),
        F.col("upfront_payment").cast(MONEY).alias("upfront_payment"),
        F.col("monthly_payment").cast(MONEY).alias("monthly_payment"),
        F.col("total_paid").cast(MONEY).alias("total_paid"),
        F.col("remaining_debt").cast(MONEY).alias("remaining_debt"),
        F.col("status").alias("status_raw"),
        F.col("paid_off_status").alias("paid_off_raw"),
        "product_name",
        "region",
        F.col("district").alias("sub_prefecture"),
        "village",
    )


def b_side(
    b_contracts: DataFrame,
    financials: DataFrame,
    products: DataFrame,
    excluded: DataFrame,
    paid_off: DataFrame,
    rules: PortfolioRules,
) -> DataFrame:
    c = mark(
        b_contracts.withColumn("contract_number", F.col("installation_id").cast("string")),
        excluded, "contract_number", "contract_number", "_excluded",
    )
    f = financials.select(F.col("installation_id").alias("_f"), F.col("total_paid").alias("_paid"))
    p = products.select(
        F.col("installation_id").alias("_p"),
        F.col("product_name").alias("_product"),
        F.col("deal_type").alias("_deal"),
        "total_contract_value", "upfront_payment", "monthly_payment",
    )
    o = paid_off.select(F.col("contract_number").alias("_o"), F.col("paid_off_date").alias("_paid_off"))
    key = F.col("contract_number")
    joined = (
        c.join(f, key == F.col("_f"), "left")
        .join(p, key == F.col("_p"), "left")
        .join(o, key == F.col("_o"), "left")
    )
    paid = zero_if_null(F.col("_paid"))
    value = F.col("total_contract_value")
    return joined.select(
        "contract_number",
        F.lit(rules.entity_main).alias("entite"),
        F.lit(rules.source_b).alias("source"),
        b_category(F.col("_excluded"), F.col("paid_at"), rules).alias("categorie"),
        F.col("customer_id").alias("client_number"),
        "customer_name",
        F.lit(None).cast("string").alias("agent_number"),
        F.col("installed_by").alias("agent_name"),
        F.col("paid_at").cast("timestamp").alias("paid_date"),
        F.col("activated_at").cast("timestamp").alias("registration_date"),
        F.col("paid_at").cast("timestamp").alias("last_status_update"),
        F.col("unlocked_until").cast("timestamp").alias("next_status_update"),
        F.col("_paid_off").cast("timestamp").alias("paid_off_date"),
        F.col("removed_at").cast("timestamp").alias("repossession_date"),
        F.lit(None).cast("string").alias("asset_number"),
        F.coalesce("_deal", F.lit("PAYG")).alias("deal_type_raw"),
        value.cast(MONEY).alias("total_contract_value"),
        F.col("upfront_payment").cast(MONEY).alias("upfront_payment"),
        F.col("monthly_payment").cast(MONEY).alias("monthly_payment"),
        paid.cast(MONEY).alias("total_paid"),
        F.when(value.isNotNull(), F.greatest(F.lit(ZERO), value - paid)).cast(MONEY).alias("remaining_debt"),
        F.col("status").alias("status_raw"),
        F.when(F.col("_paid_off").isNotNull(), "yes").otherwise("no").alias("paid_off_raw"),
        F.coalesce("_product", "financial_type").alias("product_name"),
        "region",
        F.col("ward").alias("sub_prefecture"),
        F.lit(None).cast("string").alias("village"),
    )


def unified_contracts(
    a_contracts: DataFrame,
    a_assets: DataFrame,
    b_contracts: DataFrame,
    financials: DataFrame,
    products: DataFrame,
    excluded: DataFrame,
    paid_off: DataFrame,
    rules: PortfolioRules,
    as_of: date | datetime | str,
    paid_off_overrides_status: bool = True,
) -> DataFrame:
    """All contracts of both systems in one shape, with normalised labels.

    Every side is joined on its own key, one row per key, so no join can multiply or
    skew.  Store the result once per day and hand the stored table to the KPIs.
    ``paid_off_overrides_status=False`` gives the older definition.
    """
    raw = a_side(a_contracts, latest_deployment(a_assets), rules).unionByName(
        b_side(b_contracts, financials, products, excluded, paid_off, rules)
    )
    override = None
    if paid_off_overrides_status:
        override = F.col("paid_off_date").isNotNull() & (F.col("source") == rules.source_b)
    now = as_timestamp(as_of)
    return (
        raw.withColumn("contract_status", normal_status(F.col("status_raw"), override))
        .withColumn("paid_off", normal_flag(F.col("paid_off_raw")))
        .withColumn("deal_type", normal_deal(F.col("deal_type_raw")))
        .withColumn(
            "consecutive_locked_days",
            locked_days(
                F.col("deal_type"), F.col("contract_status"), F.col("paid_off"),
                F.col("next_status_update"), now,
            ),
        )
        .withColumn("computed_at", now)
        .select(*COLUMNS)
    )


def entity_contracts(contracts: DataFrame, entity: str) -> DataFrame:
    """The contracts one company owns."""
    return contracts.filter(F.col("entite") == entity)
