"""What each entity looks like on both sides, and how its upsert behaves.

A spec names the silver key, the columns an upsert replaces (all others stay as first
inserted) and the expressions that turn a raw item into silver columns.  System A
items arrive as JSON text in ``raw``; system B rows as text columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium import values
from arrearium.functions import cleaning as cl
from arrearium.functions.jsonpath import first_filled, first_path, first_value, object_or_text, surrogate_key
from arrearium.operators.fold import fold_versions, keep_first_placed, keep_last_placed
from arrearium.sources.bronze import ITEM_ORDER, each_once, once


@dataclass(frozen=True)
class EntitySpec:
    name: str
    keys: tuple[str, ...]
    mutable: tuple[str, ...] | None  # None: the upsert replaces every column
    columns: Callable[[], dict[str, Column]]
    raw_schema: str | None = None  # system A: fields to read from the item, as ``j``
    alt_schema: str | None = None  # more fields, as ``k``: names that differ only in case
    renames: dict[str, str] = field(default_factory=dict)  # system B: header -> column
    null_tokens: tuple[str, ...] = values.NULL_TOKENS  # system B: texts without a value
    uncleaned: tuple[str, ...] = ()  # system B: columns handed over as they are
    keep: Callable[[], Column] | None = None  # business filter after typing
    keep_raw: Callable[[], Column] | None = None  # filter on the raw item
    in_batch: str = "all"  # copies of a key within one ingest date: all, last or first

    def rows(self, bronze: DataFrame) -> DataFrame:
        """Typed silver rows, file-order columns kept."""
        order = [c for c in ITEM_ORDER if c in bronze.columns]
        if self.raw_schema is not None:
            src = bronze.select("*", once(F.from_json("raw", self.raw_schema)).alias("j"))
            if self.alt_schema is not None:
                src = src.select("*", once(F.from_json("raw", self.alt_schema)).alias("k"))
        else:
            src = bronze
            # Text is cleaned once here; the filters and typed columns below read it several times.
            cells = [self._cell(name, _header(src.columns, h)) for h, name in self.renames.items()]
            src = src.select(*order, each_once(cells))
        if self.keep_raw is not None:
            src = src.filter(self.keep_raw())
        out = src.select(*order, each_once([c.alias(n) for n, c in self.columns().items()]))
        for k in self.keys:
            out = out.filter(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
        return out

    def _cell(self, name: str, header: str | None) -> Column:
        if header is None:
            return F.lit(None).cast("string").alias(name)
        raw = F.col(f"`{header}`")
        return (raw if name in self.uncleaned else cl.clean_text(raw, self.null_tokens)).alias(name)

    def changing(self, df: DataFrame) -> list[str]:
        if self.mutable is not None:
            return list(self.mutable)
        return [c for c in df.columns if c not in self.keys and c not in ITEM_ORDER]

    def batch_rows(self, rows: DataFrame, one_date: bool = False) -> DataFrame:
        """The rows each ingest date contributes: copies resolved, then the business filter.

        With ``one_date`` all rows are of one, and are grouped by the keys alone, as folds are.
        """
        order = [c for c in ITEM_ORDER if c in rows.columns]
        if self.in_batch != "all":
            pick = keep_last_placed if self.in_batch == "last" else keep_first_placed
            dates = [] if one_date else ["ingest_date"]
            rows = pick(rows, [*self.keys, *dates], [c for c in order if c != "ingest_date"])
        return rows.filter(self.keep()) if self.keep is not None else rows

    def current(self, rows: DataFrame) -> DataFrame:
        """All landed versions folded into one row per key."""
        order = [c for c in ITEM_ORDER if c in rows.columns]
        return fold_versions(self.batch_rows(rows), self.keys, self.changing(rows), order)


def _header(columns: list[str], wanted: str) -> str | None:
    """The column with this header, or one that only adds a prefix word to it."""
    if wanted in columns:
        return wanted
    return next((c for c in columns if c.endswith(f" {wanted}")), None)


def _j(path: str) -> Column:
    return F.col(f"j.{path}")


def _a_time(path: str, formats=values.A_FORMATS) -> Column:
    return cl.parse_timestamp(_j(path), formats)


def _py_time(c: Column) -> Column:
    """A UTC timestamp in the text form used inside fallback keys."""
    whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(c, ".SSSSSS")
    return F.concat(whole, F.when(micros != ".000000", micros).otherwise(""), F.lit("+00:00"))


# ---- system A ------------------------------------------------------------------


def _a_contract_columns() -> dict[str, Column]:
    paid_off_status = F.coalesce(
        first_value(_j("paidOff.status"), F.col("k.paidoffStatus"), _j("paidOffStatus")), F.lit("")
    )
    paid_off_date = first_value(_j("paidOffDate"), F.col("k.paidoffDate"))
    first, last = _j("client.profile.firstName"), _j("client.profile.lastName")
    return {
        "contract_number": _j("contractNumber"),
        "entity_name": _j("entity.name"),
        "status": F.upper(F.nullif(_j("status"), F.lit(""))),
        "onboarding_status": _j("onboardingStatus"),
        "flag": _j("flag"),
        "paid_off_status": paid_off_status,
        "deal_type": _j("type"),
        "signing_date": _a_time("signingDate"),
        "registration_date": _a_time("signingDate"),
        "last_status_update": _a_time("lastStatusUpdate"),
        "next_status_update": _a_time("nextStatusUpdate"),
        "paid_off_date": cl.parse_timestamp(paid_off_date, values.A_FORMATS),
        "repossession_date": _a_time("repossessionDate"),
        "total_cost": cl.clean_number(_j("totalCost"), ","),
        "total_paid": cl.clean_number(_j("totalPaid"), ","),
        "remaining_debt": cl.clean_number(_j("remainingDebt"), ","),
        "upfront_payment": cl.clean_number(_j("pricingSchedule.upfrontPayment"), ","),
        "monthly_payment": cl.clean_number(_j("pricingSchedule.recurrentPayment"), ","),
        "product_name": first_filled(_j("product.name"), _j("dealName")),
        "asset_number": first_filled(_j("asset.paygNumber"), _j("paygNumber")),
        "client_number": _j("client.clientNumber"),
        "customer_name": cl.full_name(first, last),
        "agent_number": _j("agent.agentNumber"),
        "agent_name": cl.full_name(_j("agent.profile.firstName"), _j("agent.profile.lastName")),
        "region": _j("client.profile.region"),
        "sub_prefecture": _j("client.profile.commune"),
        "district": _j("client.profile.district"),
        "village": _j("client.profile.village"),
    }


A_CONTRACTS = EntitySpec(
    name="a_contracts",
    keys=("contract_number",),
    mutable=(
        "entity_name", "status", "onboarding_status", "flag", "paid_off_status", "deal_type",
        "signing_date", "last_status_update", "next_status_update", "paid_off_date",
        "repossession_date", "total_cost", "total_paid", "remaining_debt", "upfront_payment",
        "monthly_payment", "sub_prefecture", "district", "village",
    ),
    raw_schema="""
        contractNumber string, status string, onboardingStatus string, flag string, type string,
        signingDate string, lastStatusUpdate string, nextStatusUpdate string, repossessionDate string,
        totalCost string, totalPaid string, remainingDebt string, dealName string, paygNumber string,
        paidOff struct<status: string>, paidOffStatus string, paidOffDate string,
        pricingSchedule struct<upfrontPayment: string, recurrentPayment: string>,
        product struct<name: string>, asset struct<paygNumber: string>, entity struct<name: string>,
        client struct<clientNumber: string, profile: struct<firstName: string, lastName: string,
            region: string, commune: string, district: string, village: string>>,
        agent struct<agentNumber: string, profile: struct<firstName: string, lastName: string>>
    """,
    alt_schema="paidoffStatus string, paidoffDate string",
    columns=_a_contract_columns,
    keep_raw=lambda: ~cl.is_test_name(_j("client.profile.firstName"), _j("client.profile.lastName")),
)

A_PAYMENTS = EntitySpec(
    name="a_payments",
    keys=("transaction_id",),
    mutable=None,
    raw_schema="""
        transactionId string, contractNumber string, date string, amount string, ccy string,
        status string, operator string, type string, paymentCode string, paymentReference string,
        mobile string, entity struct<name: string, entityNumber: string>
    """,
    columns=lambda: {
        "transaction_id": _j("transactionId"),
        "contract_number": _j("contractNumber"),
        "payment_date": _a_time("date"),
        "amount": cl.clean_number(_j("amount")),
        "currency": _j("ccy"),
        "status": _j("status"),
        "operator": _j("operator"),
        "payment_type": _j("type"),
        "payment_code": _j("paymentCode"),
        "payment_reference": _j("paymentReference"),
        "mobile": _j("mobile"),
        "entity_name": _j("entity.name"),
        "entity_number": _j("entity.entityNumber"),
    },
)

A_ASSETS = EntitySpec(
    name="a_assets",
    keys=("payg_number",),
    mutable=("status", "contract_number", "client_number", "held_by", "distributed_status"),
    raw_schema="""
        paygNumber string, _id string, serialNumber string, status string, batchNumber string,
        deployDate string, dateAdded string, product struct<reference: string>,
        contract struct<contractNumber: string>, ownedBy struct<clientNumber: string>,
        heldBy struct<agentNumber: string>, distributed struct<status: string>
    """,
    columns=lambda: {
        "payg_number": _j("paygNumber"),
        "asset_id": _j("_id"),
        "serial_number": _j("serialNumber"),
        "status": _j("status"),
        "product_reference": _j("product.reference"),
        "contract_number": _j("contract.contractNumber"),
        "client_number": _j("ownedBy.clientNumber"),
        "held_by": _j("heldBy.agentNumber"),
        "batch_number": _j("batchNumber"),
        "deploy_date": _a_time("deployDate"),
        "date_added": _a_time("dateAdded"),
        "distributed_status": _j("distributed.status"),
    },
)

A_CLIENTS = EntitySpec(
    name="a_clients",
    keys=("client_number",),
    mutable=("status", "mobile"),
    raw_schema="""
        clientNumber string, status string, entryDate string, contact struct<mobile: string>,
        profile struct<firstName: string, lastName: string, gender: string, village: string,
            district: string, region: string, country: string>
    """,
    columns=lambda: {
        "client_number": _j("clientNumber"),
        "status": _j("status"),
        "first_name": _j("profile.firstName"),
        "last_name": _j("profile.lastName"),
        "gender": _j("profile.gender"),
        "mobile": _j("contact.mobile"),
        "village": _j("profile.village"),
        "district": _j("profile.district"),
        "region": _j("profile.region"),
        "country": _j("profile.country"),
        "entry_date": _a_time("entryDate"),
    },
)

A_DEALS = EntitySpec(
    name="a_deals",
    keys=("deal_number",),
    mutable=("status", "total_cost", "pricing_recurring"),
    raw_schema="""
        dealNumber string, dealName string, type string, status string, totalCost string,
        setUpOn string, pricingSchedule struct<recurring: string, days: string, upfront: string>
    """,
    columns=lambda: {
        "deal_number": _j("dealNumber"),
        "deal_name": _j("dealName"),
        "type": _j("type"),
        "status": _j("status"),
        "total_cost": cl.clean_number(_j("totalCost"), ","),
        "pricing_recurring": cl.clean_number(_j("pricingSchedule.recurring"), ","),
        "pricing_days": _j("pricingSchedule.days").try_cast("int"),
        "pricing_upfront": cl.clean_number(_j("pricingSchedule.upfront"), ","),
        "set_up_on": _a_time("setUpOn"),
    },
)

A_TASKS = EntitySpec(
    name="a_tasks",
    keys=("task_id",),
    mutable=None,
    raw_schema="""
        taskId string, taskNumber string, title string, priority string, instructions string,
        assignedOn string, dueOn string, completedOn string, closedOn string, assignedTo string,
        assignedToLastName string, contractNumber string, clientNumber string, parentTicket string,
        status string, category string, subCategory string, updatedAt string
    """,
    columns=lambda: {
        "task_id": _j("taskId"),
        "task_number": _j("taskNumber"),
        "title": _j("title"),
        "priority": _j("priority"),
        "instructions": _j("instructions"),
        "assigned_on": _a_time("assignedOn", values.TASK_FORMATS),
        "due_on": _a_time("dueOn", values.TASK_FORMATS),
        "completed_on": _a_time("completedOn", values.TASK_FORMATS),
        "closed_on": _a_time("closedOn", values.TASK_FORMATS),
        "assigned_to": _j("assignedTo"),
        "assigned_to_last_name": _j("assignedToLastName"),
        "contract_number": _j("contractNumber"),
        "client_number": _j("clientNumber"),
        "parent_ticket": _j("parentTicket"),
        "status": _j("status"),
        "category": _j("category"),
        "sub_category": _j("subCategory"),
        "updated_at_src": _a_time("updatedAt", values.TASK_FORMATS),
    },
)


def _form_columns() -> dict[str, Column]:
    def when(*paths: str) -> Column:
        return cl.parse_timestamp(first_value(*[_j(p) for p in paths]), values.FORM_FORMATS)

    submitted, updated = when("submittedOn", "submittedAt"), when("updatedAt", "lastUpdated")
    client, contract, name = _j("clientNumber"), _j("contractNumber"), _j("name")
    fallback = surrogate_key(client, contract, name, _py_time(submitted), _py_time(updated))
    return {
        "form_id": F.coalesce(first_value(_j("formId"), _j("_id")), fallback),
        "form_number": first_value(_j("formNumber"), _j("number")),
        "name": name,
        "status": _j("status"),
        "score": _j("score").try_cast("decimal(38,10)"),
        "client_number": client,
        "contract_number": contract,
        "agent_number": object_or_text(("agentNumber", "number", "id"), _j("agent"), _j("assignedTo")),
        "origin": _j("origin"),
        "created_at_src": when("createdAt", "creationDate"),
        "submitted_on": submitted,
        "updated_at_src": updated,
        "raw_data": F.col("raw"),
    }


A_FORMS = EntitySpec(
    name="a_forms",
    keys=("form_id",),
    mutable=None,
    # Declared as text, agent and assignedTo keep an object's JSON.
    raw_schema="""
        formId string, _id string, formNumber string, number string, name string, status string,
        score string, clientNumber string, contractNumber string, agent string, assignedTo string,
        origin string, createdAt string, creationDate string, submittedOn string,
        submittedAt string, updatedAt string, lastUpdated string
    """,
    columns=_form_columns,
)


def _event_columns() -> dict[str, Column]:
    def pick(*paths: str) -> Column:
        return first_value(*[_j(p) for p in paths])

    def when(*paths: str) -> Column:
        return cl.parse_timestamp(pick(*paths), values.EVENT_FORMATS)

    return {
        "event_id": pick("_id", "id"),
        "asset_id": pick("asset._id", "assetId"),
        "payg_number": pick("asset.paygNumber", "paygNumber"),
        "event_type": pick("type", "eventType"),
        "event_status": pick("status", "eventStatus"),
        "event_date": when("date", "eventDate"),
        "event_note": pick("note", "description"),
        "created_at_src": when("createdAt"),
        "updated_at_src": when("updatedAt", "date"),
        "asset_number": pick("asset.assetNumber", "assetNumber"),
        "serial_number": pick("asset.serialNumber", "serialNumber"),
        "batch_number": pick("asset.batchNumber", "batchNumber"),
        "product_reference": pick("asset.productReference", "product.productReference"),
        "asset_date_added": when("asset.dateAdded"),
        "asset_last_update": when("asset.lastUpdate"),
        "product_name": pick("asset.productDetails.name", "product.name"),
        "product_category": pick("asset.productDetails.category", "product.category"),
        "product_manufacturer": pick("asset.productDetails.manufacturer", "product.manufacturer"),
        "actor": pick("actor.agentNumber", "actor.name"),
        "agent_number": pick("newHolder.agentNumber", "agent.agentNumber"),
        "agent_first_name": pick("newHolder.profile.firstName"),
        "agent_last_name": pick("newHolder.profile.lastName"),
        "old_holder_agent_number": pick("oldHolder.agentNumber"),
        "old_holder_first_name": pick("oldHolder.profile.firstName"),
        "old_holder_last_name": pick("oldHolder.profile.lastName"),
        "new_holder_agent_number": pick("newHolder.agentNumber"),
        "new_holder_first_name": pick("newHolder.profile.firstName"),
        "new_holder_last_name": pick("newHolder.profile.lastName"),
        "location": pick("location"),
        "coordinates": pick("coordinates", "gps"),
        "source": pick("source"),
        "raw_data": F.col("raw"),
    }


_HOLDER = "struct<agentNumber: string, profile: struct<firstName: string, lastName: string>>"

A_ASSET_EVENTS = EntitySpec(
    name="a_asset_events",
    keys=("event_id",),
    mutable=(
        "event_type", "event_status", "event_date", "event_note", "updated_at_src",
        "asset_last_update", "location", "raw_data",
    ),
    raw_schema=f"""
        _id string, id string, assetId string, paygNumber string, type string, eventType string,
        status string, eventStatus string, date string, eventDate string, note string,
        description string, createdAt string, updatedAt string, assetNumber string,
        serialNumber string, batchNumber string, location string, coordinates string, gps string,
        source string, actor struct<agentNumber: string, name: string>,
        agent struct<agentNumber: string>, newHolder {_HOLDER}, oldHolder {_HOLDER},
        product struct<productReference: string, name: string, category: string, manufacturer: string>,
        asset struct<_id: string, paygNumber: string, assetNumber: string, serialNumber: string,
            batchNumber: string, productReference: string, dateAdded: string, lastUpdate: string,
            productDetails: struct<name: string, category: string, manufacturer: string>>
    """,
    columns=_event_columns,
    in_batch="first",
)

# ---- system B ------------------------------------------------------------------


def _day(name: str) -> Column:
    return cl.parse_timestamp(F.col(name), values.LENIENT_FORMATS).cast("date")


B_CONTRACTS = EntitySpec(
    name="b_contracts",
    in_batch="last",
    keys=("installation_id",),
    mutable=(
        "status", "unlocked_until", "paid_at", "activated_at", "canceled_at", "removed_at",
        "removal_reason",
    ),
    renames={
        "id": "installation_id", "customer_id": "customer_id", "customer_name": "customer_name",
        "status": "status", "region": "region", "district": "district", "ward": "ward",
        "financial_type": "financial_type", "lease_term_in_months": "lease_term_in_months",
        "requested": "requested_date", "unlocked_until": "unlocked_until", "paid_at": "paid_at",
        "activated_at": "activated_at", "canceled_at": "canceled_at", "removed_at": "removed_at",
        "order_created_by": "order_created_by", "lead_created_by": "lead_created_by",
        "installed_by": "installed_by", "removal_reason": "removal_reason",
        "latitude": "latitude", "longitude": "longitude",
    },
    columns=lambda: {
        **{
            c: F.col(c)
            for c in (
                "installation_id", "customer_id", "customer_name", "status", "region", "district",
                "ward", "financial_type", "order_created_by", "lead_created_by", "installed_by",
                "removal_reason",
            )
        },
        "lease_term_in_months": cl.clean_int(F.col("lease_term_in_months"), ",$"),
        **{
            c: _day(c)
            for c in (
                "requested_date", "unlocked_until", "paid_at", "activated_at", "canceled_at", "removed_at",
            )
        },
        "latitude": cl.clean_number(F.col("latitude"), ",$", "decimal(18,8)"),
        "longitude": cl.clean_number(F.col("longitude"), ",$", "decimal(18,8)"),
    },
    keep=lambda: F.col("activated_at").isNotNull(),
)

B_PAYMENTS = EntitySpec(
    name="b_payments",
    in_batch="last",
    keys=("transaction_id",),
    mutable=("payment_status", "paid_time", "amount"),
    renames={
        "ID": "transaction_id", "Sender Name": "sender_name", "Source Name": "source_name",
        "Payment Kind": "payment_kind", "Paid Time": "paid_time",
        "External Reference": "external_reference", "Payment Status": "payment_status",
        "Account": "account", "Amount": "amount",
    },
    columns=lambda: {
        **{
            c: F.col(c)
            for c in (
                "transaction_id", "sender_name", "source_name", "payment_kind",
                "external_reference", "payment_status", "account",
            )
        },
        "paid_time": cl.parse_timestamp(F.col("paid_time"), values.LENIENT_FORMATS),
        "amount": cl.clean_number(F.col("amount")),
    },
    keep=lambda: F.col("account").isNotNull(),
)

B_ASSET_MAP = EntitySpec(
    name="b_asset_map",
    in_batch="last",
    keys=("asset_number",),
    mutable=None,
    renames={"asset_number": "asset_number", "contract_number": "installation_id"},
    columns=lambda: {
        "asset_number": F.col("asset_number"),
        "installation_id": F.col("installation_id"),
    },
    keep=lambda: F.col("installation_id").isNotNull(),
)

B_PRODUCTS = EntitySpec(
    name="b_products",
    uncleaned=("deal_type",),
    in_batch="last",
    keys=("installation_id",),
    mutable=None,
    renames={
        "contract_number": "installation_id", "asset_number": "asset_number",
        "product_name": "product_name", "deal_type": "deal_type",
        "total_contract_value": "total_contract_value", "upfront_payment": "upfront_payment",
        "monthly_payment": "monthly_payment",
    },
    columns=lambda: {
        **{c: F.col(c) for c in ("installation_id", "asset_number", "product_name")},
        "deal_type": cl.lookup_deal(F.col("deal_type")),
        **{
            c: cl.clean_number(F.col(c))
            for c in ("total_contract_value", "upfront_payment", "monthly_payment")
        },
    },
)

B_LEASE_LEDGER = EntitySpec(
    name="b_lease_ledger",
    null_tokens=values.LEDGER_NULL_TOKENS,
    in_batch="last",
    keys=("contract_ogc", "posting_date"),
    mutable=("total_cash_collected", "ending_principal", "ending_interest", "total_ending_balance"),
    renames={
        "Contract": "contract_ogc", "Installation Id": "installation_id",
        "Posting Date": "posting_date", "Billing Date": "billing_date", "Period": "period",
        "Total Cash Collected from Customer": "total_cash_collected",
        "Ending Balance Principal": "ending_principal",
        "Ending Balance Interest": "ending_interest",
        "Total Ending Balance": "total_ending_balance", "Status": "status",
        "Subsidiary": "subsidiary", "Contract Type": "contract_type",
    },
    keep_raw=lambda: F.col("contract_ogc").startswith("OGC"),
    columns=lambda: {
        **{
            c: F.col(c)
            for c in ("contract_ogc", "installation_id", "status", "subsidiary", "contract_type")
        },
        "posting_date": _day("posting_date"),
        "billing_date": _day("billing_date"),
        "period": cl.clean_int(F.col("period")),
        **{
            c: cl.clean_number(F.col(c))
            for c in (
                "total_cash_collected", "ending_principal", "ending_interest", "total_ending_balance",
            )
        },
    },
)

SPECS = {
    s.name: s
    for s in (
        A_CONTRACTS, A_PAYMENTS, A_ASSETS, A_CLIENTS, A_DEALS, A_TASKS, A_FORMS, A_ASSET_EVENTS,
        B_CONTRACTS, B_PAYMENTS, B_ASSET_MAP, B_PRODUCTS, B_LEASE_LEDGER,
    )
}


@dataclass(frozen=True)
class Feed:
    """How a system A entity is pulled and identified."""

    page_size: int
    date_field: str | None  # incremental when set
    default_start: str | None
    id_fields: tuple[str, ...]


# Fixed values of the upstream endpoints.
FEEDS = {
    "contracts": Feed(200, None, None, ("contractNumber", "_id")),
    "assets": Feed(200, None, None, ("paygNumber", "_id")),
    "clients": Feed(500, None, None, ("clientNumber", "_id")),
    "agents": Feed(500, "admin.joinedOn", "2023-01-01", ("agentNumber", "_id")),
    "payments": Feed(500, "date", "2025-02-01", ("transactionId", "_id")),
    "tasks": Feed(500, "updatedAt", "2023-01-01", ("taskId", "_id")),
    "tickets": Feed(500, None, None, ("ticketId", "_id")),
    "forms": Feed(500, "updatedAt", "2023-01-01", ("formId", "_id")),
    "deals": Feed(200, None, None, ("dealNumber", "_id")),
    "asset_events": Feed(500, "updatedAt", "2023-01-01", ("_id",)),
}


def item_id(feed: Feed, raw: Column) -> Column:
    """The item's own id, else a reproducible hash of its text."""
    return F.coalesce(first_path(raw, *feed.id_fields), F.sha2(raw, 256))
