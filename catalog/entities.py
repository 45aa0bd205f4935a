"""The entities of both systems from landing to silver: two days land, the second changes every third key.

Each query lands raw rows made from the given tables, refreshes silver for day one, then folds day two into it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium.operators.versioned import BucketTable
from arrearium.plans.daily import refresh_silver, refresh_table
from arrearium.session import scratch_path
from arrearium.sources import bronze
from arrearium.sources.specs import SPECS
from catalog.registry import dbl, query, ts, txt
from catalog.tables import Tables, present

DAYS = (date(2001, 8, 30), date(2001, 8, 31))


def _z(c: Column) -> Column:
    return F.date_format(c.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _silver(t: Tables, entity: str, key: str, first: DataFrame, second: DataFrame) -> DataFrame:
    """Silver after both days; ``key`` (a long in the raw rows) chooses what lands again."""
    spec, root = SPECS[entity], scratch_path(t.spark, entity)
    land = bronze.land_items if spec.raw_schema is not None else bronze.land_csv
    for day, rows in zip(DAYS, (first, second.where(F.col(key) % 3 == 0)), strict=True):
        land(rows.drop(key).withColumn("ingest_date", F.lit(day)), f"{root}/bronze")
    refresh_silver(t.spark, spec, f"{root}/bronze", f"{root}/1")
    return refresh_silver(t.spark, spec, f"{root}/bronze", f"{root}/2", f"{root}/1", DAYS[1].isoformat())


def _changed(key: str, new: str, old: str) -> str:
    return f"CASE WHEN {key} % 3 = 0 THEN {new} ELSE {old} END"


@query(
    "silver_a_clients",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS client_number, {_changed('c_custkey', "'CLOSED'", "'OPEN'")} AS status,
     c_name AS first_name, CAST(c_nationkey AS VARCHAR) AS region,
     {_changed('c_custkey', "'m2'", "'m1'")} AS mobile, '2001-08-30' AS loaded,
     {_changed('c_custkey', "'2001-08-31'", "'2001-08-30'")} AS updated FROM customer""",
)
def silver_a_clients(t: Tables):
    def raw(status: str, mobile: str, name: Column) -> DataFrame:
        return t.customer.select(
            F.col("c_custkey").alias("k"), F.col("c_custkey").alias("clientNumber"), F.lit(status).alias("status"),
            F.struct(F.lit(mobile).alias("mobile")).alias("contact"),
            F.struct(name.alias("firstName"), F.col("c_nationkey").alias("region")).alias("profile"),
        )

    # A first name never changes once it is stored.
    got = _silver(t, "a_clients", "k", raw("OPEN", "m1", F.col("c_name")), raw("CLOSED", "m2", F.lit("other")))
    return present(
        got.select(
            "client_number", "status", "first_name", "region", "mobile", F.col("loaded_at").cast("date").alias("loaded"),
            F.col("updated_at").cast("date").alias("updated"),
        )
    )


@query(
    "silver_a_deals",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS deal_number, p_name AS deal_name, p_size AS pricing_days,
     {dbl(_changed('p_partkey', '2 * CAST(p_retailprice AS DECIMAL(18,2))', 'CAST(p_retailprice AS DECIMAL(18,2))'))} AS total_cost
    FROM part""",
)
def silver_a_deals(t: Tables):
    price = F.col("p_retailprice").cast("decimal(18,2)")

    def raw(cost: Column, name: Column) -> DataFrame:
        return t.part.select(
            F.col("p_partkey").alias("k"), F.col("p_partkey").alias("dealNumber"), name.alias("dealName"),
            F.format_number(cost, 2).alias("totalCost"), F.struct(F.col("p_size").alias("days")).alias("pricingSchedule"),
        )

    got = _silver(t, "a_deals", "k", raw(price, F.col("p_name")), raw(price * 2, F.lit("other")))
    return present(got.select("deal_number", "deal_name", F.col("pricing_days").cast("long"), "total_cost"))


@query(
    "silver_a_tasks",
    f"""SELECT CAST(event_id AS VARCHAR) AS task_id, {_changed('event_id', "'DONE'", 'event_type')} AS status,
     {ts("date_trunc('second', ts)")} AS assigned_on,
     {ts(_changed('event_id', "date_trunc('second', ts) + INTERVAL 1 DAY", 'NULL'))} AS completed_on FROM fx_events""",
)
def silver_a_tasks(t: Tables):
    def raw(status: Column, done: Column) -> DataFrame:
        return t.fx_events.select(
            F.col("event_id").alias("k"), F.col("event_id").cast("string").alias("taskId"), status.alias("status"),
            _z(F.col("ts")).alias("assignedOn"), done.alias("completedOn"),
        )

    day_later = _z(F.col("ts") + F.expr("INTERVAL 1 DAY"))
    got = _silver(t, "a_tasks", "k", raw(F.col("event_type"), F.lit(None).cast("string")), raw(F.lit("DONE"), day_later))
    return present(got.select("task_id", "status", "assigned_on", "completed_on"))


@query(
    "silver_a_forms",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS form_id, {_changed('o_orderkey', "'signed'", "'sent'")} AS status,
     'agent-' || o_custkey AS agent_number, {dbl('o_orderkey % 100')} AS score FROM orders""",
)
def silver_a_forms(t: Tables):
    """An agent is an object or a text; the id stands under one of two names."""

    def raw(status: str) -> DataFrame:
        key, agent = F.col("o_orderkey"), F.concat(F.lit("agent-"), F.col("o_custkey").cast("string"))
        return t.orders.select(
            key.alias("k"), F.when(key % 2 == 0, key.cast("string")).alias("formId"),
            F.when(key % 2 == 1, key.cast("string")).alias("_id"), F.lit(status).alias("status"),
            F.when(key % 2 == 0, F.struct(agent.alias("agentNumber"))).alias("agent"),
            F.when(key % 2 == 1, agent).alias("assignedTo"), (key % 100).cast("string").alias("score"),
        )

    got = _silver(t, "a_forms", "k", raw("sent"), raw("signed"))
    return present(got.select("form_id", "status", "agent_number", "score"))


@query(
    "silver_a_asset_events",
    f"""SELECT CAST(event_id AS VARCHAR) AS event_id, {_changed('event_id', "'MOVED'", 'event_type')} AS event_type,
     'P' || asset_id AS payg_number, {ts("date_trunc('second', ts)")} AS event_date FROM fx_events""",
)
def silver_a_asset_events(t: Tables):
    def raw(kind: Column, payg: Column) -> DataFrame:
        return t.fx_events.select(
            F.col("event_id").alias("k"), F.col("event_id").cast("string").alias("_id"), kind.alias("type"),
            _z(F.col("ts")).alias("date"), F.struct(payg.alias("paygNumber")).alias("asset"),
        )

    payg = F.concat(F.lit("P"), F.col("asset_id").cast("string"))
    got = _silver(t, "a_asset_events", "k", raw(F.col("event_type"), payg), raw(F.lit("MOVED"), F.lit("other")))
    return present(got.select("event_id", "event_type", "payg_number", "event_date"))


@query(
    "silver_b_contracts",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS installation_id, {_changed('o_orderkey', "'Disabled'", "'Active'")} AS status,
     CAST(o_custkey AS VARCHAR) AS customer_id, 24 AS lease_term_in_months, {txt('o_orderdate')} AS activated_at
    FROM orders WHERE o_orderkey % 5 > 0""",
)
def silver_b_contracts(t: Tables):
    """Contracts that were never activated do not reach silver."""

    def raw(status: str, customer: Column) -> DataFrame:
        key = F.col("o_orderkey")
        return t.orders.select(
            key.alias("k"), key.alias("id"), customer.alias("customer_id"), F.lit(status).alias("status"),
            F.lit(" 24 ").alias("lease_term_in_months"),
            F.when(key % 5 > 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).otherwise("N/A").alias("activated_at"),
        )

    got = _silver(t, "b_contracts", "k", raw("Active", F.col("o_custkey").cast("string")), raw("Disabled", F.lit("other")))
    return present(
        got.select("installation_id", "status", "customer_id", F.col("lease_term_in_months").cast("int"), "activated_at")
    )


@query(
    "silver_b_asset_map",
    f"""SELECT 'A' || s_suppkey AS asset_number, {_changed('s_suppkey', "'moved-' || s_nationkey", "'C' || s_suppkey")}
     AS installation_id FROM supplier""",
)
def silver_b_asset_map(t: Tables):
    def raw(contract: Column) -> DataFrame:
        key = F.col("s_suppkey")
        return t.supplier.select(
            key.alias("k"), F.concat(F.lit("A"), key.cast("string")).alias("asset_number"), contract.alias("contract_number")
        )

    first = F.concat(F.lit("C"), F.col("s_suppkey").cast("string"))
    moved = F.concat(F.lit("moved-"), F.col("s_nationkey").cast("string"))
    return present(_silver(t, "b_asset_map", "k", raw(first), raw(moved)).select("asset_number", "installation_id"))


@query(
    "silver_b_products",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS installation_id, 'kit, "' || o_custkey || '"' AS product_name,
     {dbl(_changed('o_orderkey', '2 * CAST(o_totalprice AS DECIMAL(18,2))', 'CAST(o_totalprice AS DECIMAL(18,2))'))}
     AS total_contract_value FROM orders""",
)
def silver_b_products(t: Tables):
    price = F.col("o_totalprice").cast("decimal(18,2)")

    def raw(value: Column) -> DataFrame:
        key = F.col("o_orderkey")
        return t.orders.select(
            key.alias("k"), key.alias("contract_number"), F.format_number(value, 2).alias("total_contract_value"),
            F.concat(F.lit('kit, "'), F.col("o_custkey").cast("string"), F.lit('"')).alias("product_name"),
        )

    got = _silver(t, "b_products", "k", raw(price), raw(price * 2))
    return present(got.select("installation_id", "product_name", "total_contract_value"))


@query(
    "silver_b_lease_ledger",
    f"""SELECT 'OGC' || o_orderkey AS contract_ogc, {txt('o_orderdate')} AS posting_date,
     {dbl(_changed('o_orderkey', '2 * CAST(o_totalprice AS DECIMAL(18,2))', 'CAST(o_totalprice AS DECIMAL(18,2))'))}
     AS ending_principal, CAST(o_orderkey % 7 AS INT) AS period FROM orders WHERE o_orderkey % 4 > 0""",
)
def silver_b_lease_ledger(t: Tables):
    """Rows of other books are left out by the contract's prefix."""
    price = F.col("o_totalprice").cast("decimal(18,2)")

    def raw(value: Column) -> DataFrame:
        key = F.col("o_orderkey")
        return t.orders.select(
            key.alias("k"), F.concat(F.when(key % 4 > 0, "OGC").otherwise("X"), key.cast("string")).alias("Contract"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("Posting Date"), (key % 7).cast("string").alias("Period"),
            F.format_number(value, 2).alias("Ending Balance Principal"),
        )

    got = _silver(t, "b_lease_ledger", "k", raw(price), raw(price * 2))
    return present(got.select("contract_ogc", "posting_date", "ending_principal", F.col("period").cast("int")))


def _contact(t: Tables, status: str, mobile: Column, name: Column, day: date) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("k"), F.lit(day).alias("ingest_date"), F.col("c_custkey").alias("clientNumber"),
        F.lit(status).alias("status"), F.struct(mobile.alias("mobile")).alias("contact"),
        F.struct(name.alias("firstName"), F.col("c_nationkey").alias("region")).alias("profile"),
    )


@query(
    "silver_buckets",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS client_number, CASE WHEN c_custkey < 5 THEN 'CLOSED' ELSE 'OPEN' END AS status,
     c_name AS first_name, CASE WHEN c_custkey < 5 THEN '2001-08-31' ELSE '2001-08-30' END AS updated,
     true AS few_buckets, true AS less_written FROM customer""",
)
def silver_buckets(t: Tables):
    """Day two changes five clients: at most five buckets are written, the others stay with version one."""
    spec, root = SPECS["a_clients"], scratch_path(t.spark, "clients")
    table = BucketTable(t.spark, f"{root}/silver", spec.keys)
    for day, status, part, name in ((DAYS[0], "OPEN", F.lit(True), F.col("c_name")), (DAYS[1], "CLOSED", F.col("k") < 5, F.lit("other"))):
        bronze.land_items(_contact(t, status, F.lit("m"), name, day).where(part).drop("k"), f"{root}/bronze")
        refresh_table(t.spark, spec, f"{root}/bronze", table)
    held = list(table.manifest().holder.values())
    got = table.read().select("client_number", "status", "first_name", F.col("updated_at").cast("date").alias("updated"))
    return present(
        got.select("*", F.lit(held.count(2) <= 5).alias("few_buckets"), F.lit(table.bytes_of(2) < table.bytes_of(1)).alias("less_written"))
    )


@query(
    "daily_missed_day",
    """SELECT CAST(c_custkey AS VARCHAR) AS client_number,
     CASE WHEN c_custkey % 5 = 0 THEN 'D3' WHEN c_custkey % 3 = 0 THEN 'D2' WHEN c_custkey % 2 = 0 THEN 'D1b' ELSE 'D1' END AS status,
     CASE WHEN c_custkey % 7 = 0 THEN 'late' ELSE c_name END AS first_name,
     CASE WHEN c_custkey % 7 = 0 THEN '2001-08-28' ELSE '2001-08-29' END AS loaded, 4 AS versions, 6 AS landings FROM customer""",
)
def daily_missed_day(t: Tables):
    """The job of the second day fails, a day lands late, an old day lands again, and a run finds nothing new.

    The third day's run reads the second day's items too.  The late day is older than all: it brings the first version of
    its clients and overrides nothing.
    """
    spec, root = SPECS["a_clients"], scratch_path(t.spark, "clients")
    table = BucketTable(t.spark, f"{root}/silver", spec.keys, buckets=16)
    days = [date(2001, 8, d) for d in (28, 29, 30, 31)]

    def land(day: date, status: str, part: Column, name: Column, landing: int = 0) -> None:
        bronze.land_items(_contact(t, status, F.lit("m"), name, day).where(part).drop("k"), f"{root}/bronze", landing)

    def run(day: date) -> None:
        refresh_table(t.spark, spec, f"{root}/bronze", table, day.isoformat())

    land(days[1], "D1", F.lit(True), F.col("c_name"))
    run(days[1])
    land(days[2], "D2", F.col("k") % 3 == 0, F.lit("other"))  # its job does not run
    land(days[3], "D3", F.col("k") % 5 == 0, F.lit("other"))
    run(days[3])
    land(days[0], "late", F.col("k") % 7 == 0, F.lit("late"))
    land(days[1], "D1b", F.col("k") % 2 == 0, F.lit("other"), 1)
    run(days[3])
    run(days[3])
    land(days[2], "D2", (F.col("k") % 3 == 0) & (F.col("k") % 4 == 0), F.lit("other"), 1)
    run(days[3])
    run(days[3])
    m = table.manifest()
    got = table.read().select(
        "client_number", "status", "first_name", F.col("loaded_at").cast("date").alias("loaded"),
        F.lit(m.version).alias("versions"), F.lit(len(m.sources)).alias("landings"),
    )
    return present(got)
