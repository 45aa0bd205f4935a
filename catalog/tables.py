"""Silver-shaped tables derived from the given tables.

Each view is one SQL text that Spark and DuckDB both run, so a query and its oracle
start from equal rows.  Even orders act as system A contracts, odd orders as system B;
every row of the base tables is used.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrearium import PortfolioRules

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

AS_OF = date(2001, 8, 31)
RULES = PortfolioRules(
    b_recent_from=date(1998, 1, 1),
    activations_from=date(1996, 1, 1),
    collection_start=date(2000, 9, 1),
    history_start=date(2001, 3, 1),
    month_snapshot_start=date(2001, 1, 1),
    report_start=date(2001, 1, 1),
    report_end=date(2001, 6, 30),
)
FIRST_MONTH, LAST_MONTH = date(2001, 1, 1), date(2001, 6, 30)
COLLECTION_LAST = date(2001, 8, 31)
HISTORY_FIRST, HISTORY_LAST = date(2001, 8, 1), date(2002, 2, 28)

_MONEY = "CAST({} AS DECIMAL(18,2))"
_ID = (
    "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', "
    "CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING), '-', "
    "CAST(CAST(l_shipdate AS DATE) AS STRING), '-', "
    "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING))"
)

VIEWS: dict[str, str] = {
    "fx_payments": """
        SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS transaction_id,
         CAST(l_orderkey AS STRING) AS contract_number, concat('A', CAST(l_orderkey AS STRING)) AS account,
         CAST(l_shipdate AS DATE) AS payment_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         CASE WHEN l_returnflag = 'R' THEN 'REVERSED' ELSE 'ACCEPTED' END AS status,
         CASE WHEN l_returnflag = 'R' THEN 'REVERSED' WHEN l_linestatus = 'O' THEN 'DOWNPAYMENT_SUCCESS'
              ELSE 'PAYMENT_SUCCESS' END AS payment_code,
         l_partkey AS part_key, l_suppkey AS supp_key FROM lineitem""",
    "fx_asset_map": """
        SELECT concat('A', CAST(o_orderkey AS STRING)) AS asset_number,
         CAST(o_orderkey AS STRING) AS installation_id FROM orders WHERE o_orderkey % 7 <> 0""",
    "fx_exclusions": """
        SELECT CAST(o_orderkey AS STRING) AS contract_number FROM orders WHERE o_orderkey % 11 = 0""",
    "fx_snapshots": """
        SELECT contract_number, payment_date AS snapshot_date, count(*) AS n_tx, sum(amount) AS paid
        FROM fx_payments GROUP BY contract_number, payment_date""",
    "fx_events": """
        SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, CAST(user_id AS STRING) AS asset_id, event_type,
         CAST(value AS DECIMAL(18,2)) AS amount, props FROM events""",
    "fx_products": """
        SELECT p_partkey AS part_key, p_name AS product_name, p_brand AS brand, p_type AS product_type,
         CAST(p_retailprice AS DECIMAL(18,2)) AS list_price FROM part""",
    "activity": """
        SELECT l_orderkey AS order_key, min(CAST(l_shipdate AS DATE)) AS first_date,
         max(CAST(l_shipdate AS DATE)) AS last_date,
         sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS paid
        FROM lineitem GROUP BY l_orderkey""",
    "sold": """
        SELECT o.o_orderkey AS k, CAST(o.o_orderkey AS STRING) AS contract_number,
         o.o_custkey AS custkey, CAST(o.o_orderdate AS DATE) AS sold_on, o.o_orderstatus AS ostatus,
         o.o_orderpriority AS priority, CAST(o.o_totalprice AS DECIMAL(18,2)) AS price,
         CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * CAST(0.10 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS tenth,
         CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS monthly,
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'yes' WHEN o.o_orderpriority = '2-HIGH' THEN 'FULL'
              WHEN o.o_orderpriority = '3-MEDIUM' THEN 'NO' WHEN o.o_orderpriority = '5-LOW' THEN NULL
              ELSE 'payg' END AS deal_raw,
         x.first_date, x.last_date, CAST(x.paid AS DECIMAL(18,2)) AS paid
        FROM orders o LEFT JOIN activity x ON x.order_key = o.o_orderkey""",
    "placed": """
        SELECT s.*, c.c_name, c.c_mktsegment, n.n_name, r.r_name FROM sold s
        JOIN customer c ON c.c_custkey = s.custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
        JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "a_contracts": """
        SELECT contract_number, CASE WHEN custkey % 5 = 0 THEN 'E2' ELSE 'E1' END AS entity_name,
         CASE WHEN ostatus = 'O' THEN ' ACTIVE ' WHEN ostatus = 'P' THEN 'LOCKED' WHEN k % 8 = 0 THEN 'DISABLED'
              WHEN k % 8 = 2 THEN 'PAIDOFF' WHEN k % 8 = 4 THEN 'CANCELLED' ELSE NULL END AS status,
         CASE WHEN ostatus = 'F' AND k % 8 = 2 THEN 'Yes' ELSE 'no' END AS paid_off_status,
         deal_raw AS deal_type,
         CASE WHEN k % 38 = 0 THEN NULL ELSE CAST(sold_on AS TIMESTAMP) END AS signing_date,
         CAST(first_date AS TIMESTAMP) AS last_status_update, CAST(last_date AS TIMESTAMP) AS next_status_update,
         CASE WHEN ostatus = 'F' AND k % 8 = 2 THEN CAST(last_date AS TIMESTAMP) END AS paid_off_date,
         CASE WHEN ostatus = 'F' AND k % 8 = 0 THEN CAST(last_date AS TIMESTAMP) END AS repossession_date,
         price AS total_cost, paid AS total_paid, CAST(greatest(0, price - paid) AS DECIMAL(18,2)) AS remaining_debt,
         tenth AS upfront_payment, monthly AS monthly_payment, concat('Kit ', priority) AS product_name,
         concat('N', contract_number) AS asset_number, CAST(custkey AS STRING) AS client_number,
         c_name AS customer_name, concat('AG', CAST(custkey % 50 AS STRING)) AS agent_number,
         concat('Agent ', CAST(custkey % 50 AS STRING)) AS agent_name, r_name AS region,
         c_mktsegment AS sub_prefecture, n_name AS district, CAST(NULL AS STRING) AS village
        FROM placed WHERE k % 2 = 0""",
    "a_assets": f"""
        SELECT {_ID} AS payg_number, CAST(l_orderkey AS STRING) AS contract_number,
         CASE WHEN l_linestatus = 'O' THEN 'DEPLOYED' ELSE 'RETURNED' END AS status,
         concat('S', CAST(l_partkey AS STRING)) AS serial_number,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_shipdate AS TIMESTAMP) END AS deploy_date,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_shipdate AS TIMESTAMP) END AS date_added
        FROM lineitem WHERE l_orderkey % 2 = 0""",
    "a_payments": f"""
        SELECT {_ID} AS transaction_id, CAST(l_orderkey AS STRING) AS contract_number,
         CAST(l_shipdate AS DATE) AS payment_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         CASE WHEN l_returnflag = 'R' THEN 'REVERSED' WHEN l_quantity > 45 THEN 'PENDING'
              ELSE 'ACCEPTED' END AS status,
         CASE WHEN l_returnflag = 'R' THEN 'REVERSED'
              WHEN l_linestatus = 'O' AND l_linenumber % 3 = 0 THEN 'INCOMPLETE_DOWNPAYMENT'
              WHEN l_linestatus = 'O' THEN 'DOWNPAYMENT_SUCCESS' WHEN l_linenumber % 5 = 0 THEN 'FINAL_PAYMENT'
              WHEN l_linenumber % 5 = 1 THEN 'INCOMPLETE_PAYMENT' WHEN l_linenumber % 5 = 2 THEN 'SURVEY_SUCCESS'
              WHEN l_linenumber % 5 = 3 THEN NULL WHEN l_suppkey % 9 = 0 THEN 'MANUAL_CREDIT'
              ELSE 'PAYMENT_SUCCESS' END AS payment_code
        FROM lineitem WHERE l_orderkey % 2 = 0""",
    "b_contracts": """
        SELECT contract_number AS installation_id, CAST(custkey AS STRING) AS customer_id,
         c_name AS customer_name,
         CASE WHEN ostatus = 'O' THEN 'Active' WHEN ostatus = 'P' THEN 'Locked' WHEN k % 8 = 1 THEN 'Disabled'
              WHEN k % 8 = 3 THEN 'PaidOff' WHEN k % 8 = 5 THEN 'Awaiting Removal' ELSE 'cancelled' END AS status,
         r_name AS region, n_name AS district, c_mktsegment AS ward, c_mktsegment AS financial_type,
         last_date AS unlocked_until, sold_on AS paid_at, first_date AS activated_at,
         CASE WHEN ostatus = 'F' AND k % 8 = 1 THEN last_date END AS removed_at,
         concat('AG', CAST(custkey % 50 AS STRING)) AS installed_by
        FROM placed WHERE k % 2 = 1""",
    "b_payments": f"""
        SELECT {_ID} AS transaction_id, concat('A', CAST(l_orderkey AS STRING)) AS account,
         CAST(l_shipdate AS DATE) AS paid_time, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         CASE WHEN l_returnflag = 'R' THEN 'REVERSED' WHEN l_quantity > 48 THEN NULL
              ELSE 'CONFIRMED' END AS payment_status
        FROM lineitem WHERE l_orderkey % 2 = 1""",
    "b_products": """
        SELECT contract_number AS installation_id, concat('A', contract_number) AS asset_number,
         concat('Home ', priority) AS product_name,
         CASE WHEN priority = '2-HIGH' THEN 'FULL' WHEN priority = '5-LOW' THEN NULL ELSE 'PAYG' END AS deal_type,
         price AS total_contract_value, tenth AS upfront_payment, monthly AS monthly_payment
        FROM sold WHERE k % 2 = 1 AND k % 5 <> 0""",
    "b_paid_off": """
        SELECT contract_number, last_date AS paid_off_date FROM sold
        WHERE k % 2 = 1 AND ostatus = 'F' AND k % 8 = 3 AND last_date IS NOT NULL""",
    "ledger_months": """
        SELECT l_orderkey AS k, last_day(CAST(l_shipdate AS DATE)) AS posting_date,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS cash
        FROM lineitem WHERE l_orderkey % 2 = 1 GROUP BY l_orderkey, last_day(CAST(l_shipdate AS DATE))""",
    "b_ledger": """
        SELECT concat('OGC', CAST(k AS STRING)) AS contract_ogc, CAST(k AS STRING) AS installation_id,
         posting_date,
         CAST(sum(cash) OVER (PARTITION BY k ORDER BY posting_date) AS DECIMAL(18,2)) AS total_cash_collected,
         CASE WHEN k % 10 = 3 THEN NULL ELSE CAST(CAST(200000 AS DECIMAL(18,2)) -
              sum(cash) OVER (PARTITION BY k ORDER BY posting_date) AS DECIMAL(18,2)) END AS ending_principal
        FROM ledger_months""",
    "deploy_reference": """
        SELECT contract_number, sold_on AS deploy_date FROM sold WHERE k % 2 = 0""",
    "unlock_history": """
        SELECT 'B' AS source, CAST(l_orderkey AS STRING) AS contract_number,
         CAST(l_shipdate AS DATE) AS transaction_date, CAST(l_shipdate AS DATE) + 30 AS unlocked_until
        FROM lineitem WHERE l_orderkey % 2 = 1""",
    "snap_days": """
        SELECT l_orderkey, CAST(l_shipdate AS DATE) AS snapshot_date,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS paid, max(CAST(l_quantity AS INT)) AS q,
         min(l_returnflag) AS flag, max(l_linestatus) AS line
        FROM lineitem GROUP BY l_orderkey, CAST(l_shipdate AS DATE)""",
    "snapshots": """
        SELECT d.snapshot_date, CAST(o.o_orderkey AS STRING) AS contract_number,
         CASE WHEN o.o_orderkey % 2 = 0 AND o.o_custkey % 5 = 0 THEN 'E2' ELSE 'E1' END AS entite,
         CASE WHEN o.o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS source,
         CASE WHEN o.o_orderkey % 2 = 0 AND o.o_custkey % 5 = 0 THEN 'a_other'
              WHEN o.o_orderkey % 2 = 0 THEN 'a_main' WHEN o.o_orderkey % 11 = 0 THEN 'b_excluded'
              WHEN o.o_orderdate >= DATE '1998-01-01' THEN 'b_recent' ELSE 'b_old' END AS categorie,
         CASE WHEN flag = 'A' THEN 'ENABLED' WHEN flag = 'N' AND line = 'O' THEN 'LOCKED'
              WHEN flag = 'N' THEN NULL WHEN line = 'O' THEN 'REPOSSESSED' ELSE 'CANCELLED' END AS contract_status,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'FULL' ELSE 'PAYG' END AS deal_type,
         CASE WHEN o.o_orderstatus = 'F' AND o.o_orderkey % 8 IN (2, 3) THEN 'true' ELSE 'false' END AS paid_off,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_contract_value,
         CAST(d.paid AS DECIMAL(18,2)) AS total_paid,
         CAST(greatest(0, CAST(o.o_totalprice AS DECIMAL(18,2)) - d.paid) AS DECIMAL(18,2)) AS remaining_debt,
         CASE WHEN q % 10 = 0 THEN 0 WHEN q % 10 = 1 THEN NULL ELSE q * 3 END AS consecutive_locked_days,
         CAST(NULL AS STRING) AS region
        FROM snap_days d JOIN orders o ON o.o_orderkey = d.l_orderkey""",
    "run_log": """
        SELECT event_type AS source, concat('e', CAST(user_id % 20 AS STRING)) AS entity,
         CAST(ts AS DATE) AS run_date, CAST(ts AS TIMESTAMP) AS run_at,
         CASE WHEN value < 60 THEN 'error' ELSE 'success' END AS status, event_id AS rows_count FROM events""",
}


def needed(text: str, known: dict[str, str]) -> list[str]:
    """Views a SQL text uses, directly or through other views, in definition order."""
    found: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"[a-z_][a-z_0-9]*", todo.pop()))
        for name in words & known.keys() - found:
            found.add(name)
            todo.append(known[name])
    return [n for n in known if n in found]


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """The SQL text with the views it uses as common table expressions."""
    known = {**VIEWS, **(extra or {})}
    body = sql.strip()
    names = needed(body, known)
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS ({known[n].strip()})" for n in names)
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


class Tables:
    """The given tables of one folder and the views over them, as DataFrames.

    ``Tables.of`` keeps one instance per session and folder, so a table's schema is read
    and a view's SQL analysed once; only plans are kept, never data.
    """

    _known: ClassVar[dict[tuple[str, str], Tables]] = {}
    _views_of: ClassVar[dict[str, str]] = {}

    def __init__(self, spark: SparkSession, folder: str) -> None:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Tables:
        key = (spark.sparkContext.applicationId, folder)
        known = cls._known.get(key)
        if known is None or known.spark is not spark:
            known = cls._known[key] = cls(spark, folder)
        return known

    def base(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]

    def sql(self, text: str) -> DataFrame:
        app = self.spark.sparkContext.applicationId
        if self._views_of.get(app) != self.folder:
            for name in BASE:
                self.base(name).createOrReplaceTempView(name)
            self._views_of[app] = self.folder
        return self.spark.sql(with_views(text))

    def keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The plan ``build`` makes, made once."""
        if name not in self._frames:
            self._frames[name] = build()
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.base(name)
        if name not in VIEWS:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self.sql(f"SELECT * FROM {name}")
        return self._frames[name]


def present(df: DataFrame, round_to: dict[str, int] | None = None) -> DataFrame:
    """Engine-neutral output types: decimals as doubles, dates and times as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if round_to and f.name in round_to:
            c = F.round(c, round_to[f.name])
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return df.select(*out)
