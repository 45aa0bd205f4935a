"""Deduplication, upserts and inserts over the line items (one key has several versions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrearium.operators import fold, slices
from catalog.registry import dbl, query, rnd, txt, ts
from catalog.tables import VIEWS, Tables, present

VIEWS["versions"] = """
    SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS seen_on, l_partkey, l_suppkey,
     CAST(l_quantity AS DECIMAL(18,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
     CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag END AS status, l_linestatus AS kind FROM lineitem"""
VIEWS["old_batch"] = "SELECT * FROM versions WHERE seen_on < DATE '1999-01-01'"
VIEWS["new_batch"] = "SELECT * FROM versions WHERE seen_on >= DATE '1999-01-01'"

KEYS = ["l_orderkey", "l_linenumber"]
ORDER = ["seen_on", "l_partkey", "l_suppkey", "price", "quantity"]
SQL_ORDER = "seen_on{d}, l_partkey{d}, l_suppkey{d}, price{d}, quantity{d}"
MUTABLE = ["status", "price"]

COLUMNS = f"""l_orderkey, l_linenumber, {txt('seen_on')} AS seen_on, l_partkey, l_suppkey, {dbl('quantity')} AS quantity,
    {dbl('price')} AS price, status, kind"""


def _ranked(view: str, descending: bool) -> str:
    by = SQL_ORDER.format(d=" DESC" if descending else "")
    return f"(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {by}) AS pos FROM {view})"


@query("dedup_keep_last", f"SELECT {COLUMNS} FROM {_ranked('versions', True)} WHERE pos = 1")
def dedup_keep_last(t: Tables):
    return present(fold.keep_last(t.versions, KEYS, ORDER))


@query("dedup_keep_first", f"SELECT {COLUMNS} FROM {_ranked('versions', False)} WHERE pos = 1")
def dedup_keep_first(t: Tables):
    return present(fold.keep_first(t.versions, KEYS, ORDER))


@query("upsert_fold_full", f"SELECT {COLUMNS} FROM {_ranked('versions', True)} WHERE pos = 1")
def upsert_fold_full(t: Tables):
    """Stored rows, then one batch that replaces every column."""
    stored = fold.keep_last(t.old_batch, KEYS, ORDER)
    every = [c for c in stored.columns if c not in KEYS]
    return present(fold.upsert(stored, t.new_batch, KEYS, every, ORDER))


STICKY_SQL = f"""
    SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, {dbl('f.quantity')} AS quantity, f.kind, l.status,
     {dbl('l.price')} AS price, {ts('f.seen_on')} AS loaded_at, {ts('l.seen_on')} AS updated_at
    FROM {_ranked('versions', False)} f JOIN {_ranked('versions', True)} l USING (l_orderkey, l_linenumber)
    WHERE f.pos = 1 AND l.pos = 1"""


@query("upsert_fold_sticky", STICKY_SQL)
def upsert_fold_sticky(t: Tables):
    """Status and price follow the newest version (null included); the rest stays as first seen."""
    versions = t.versions.select(
        *KEYS, "l_partkey", "quantity", "kind", *MUTABLE, F.col("seen_on").cast("timestamp").alias("batch_at"),
        F.struct(*ORDER).alias("seq"),
    )
    return present(fold.fold_versions(versions, KEYS, MUTABLE, ["seq"], "batch_at"))


@query(
    "upsert_touched_keys",
    f"""SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, {dbl('f.quantity')} AS quantity, f.kind, l.status,
     {dbl('l.price')} AS price
    FROM {_ranked('versions', False)} f JOIN {_ranked('versions', True)} l USING (l_orderkey, l_linenumber)
    WHERE f.pos = 1 AND l.pos = 1""",
)
def upsert_touched_keys(t: Tables):
    """The sticky upsert in two steps: stored rows, then a batch that touches some keys."""
    columns = [*KEYS, "l_partkey", "quantity", "kind", *MUTABLE]
    stored = fold.fold_versions(
        t.old_batch.select(*columns, F.struct(*ORDER).alias("seq")), KEYS, MUTABLE, ["seq"]
    )
    batch = t.new_batch.select(*columns, F.struct(*ORDER).alias("seq"))
    return present(fold.upsert_touched(stored.select(*columns), batch, KEYS, MUTABLE, ["seq"]))


@query(
    "insert_ignore",
    f"""SELECT {COLUMNS} FROM {_ranked('new_batch', False)} n WHERE pos = 1 AND NOT EXISTS (
      SELECT 1 FROM old_batch o WHERE o.l_orderkey = n.l_orderkey AND o.l_linenumber = n.l_linenumber)""",
)
def insert_ignore(t: Tables):
    return present(fold.insert_ignore(t.old_batch, t.new_batch, KEYS, ORDER))


@query(
    "latest_per_key",
    f"""SELECT contract_number, payg_number, {ts('deployed')} AS deploy_date, serial_number, status AS asset_status
    FROM (SELECT contract_number, payg_number, coalesce(deploy_date, date_added) AS deployed, serial_number, status,
       row_number() OVER (PARTITION BY contract_number
         ORDER BY coalesce(deploy_date, date_added) DESC NULLS LAST, payg_number DESC) AS pos
      FROM a_assets WHERE status = 'DEPLOYED') WHERE pos = 1""",
)
def latest_per_key(t: Tables):
    from arrearium.plans.contracts import latest_deployment

    return present(latest_deployment(t.a_assets))


@query(
    "latest_per_key_any_status",
    f"""SELECT contract_number, payg_number, {ts('deploy_date')} AS deploy_date, serial_number, status AS asset_status
    FROM (SELECT *, row_number() OVER (PARTITION BY contract_number
         ORDER BY deploy_date DESC NULLS LAST, payg_number DESC) AS pos FROM a_assets) WHERE pos = 1""",
)
def latest_per_key_any_status(t: Tables):
    from arrearium.plans.contracts import latest_deployment

    return present(latest_deployment(t.a_assets, deployed_only=False))


@query(
    "schema_evolve_union",
    f"""SELECT l_orderkey, l_linenumber, {dbl('price')} AS price, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS kind FROM old_batch
    UNION ALL SELECT l_orderkey, l_linenumber, {dbl('price')}, status, kind FROM new_batch""",
)
def schema_evolve_union(t: Tables):
    first = t.old_batch.select(*KEYS, "price")
    second = t.new_batch.select(*KEYS, "price", "status", "kind")
    return present(slices.union_versions(first, second))


@query(
    "union_sources",
    f"""SELECT 'a' AS feed, transaction_id, {ts('payment_date')} AS paid_at, {dbl('amount')} AS amount FROM a_payments
    UNION ALL SELECT 'b', transaction_id, {ts('paid_time')}, {dbl('amount')} FROM b_payments
    UNION ALL SELECT 'cash', contract_ogc, {ts('posting_date')}, {dbl('total_cash_collected')} FROM b_ledger""",
)
def union_sources(t: Tables):
    def feed(df, name, key, at, amount):
        return df.select(
            F.lit(name).alias("feed"), F.col(key).alias("transaction_id"),
            F.col(at).cast("timestamp").alias("paid_at"), F.col(amount).alias("amount"),
        )

    a = feed(t.a_payments, "a", "transaction_id", "payment_date", "amount")
    b = feed(t.b_payments, "b", "transaction_id", "paid_time", "amount")
    cash = feed(t.b_ledger, "cash", "contract_ogc", "posting_date", "total_cash_collected")
    return present(a.unionByName(b).unionByName(cash))


@query(
    "snapshot_volume_by_status",
    f"""SELECT categorie, contract_status, count(*) AS nb, {rnd('CAST(sum(total_paid) AS DOUBLE) / 1e6', 2)} AS paid_millions
    FROM snapshots GROUP BY 1, 2""",
)
def snapshot_volume_by_status(t: Tables):
    return present(
        t.snapshots.groupBy("categorie", "contract_status").agg(
            F.count(F.lit(1)).alias("nb"), F.round(F.sum("total_paid") / 1_000_000, 2).alias("paid_millions")
        )
    )
