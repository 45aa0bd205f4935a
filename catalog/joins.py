"""Joins, as-of lookups, aggregates and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrearium import values
from arrearium.functions.amounts import sum_if
from arrearium.operators import asof, distinct, joins, windows
from arrearium.plans import contracts as co
from arrearium.plans.snapshots import _snapshots_of
from arrearium.session import scratch_path
from catalog.kpis import REPORT, financials
from catalog.registry import dbl, months, part_of, query, ts, txt
from catalog.tables import FIRST_MONTH, LAST_MONTH, RULES, VIEWS, Tables, present


@query(
    "join_inner",
    f"""SELECT c.entity_name, c.status, p.payment_code, count(*) AS n, {dbl('sum(p.amount)')} AS amount
    FROM a_payments p JOIN a_contracts c ON c.contract_number = p.contract_number GROUP BY ALL""",
)
def join_inner(t: Tables):
    paid = t.a_payments.groupBy("contract_number", "payment_code").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )
    contracts = t.a_contracts.select("contract_number", "entity_name", "status")
    return present(
        paid.join(contracts, "contract_number")
        .groupBy("entity_name", "status", "payment_code")
        .agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
    )


@query(
    "join_left",
    f"""SELECT c.contract_number, a.payg_number, {dbl('p.total')} AS total FROM a_contracts c
    LEFT JOIN o_asset a ON a.contract_number = c.contract_number
    LEFT JOIN (SELECT contract_number, sum(amount) AS total FROM a_payments GROUP BY 1) p ON p.contract_number = c.contract_number""",
)
def join_left(t: Tables):
    assets = co.latest_deployment(t.a_assets).select("contract_number", "payg_number")
    paid = t.a_payments.groupBy("contract_number").agg(F.sum("amount").alias("total"))
    return present(
        t.a_contracts.select("contract_number")
        .join(assets, "contract_number", "left")
        .join(paid, "contract_number", "left")
    )


@query(
    "join_bridge",
    f"""SELECT m.installation_id, p.status, {dbl('sum(p.amount)')} AS amount FROM fx_payments p
    JOIN fx_asset_map m ON m.asset_number = p.account JOIN sold c ON c.contract_number = m.installation_id GROUP BY 1, 2""",
)
def join_bridge(t: Tables):
    sums = joins.bridge_sums(
        t.fx_payments, "account", t.fx_asset_map, "asset_number", "installation_id", ["status"], ["amount"]
    )
    known = t.sold.select(F.col("contract_number").alias("installation_id"))
    return present(sums.join(known, "installation_id", "left_semi"))


@query(
    "join_broadcast_lookup",
    f"""SELECT f.brand, f.product_type, count(*) AS n, {dbl('sum(p.amount)')} AS amount,
     {dbl('sum(f.list_price)')} AS list_value
    FROM fx_payments p LEFT JOIN fx_products f ON f.part_key = p.part_key GROUP BY 1, 2""",
)
def join_broadcast_lookup(t: Tables):
    # Summed per product first: a best-seller is one row per task.  No hint: Spark
    # broadcasts the lookup while its measured size is below the threshold.
    per_part = t.fx_payments.groupBy("part_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )
    return present(
        per_part.join(t.fx_products, "part_key", "left")
        .groupBy("brand", "product_type")
        .agg(
            F.sum("n").alias("n"), F.sum("amount").alias("amount"),
            F.sum(F.col("list_price") * F.col("n")).alias("list_value"),
        )
    )


@query(
    "join_trunc_month",
    f"""SELECT {txt('m.ms')} AS month_start, p.status, count(*) AS n, {dbl('sum(p.amount)')} AS amount
    FROM {REPORT} m JOIN fx_payments p ON date_trunc('month', p.payment_date) = m.ms GROUP BY 1, 2""",
)
def join_trunc_month(t: Tables):
    from arrearium.functions.dates import calendar

    # The calendar's bounds on the raw date reach the scan.
    inside = F.col("payment_date").between(F.lit(FIRST_MONTH), F.last_day(F.lit(LAST_MONTH)))
    per_month = t.fx_payments.where(inside).groupBy(F.trunc("payment_date", "MM").alias("month_start"), "status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )
    spine = calendar(t.spark, FIRST_MONTH, LAST_MONTH).select("month_start")
    return present(spine.join(per_month, "month_start"))


# The as-of operator against a plain range join and ranking.
def _naive(table: str, key: str, on: str, cols: str, first: str, last: str, low: str, high: str) -> str:
    return f"""
    SELECT {txt('ms')} AS month_start, {txt('me')} AS month_end, {cols} FROM (
      SELECT m.ms, m.me, s.*, row_number() OVER (PARTITION BY m.me, s.{key} ORDER BY s.{on} DESC) AS pos
      FROM {months(first, last)} m JOIN {table} s ON s.{on} <= {high} {low})
    WHERE pos = 1"""


_SNAP_COLS = f"contract_number, {txt('snapshot_date')} AS snapshot_date, n_tx, {dbl('paid')} AS paid"


@query(
    "asof_lookback_45d",
    _naive("fx_snapshots", "contract_number", "snapshot_date", _SNAP_COLS, "2000-09-01", "2001-08-01",
           "AND s.snapshot_date >= m.ms - INTERVAL 45 DAY", "m.me"),
)
def asof_lookback_45d(t: Tables):
    return present(
        asof.asof_month_ends(
            t.fx_snapshots, "contract_number", "snapshot_date", "2000-09-01", "2001-08-31", lookback_days=45
        )
    )


@query(
    "asof_lookback_grace",
    _naive("fx_snapshots", "contract_number", "snapshot_date", _SNAP_COLS, "2000-09-01", "2001-08-01",
           "AND s.snapshot_date >= m.ms - INTERVAL 45 DAY", "m.me + INTERVAL 3 DAY"),
)
def asof_lookback_grace(t: Tables):
    return present(
        asof.asof_month_ends(
            t.fx_snapshots, "contract_number", "snapshot_date", "2000-09-01", "2001-08-31",
            lookback_days=45, grace_days=3,
        )
    )


@query(
    "asof_unbounded",
    _naive("fx_snapshots", "contract_number", "snapshot_date", _SNAP_COLS, "2000-09-01", "2001-08-01", "", "m.me"),
)
def asof_unbounded(t: Tables):
    return present(
        asof.asof_month_ends(t.fx_snapshots, "contract_number", "snapshot_date", "2000-09-01", "2001-08-31")
    )


@query(
    "asof_unlock_history",
    f"""SELECT {txt('ms')} AS month_start, {txt('me')} AS month_end, contract_number, {txt('transaction_date')} AS transaction_date,
     {txt('unlocked_until')} AS unlocked_until FROM (
      SELECT m.ms, m.me, h.contract_number, h.transaction_date, h.unlocked_until,
       row_number() OVER (PARTITION BY m.me, h.contract_number ORDER BY h.transaction_date DESC) AS pos
      FROM {REPORT} m JOIN unlock_history h ON h.transaction_date <= m.me WHERE h.source = 'B') WHERE pos = 1""",
)
def asof_unlock_history(t: Tables):
    history = t.unlock_history.filter(F.col("source") == "B").drop("source")
    return present(
        asof.asof_month_ends(
            history, "contract_number", "transaction_date", FIRST_MONTH, LAST_MONTH, tie=["unlocked_until"]
        )
    )


@query(
    "asof_filtered_source",
    f"""SELECT {txt('ms')} AS month_start, {txt('me')} AS month_end, contract_number, {txt('snapshot_date')} AS snapshot_date,
     contract_status, consecutive_locked_days FROM o_end_b""",
)
def asof_filtered_source(t: Tables):
    rows = _snapshots_of(t.snapshots, "B", RULES).select(
        "contract_number", "snapshot_date", "contract_status", "consecutive_locked_days"
    )
    return present(
        asof.asof_month_ends(
            rows, "contract_number", "snapshot_date", FIRST_MONTH, LAST_MONTH, lookback_days=45, grace_days=3
        )
    )


@query(
    "ledger_asof",
    f"""SELECT contract_ogc, installation_id, {txt('posting_date')} AS posting_date,
     {dbl('total_cash_collected')} AS total_cash_collected, {dbl('ending_principal')} AS ending_principal FROM (
      SELECT *, row_number() OVER (PARTITION BY installation_id ORDER BY posting_date DESC, contract_ogc DESC) AS pos FROM b_ledger
      WHERE posting_date <= DATE '2001-03-31') WHERE pos = 1""",
)
def ledger_asof(t: Tables):
    return present(
        asof.latest_until(t.b_ledger, "installation_id", "posting_date", "2001-03-31", ["contract_ogc"])
    )


@query(
    "mark_join_category",
    """SELECT b.installation_id, e.contract_number IS NOT NULL AS excluded,
     CASE WHEN e.contract_number IS NOT NULL THEN 'b_excluded' WHEN b.paid_at >= DATE '1998-01-01' THEN 'b_recent'
      ELSE 'b_old' END AS categorie
    FROM b_contracts b LEFT JOIN fx_exclusions e ON e.contract_number = b.installation_id""",
)
def mark_join_category(t: Tables):
    marked = joins.mark(t.b_contracts, t.fx_exclusions, "installation_id", "contract_number", "excluded")
    return marked.select(
        "installation_id", "excluded",
        co.b_category(F.col("excluded"), F.col("paid_at"), RULES).alias("categorie"),
    )


VIEWS["list_with_null"] = """
    SELECT contract_number FROM fx_exclusions UNION ALL SELECT CAST(NULL AS STRING) AS contract_number
    FROM region WHERE r_regionkey = 0"""


@query(
    "anti_join_list",
    """SELECT 'not listed' AS rule, p.account AS key, count(*) AS n FROM b_payments p
      WHERE NOT EXISTS (SELECT 1 FROM list_with_null e WHERE concat('A', e.contract_number) = p.account) GROUP BY 2
    UNION ALL SELECT 'not in', account, count(*) FROM b_payments
      WHERE account NOT IN (SELECT concat('A', contract_number) FROM fx_exclusions) GROUP BY 2
    UNION ALL SELECT 'not in, null listed', account, count(*) FROM b_payments
      WHERE substr(account, 2) NOT IN (SELECT contract_number FROM list_with_null) GROUP BY 2
    UNION ALL SELECT 'not in, empty list', coalesce(payment_status, '-'), count(*) FROM b_payments
      WHERE payment_status NOT IN (SELECT contract_number FROM fx_exclusions WHERE contract_number = 'x') GROUP BY 2""",
)
def anti_join_list(t: Tables):
    accounts = t.b_payments.groupBy(F.col("account").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    states = t.b_payments.groupBy(F.col("payment_status").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    with_null, listed = t.list_with_null, t.fx_exclusions
    account_of = F.concat(F.lit("A"), "contract_number").alias("m")
    parts = [
        ("not listed", joins.not_listed(accounts, with_null.select(account_of), "key", "m")),
        ("not in", joins.not_in(accounts, listed.select(account_of), "key", "m")),
        ("not in, null listed", joins.not_in(accounts, with_null.select(account_of), "key", "m")),
        (
            "not in, empty list",
            joins.not_in(states, listed.filter("contract_number = 'x'"), "key", "contract_number").fillna({"key": "-"}),
        ),
    ]
    out = None
    for rule, df in parts:
        df = df.select(F.lit(rule).alias("rule"), "key", "n")
        out = df if out is None else out.unionByName(df)
    return out


@query(
    "reconcile_match_rate",
    f"""SELECT count(m.asset_number) AS matched, count(*) AS total, {part_of('count(m.asset_number)', 'count(*)', 1)} AS match_pct
    FROM fx_payments p LEFT JOIN (SELECT asset_number FROM fx_asset_map JOIN sold ON contract_number = installation_id) m
     ON m.asset_number = p.account""",
)
def reconcile_match_rate(t: Tables):
    return present(
        joins.match_rate(
            t.fx_payments, "account", t.fx_asset_map, "asset_number", "installation_id", t.sold, "contract_number"
        )
    )


# ---- aggregates ------------------------------------------------------------------


@query(
    "paid_split_by_code",
    f"""SELECT {txt("date_trunc('month', payment_date)")} AS month_start,
     {dbl("sum(amount) FILTER (WHERE payment_code IN ('DOWNPAYMENT_SUCCESS', 'INCOMPLETE_DOWNPAYMENT'))")} AS paid_upfront,
     {dbl("sum(amount) FILTER (WHERE payment_code IN ('PAYMENT_SUCCESS', 'INCOMPLETE_PAYMENT', 'FINAL_PAYMENT'))")} AS paid_recharge,
     count(*) FILTER (WHERE payment_code IS NULL) AS n_without_code
    FROM a_payments WHERE status = 'ACCEPTED' GROUP BY 1""",
)
def paid_split_by_code(t: Tables):
    code, amount = F.col("payment_code"), F.col("amount")
    return present(
        t.a_payments.filter(F.col("status") == "ACCEPTED")
        .groupBy(F.trunc("payment_date", "MM").alias("month_start"))
        .agg(
            sum_if(code.isin(*values.UPFRONT_CODES), amount).alias("paid_upfront"),
            sum_if(code.isin(*values.RECHARGE_CODES), amount).alias("paid_recharge"),
            F.count_if(code.isNull()).alias("n_without_code"),
        )
    )


@query(
    "ledger_profile",
    f"""SELECT {txt('min(posting_date)')} AS first_posting, {txt('max(posting_date)')} AS last_posting,
     count(DISTINCT contract_ogc) AS contracts, count(DISTINCT installation_id) AS installations FROM b_ledger""",
)
def ledger_profile(t: Tables):
    return present(
        t.b_ledger.agg(
            F.min("posting_date").alias("first_posting"), F.max("posting_date").alias("last_posting"),
            F.count_distinct("contract_ogc").alias("contracts"),
            F.count_distinct("installation_id").alias("installations"),
        )
    )


@query(
    "ledger_profile_merged",
    """SELECT year(posting_date) AS year, count(DISTINCT contract_ogc) AS contracts, count(DISTINCT installation_id) AS installations
    FROM b_ledger GROUP BY 1 UNION ALL
    SELECT NULL, count(DISTINCT contract_ogc), count(DISTINCT installation_id) FROM b_ledger""",
)
def ledger_profile_merged(t: Tables):
    """Distinct ids per year and in all, merged from bitmaps kept per month; the ids come in two batches."""
    ledger = t.b_ledger.withColumn("month", F.trunc("posting_date", "MM"))
    cut = F.lit("1997-01-01").cast("date")
    out = None
    for id, name in (("contract_ogc", "contracts"), ("installation_id", "installations")):
        path = scratch_path(t.spark, "dictionary")
        distinct.number_ids(ledger.where(F.col("month") < cut), id).write.parquet(path)
        distinct.number_ids(ledger, id, t.spark.read.parquet(path)).write.mode("append").parquet(path)
        kept = scratch_path(t.spark, "bitmaps")
        distinct.slice_bitmaps(ledger, t.spark.read.parquet(path), id, ["month"]).write.parquet(kept)
        months = t.spark.read.parquet(kept)
        years = distinct.merged_count(months.withColumn("year", F.year("month")), ["year"], name)
        both = years.unionByName(distinct.merged_count(months, [], name).withColumn("year", F.lit(None).cast("int")))
        out = both if out is None else out.withColumnRenamed("year", "y").join(both, F.col("y").eqNullSafe(F.col("year"))).drop("y")
    return out.select("year", "contracts", "installations")


@query(
    "coverage_by_entity",
    """SELECT entity_name, count(*) AS n, count(signing_date) AS with_signing, count(status) AS with_status,
     count(next_status_update) AS with_next, count(CASE WHEN status = 'LOCKED' THEN 1 END) AS locked
    FROM a_contracts GROUP BY 1""",
)
def coverage_by_entity(t: Tables):
    return t.a_contracts.groupBy("entity_name").agg(
        F.count(F.lit(1)).alias("n"), F.count("signing_date").alias("with_signing"),
        F.count("status").alias("with_status"), F.count("next_status_update").alias("with_next"),
        F.count_if(F.col("status") == "LOCKED").alias("locked"),
    )


@query(
    "stats_by_code",
    f"""SELECT payment_code, count(*) AS n, {dbl('sum(amount)')} AS amount, {part_of('sum(amount)', 'count(amount)', 0, 1.0)} AS mean_amount
    FROM a_payments GROUP BY 1""",
)
def stats_by_code(t: Tables):
    from arrearium.functions.amounts import mean_of

    return present(
        t.a_payments.groupBy("payment_code").agg(
            F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"),
            mean_of(F.col("amount"), 0).alias("mean_amount"),
        )
    )


@query(
    "stats_by_deal",
    f"""SELECT deal_type, count(*) AS n, {part_of('sum(total_contract_value)', 'count(total_contract_value)', 0, 1.0)} AS avg_value
    FROM b_products GROUP BY 1""",
)
def stats_by_deal(t: Tables):
    from arrearium.functions.amounts import mean_of

    return present(
        t.b_products.groupBy("deal_type").agg(
            F.count(F.lit(1)).alias("n"), mean_of(F.col("total_contract_value"), 0).alias("avg_value")
        )
    )


@query(
    "financials_fallback",
    f"""SELECT installation_id, {dbl('total_paid')} AS total_paid, {ts('last_paid')} AS last_payment_date FROM o_fin""",
)
def financials_fallback(t: Tables):
    return present(financials(t))


@query(
    "financials_latest_ledger",
    f"""SELECT installation_id, {dbl('total_paid')} AS total_paid, {ts('last_paid')} AS last_payment_date FROM o_paid_b
    UNION ALL SELECT l.installation_id, {dbl('l.total_cash_collected')}, {ts('l.posting_date')}
    FROM (SELECT *, row_number() OVER (PARTITION BY installation_id ORDER BY posting_date DESC, contract_ogc DESC) AS pos FROM b_ledger) l
    LEFT JOIN o_paid_b p ON p.installation_id = l.installation_id WHERE p.installation_id IS NULL AND l.pos = 1""",
)
def financials_latest_ledger(t: Tables):
    return present(financials(t, latest=True))


@query(
    "financials_ledger_first",
    f"""SELECT coalesce(l.installation_id, p.installation_id) AS installation_id,
     {dbl('coalesce(l.total, p.total_paid, 0)')} AS total_paid
    FROM (SELECT installation_id, sum(total_cash_collected) AS total FROM b_ledger GROUP BY 1) l
    FULL OUTER JOIN o_paid_b p ON p.installation_id = l.installation_id""",
)
def financials_ledger_first(t: Tables):
    ledger = co.ledger_totals(t.b_ledger)
    paid = co.b_payment_totals(t.b_payments, t.fx_asset_map)
    return present(joins.first_known(ledger, paid, "installation_id", "total_paid", F.lit(0)))


# ---- windows ---------------------------------------------------------------------


@query(
    "first_payment_class",
    f"""SELECT p.transaction_id, m.installation_id, {dbl('p.amount')} AS amount,
     row_number() OVER (PARTITION BY m.installation_id ORDER BY p.paid_time, p.transaction_id) = 1 AS is_first
    FROM b_payments p JOIN fx_asset_map m ON m.asset_number = p.account WHERE p.payment_status <> 'REVERSED'""",
)
def first_payment_class(t: Tables):
    from arrearium.plans.payments import b_collected, with_first_payment

    marked = with_first_payment(b_collected(t.b_payments), t.fx_asset_map)
    return present(marked.select("transaction_id", "installation_id", "amount", "is_first"))


@query(
    "mark_first_per_contract",
    f"""SELECT transaction_id, contract_number, {dbl('amount')} AS amount,
     row_number() OVER (PARTITION BY contract_number ORDER BY payment_date, transaction_id) = 1 AS is_first FROM a_payments""",
)
def mark_first_per_contract(t: Tables):
    marked = windows.mark_first(t.a_payments, "contract_number", "transaction_id", ["payment_date"], "is_first")
    return present(marked.select("transaction_id", "contract_number", "amount", "is_first"))


@query(
    "join_row_level",
    f"""SELECT p.transaction_id, m.installation_id, {dbl('p.amount')} AS amount FROM b_payments p
    JOIN fx_asset_map m ON m.asset_number = p.account""",
)
def join_row_level(t: Tables):
    linked = joins.spread_join(t.b_payments, t.fx_asset_map, "account", "asset_number", "transaction_id")
    return present(linked.select("transaction_id", "installation_id", "amount"))


@query(
    "running_total_monthly",
    f"""SELECT contract_number, {txt("date_trunc('month', payment_date)")} AS month_start,
     {dbl('sum(amount)')} AS month_amount, {dbl('''sum(sum(amount)) OVER (PARTITION BY contract_number
       ORDER BY date_trunc('month', payment_date))''')} AS total_paid
    FROM fx_payments WHERE status <> 'REVERSED' GROUP BY contract_number, date_trunc('month', payment_date)""",
)
def running_total_monthly(t: Tables):
    paid = t.fx_payments.filter(F.col("status") != "REVERSED")
    return present(
        windows.monthly_running_total(paid, "contract_number", "payment_date", "amount", "total_paid")
    )
