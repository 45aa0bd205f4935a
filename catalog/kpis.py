"""Portfolio tables and KPIs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from arrearium.functions.dates import calendar
from arrearium.operators import layout, slices
from arrearium.plans import collection, contracts as co, payments as pay, portfolio, report, snapshots as sn
from arrearium.plans.repayment import linearized_repayment
from arrearium.session import scratch_path
from catalog.registry import ORACLE_VIEWS, dbl, eur, months, part_of, query, rnd, ts, txt
from catalog.tables import (
    VIEWS,
    AS_OF, COLLECTION_LAST, FIRST_MONTH, HISTORY_FIRST, HISTORY_LAST, LAST_MONTH, RULES, Tables, present,
)

D = "DATE '2001-08-31'"
REPORT = months("2001-01-01", "2001-06-30")
COLLECT = months("2000-09-01", "2001-08-31")
HISTORY = months("2001-08-01", "2002-02-28")  # some of these months have snapshots


def financials(t: Tables, latest: bool = False):
    return co.b_financials(t.b_payments, t.fx_asset_map, t.b_ledger, latest)


def contracts(t: Tables):
    return t.keep(
        "unified contracts",
        lambda: co.unified_contracts(
            t.a_contracts, t.a_assets, t.b_contracts, financials(t), t.b_products, t.fx_exclusions,
            t.b_paid_off, RULES, AS_OF,
        ),
    )


ORACLE_VIEWS["o_paid_b"] = """
    SELECT m.installation_id, sum(p.amount) AS total_paid, max(p.paid_time) AS last_paid
    FROM b_payments p, fx_asset_map m
    WHERE m.asset_number = p.account AND p.payment_status <> 'REVERSED' GROUP BY m.installation_id"""
ORACLE_VIEWS["o_fin"] = """
    SELECT installation_id, total_paid, last_paid FROM o_paid_b
    UNION ALL
    SELECT l.installation_id, sum(l.total_cash_collected), max(l.posting_date) FROM b_ledger l
    LEFT JOIN o_paid_b p ON p.installation_id = l.installation_id
    WHERE p.installation_id IS NULL GROUP BY l.installation_id"""
ORACLE_VIEWS["o_asset"] = """
    SELECT * FROM (
      SELECT contract_number, payg_number, coalesce(deploy_date, date_added) AS deployed, serial_number, status,
       row_number() OVER (PARTITION BY contract_number
         ORDER BY coalesce(deploy_date, date_added) DESC NULLS LAST, payg_number DESC) AS pos
      FROM a_assets WHERE status = 'DEPLOYED' AND contract_number IS NOT NULL) WHERE pos = 1"""
ORACLE_VIEWS["o_raw"] = """
    SELECT a.contract_number, if(a.entity_name = 'E2', 'E2', 'E1') AS entite, 'A' AS source,
     if(a.entity_name = 'E2', 'a_other', 'a_main') AS categorie, a.client_number, a.customer_name,
     a.agent_number, a.agent_name, CAST(a.signing_date AS DATE) AS paid_date, CAST(x.deployed AS DATE) AS registration_date,
     CAST(a.last_status_update AS DATE) AS last_status_update, CAST(a.next_status_update AS DATE) AS next_status_update,
     CAST(a.paid_off_date AS DATE) AS paid_off_date, CAST(a.repossession_date AS DATE) AS repossession_date,
     a.product_name, coalesce(x.payg_number, a.asset_number) AS asset_number, a.deal_type AS deal_raw,
     a.total_cost AS total_contract_value, a.upfront_payment, a.monthly_payment, a.total_paid, a.remaining_debt,
     a.status AS status_raw, a.paid_off_status AS paid_off_raw, a.region, a.district AS sub_prefecture, a.village
    FROM a_contracts a LEFT JOIN o_asset x USING (contract_number)
    WHERE a.signing_date IS NOT NULL AND trim(a.contract_number) <> ''
    UNION ALL
    SELECT b.installation_id, 'E1', 'B',
     CASE WHEN EXISTS (SELECT 1 FROM fx_exclusions e WHERE e.contract_number = b.installation_id) THEN 'b_excluded'
          WHEN b.paid_at >= DATE '1998-01-01' THEN 'b_recent' ELSE 'b_old' END,
     b.customer_id, b.customer_name, NULL, b.installed_by, b.paid_at, b.activated_at, b.paid_at, b.unlocked_until,
     o.paid_off_date, b.removed_at, coalesce(p.product_name, b.financial_type), NULL, coalesce(p.deal_type, 'PAYG'),
     p.total_contract_value, p.upfront_payment, p.monthly_payment, coalesce(f.total_paid, 0),
     CASE WHEN p.total_contract_value IS NOT NULL
          THEN greatest(0, p.total_contract_value - coalesce(f.total_paid, 0)) END,
     b.status, if(o.paid_off_date IS NULL, 'no', 'yes'), b.region, b.ward, NULL
    FROM b_contracts b LEFT JOIN o_fin f USING (installation_id) LEFT JOIN b_products p USING (installation_id)
    LEFT JOIN b_paid_off o ON o.contract_number = b.installation_id"""
ORACLE_VIEWS["o_normal"] = """
    SELECT *, CASE WHEN source = 'B' AND paid_off_date IS NOT NULL THEN 'PAID_OFF'
      ELSE CASE upper(trim(status_raw)) WHEN 'ACTIVE' THEN 'ENABLED' WHEN 'AWAITING REMOVAL' THEN 'ENABLED'
        WHEN 'DISABLED' THEN 'REPOSSESSED' WHEN 'PAIDOFF' THEN 'PAID_OFF' ELSE upper(trim(status_raw)) END
      END AS contract_status,
     if(lower(trim(paid_off_raw)) IN ('yes', 'true', '1'), 'true', 'false') AS paid_off,
     if(upper(trim(deal_raw)) IN ('YES', 'FULL'), 'FULL', 'PAYG') AS deal_type
    FROM o_raw"""
ORACLE_VIEWS["g1"] = f"""
    SELECT *, CASE WHEN deal_type = 'PAYG' AND paid_off = 'false' AND next_status_update IS NOT NULL
       AND coalesce(contract_status, '') NOT IN ('REPOSSESSED', 'CANCELLED')
      THEN CAST(greatest(0, date_diff('day', next_status_update, {D})) AS INT) END AS consecutive_locked_days
    FROM o_normal"""

G1_COLUMNS = f"""
    contract_number, entite, source, categorie, client_number, customer_name, agent_number, agent_name,
    {ts('paid_date')} AS paid_date, {ts('registration_date')} AS registration_date,
    {ts('last_status_update')} AS last_status_update, {ts('next_status_update')} AS next_status_update,
    {ts('paid_off_date')} AS paid_off_date, {ts('repossession_date')} AS repossession_date, product_name,
    asset_number, deal_type, {dbl('total_contract_value')} AS total_contract_value,
    {dbl('upfront_payment')} AS upfront_payment, {dbl('monthly_payment')} AS monthly_payment,
    {dbl('total_paid')} AS total_paid, {dbl('remaining_debt')} AS remaining_debt, contract_status, paid_off,
    region, sub_prefecture, village, consecutive_locked_days,
    '2001-08-31 00:00:00.000000' AS computed_at"""


@query("unified_contracts", f"SELECT {G1_COLUMNS} FROM g1")
def unified_contracts(t: Tables):
    return present(contracts(t))


@query("filter_view", f"SELECT {G1_COLUMNS} FROM g1 WHERE entite = 'E2'")
def filter_view(t: Tables):
    return present(co.entity_contracts(contracts(t), RULES.entity_other))


@query(
    "locked_days",
    """SELECT contract_number, deal_type, contract_status, paid_off, consecutive_locked_days FROM g1""",
)
def locked_days(t: Tables):
    return contracts(t).select(
        "contract_number", "deal_type", "contract_status", "paid_off", "consecutive_locked_days"
    )


SNAP = f"""
    contract_number, entite, source, categorie, contract_status, deal_type, paid_off,
    {dbl('total_contract_value')} AS total_contract_value, {dbl('total_paid')} AS total_paid,
    {dbl('remaining_debt')} AS remaining_debt, consecutive_locked_days, region"""


@query(
    "daily_snapshot",
    f"SELECT '2001-08-31' AS snapshot_date, {SNAP} FROM g1 WHERE contract_status NOT IN ('CANCELLED')",
)
def daily_snapshot(t: Tables):
    return present(sn.daily_snapshot(contracts(t), AS_OF))


@query(
    "aging_buckets",
    f"""SELECT '2001-08-31' AS report_date, entite, source, categorie,
     CASE WHEN contract_status = 'REPOSSESSED' THEN 'repossessed' WHEN paid_off = 'true' THEN 'paidoff'
      WHEN consecutive_locked_days IS NULL OR consecutive_locked_days = 0 THEN '0. pas_retard'
      WHEN consecutive_locked_days <= 30 THEN '1. PAR_1_30j' WHEN consecutive_locked_days <= 60 THEN '2. PAR_31_60j'
      WHEN consecutive_locked_days <= 90 THEN '3. PAR_61_90j' WHEN consecutive_locked_days <= 120 THEN '4. PAR_91_120j'
      ELSE 'writeoff' END AS par_bucket,
     count(*) AS nb_contrats, {eur('sum(total_contract_value)')} AS valeur_eur,
     {eur('sum(remaining_debt)')} AS receivables_eur,
     {part_of('sum(consecutive_locked_days)', 'count(consecutive_locked_days)', 1, 1.0)} AS cld_moyen
    FROM g1 WHERE contract_status <> 'CANCELLED' GROUP BY ALL""",
)
def aging_buckets(t: Tables):
    return present(portfolio.aging_buckets(contracts(t), AS_OF, RULES))


ORACLE_VIEWS["o_rate_base"] = f"""
    SELECT contract_number, customer_name, categorie, registration_date, total_contract_value,
     upfront_payment AS deposit, CAST(monthly_payment AS DOUBLE) / 30 AS daily_rate,
     total_contract_value - upfront_payment AS whole, contract_status AS status,
     CASE contract_status WHEN 'LOCKED' THEN date_diff('day', {D}, last_status_update)
       WHEN 'ENABLED' THEN date_diff('day', {D}, next_status_update) ELSE 0 END AS days_to_cutoff,
     greatest(date_diff('day', registration_date, {D}) - 30, 0) AS days_on_books,
     total_paid, greatest(total_paid - upfront_payment, 0) AS paid, remaining_debt
    FROM g1 WHERE categorie IN ('a_main', 'b_recent') AND contract_status IN ('ENABLED', 'LOCKED', 'PAID_OFF')
     AND registration_date IS NOT NULL AND monthly_payment > 0 AND total_contract_value > 0"""
ORACLE_VIEWS["o_rate"] = """
    SELECT *, CASE WHEN days_on_books > 0 AND status <> 'PAID_OFF'
       THEN greatest(CAST(paid AS DOUBLE) - greatest(days_to_cutoff, 0) * daily_rate, 0)
       ELSE CAST(paid AS DOUBLE) END AS paid_linearized,
     CASE WHEN days_on_books > 0 THEN least(days_on_books * daily_rate, CAST(whole AS DOUBLE)) ELSE 0 END AS expected,
     CASE WHEN status = 'LOCKED' THEN 0 ELSE remaining_debt END AS active_receivable
    FROM o_rate_base"""
ORACLE_VIEWS["o_pvp"] = f"""
    SELECT *, CASE WHEN expected > 0 THEN {part_of('paid_linearized', 'expected', 4, 1.0)} ELSE 1 END AS pvp
    FROM o_rate"""


@query(
    "linearized_repayment",
    f"""SELECT contract_number, customer_name, categorie, {txt('registration_date')} AS registration_date,
     30 AS deposit_free_days, {dbl('total_contract_value')} AS total_contract_value, {dbl('deposit')} AS deposit,
     {rnd('daily_rate', 4)} AS daily_rate, {dbl('whole')} AS total_without_deposit, status, days_to_cutoff,
     days_on_books, {dbl('total_paid')} AS cumulative_paid, {dbl('paid')} AS paid_without_deposit,
     {dbl('remaining_debt')} AS account_receivable,
     CAST(ceil(round(CAST(paid AS DOUBLE) * 10 / nullif(CAST(whole AS DOUBLE), 0), 8)) AS BIGINT) * 10 AS loan_paid_bin,
     {rnd('paid_linearized', 4)} AS paid_linearized, {rnd('expected', 4)} AS expected_to_date,
     {dbl('pvp')} AS pvp_linearized, {dbl('active_receivable')} AS active_receivable,
     {dbl('paid + active_receivable')} AS paid_plus_receivable, '2001-08-31' AS snapshot_date
    FROM o_pvp""",
)
def repayment(t: Tables):
    return present(
        linearized_repayment(contracts(t), AS_OF, RULES),
        {"daily_rate": 4, "paid_linearized": 4, "expected_to_date": 4},
    )


SCOPE = "(g.entite = 'E1' OR g.categorie = 'b_recent')"
ACTIVE = f"g.contract_status = 'ENABLED' AND {SCOPE} AND coalesce(g.consecutive_locked_days, 0) <= 120"


def _late(low: int, high: int) -> str:
    return (
        f"count(*) FILTER (WHERE g.consecutive_locked_days BETWEEN {low} AND {high} AND {SCOPE}) "
        f"AS nb_par_{low}_{high}j"
    )


@query(
    "portfolio_summary",
    f"""SELECT '2001-08-31' AS report_date, count(*) FILTER (WHERE {ACTIVE}) AS nb_contrats_actifs,
     count(*) FILTER (WHERE g.contract_status = 'LOCKED' AND {SCOPE}) AS nb_contrats_locked,
     count(*) FILTER (WHERE g.contract_status = 'REPOSSESSED' AND {SCOPE}) AS nb_repossedes,
     count(*) FILTER (WHERE g.paid_off = 'true' AND {SCOPE}) AS nb_paidoff,
     {eur(f'sum(g.total_contract_value) FILTER (WHERE {ACTIVE})')} AS valeur_portefeuille_eur,
     {eur(f'sum(g.remaining_debt) FILTER (WHERE {ACTIVE})')} AS receivables_eur,
     {eur(f'sum(g.total_paid) FILTER (WHERE {SCOPE})')} AS total_collected_eur,
     {rnd('''sum(CAST(p.pvp AS DECIMAL(28,4))) FILTER (WHERE p.pvp < 2 AND p.days_on_books > 0)
        / CAST(nullif(count(*) FILTER (WHERE p.pvp < 2 AND p.days_on_books > 0), 0) AS DOUBLE)''', 4)} AS pvp_moyen,
     count(*) FILTER (WHERE g.consecutive_locked_days = 0 AND g.contract_status = 'ENABLED' AND {SCOPE}) AS nb_cld_0,
     {_late(1, 30)}, {_late(31, 60)}, {_late(61, 90)}, {_late(91, 120)},
     count(*) FILTER (WHERE g.consecutive_locked_days > 120 AND {SCOPE}) AS nb_writeoff
    FROM g1 g LEFT JOIN o_pvp p ON p.contract_number = g.contract_number""",
)
def portfolio_summary(t: Tables):
    return present(portfolio.portfolio_summary(contracts(t), AS_OF, RULES))


@query(
    "activations_monthly",
    f"""SELECT {txt("date_trunc('month', registration_date)")} AS mois, entite, source, categorie, product_name,
     count(*) AS nb_activations, {eur('sum(total_contract_value)')} AS valeur_eur,
     {part_of('sum(monthly_payment)', 'count(monthly_payment)', 0, 1.0)} AS mensualite_moyenne,
     {part_of('sum(upfront_payment)', 'count(upfront_payment)', 0, 1.0)} AS upfront_moyen
    FROM g1 WHERE registration_date >= DATE '1996-01-01' AND contract_status <> 'CANCELLED' GROUP BY ALL""",
)
def activations_monthly(t: Tables):
    return present(portfolio.activations_monthly(contracts(t), RULES))


@query(
    "pending_installations",
    f"""SELECT contract_number, customer_name, entite, categorie, agent_name, region, sub_prefecture, product_name,
     {txt('paid_date')} AS date_vente, {txt('registration_date')} AS date_installation,
     date_diff('day', paid_date, {D}) AS jours_attente, {dbl('total_contract_value')} AS total_contract_value,
     {dbl('upfront_payment')} AS upfront_payment, contract_status
    FROM g1 WHERE categorie IN ('a_main', 'b_recent') AND paid_date IS NOT NULL AND registration_date IS NULL
     AND contract_status <> 'CANCELLED'""",
)
def pending(t: Tables):
    return present(portfolio.pending_installations(contracts(t), AS_OF, RULES))


# ---- payments and collection rates ------------------------------------------------

A_OK = "status = 'ACCEPTED' AND payment_code IS NOT NULL AND payment_code NOT IN ('REVERSED', 'SURVEY_SUCCESS')"
UP = "payment_code IN ('DOWNPAYMENT_SUCCESS', 'INCOMPLETE_DOWNPAYMENT')"
RE = "payment_code IN ('PAYMENT_SUCCESS', 'INCOMPLETE_PAYMENT', 'FINAL_PAYMENT')"

ORACLE_VIEWS["o_classified"] = f"""
    SELECT transaction_id, contract_number, payment_date, amount,
     CASE WHEN {UP} THEN 'upfront' ELSE 'recharge' END AS payment_class
    FROM a_payments WHERE {A_OK} AND ({UP} OR {RE})
    UNION ALL
    SELECT p.transaction_id, m.installation_id, p.paid_time, p.amount,
     if(row_number() OVER (PARTITION BY m.installation_id ORDER BY p.paid_time, p.transaction_id) = 1,
        'upfront', 'recharge')
    FROM b_payments p JOIN fx_asset_map m ON m.asset_number = p.account
    JOIN b_contracts c ON c.installation_id = m.installation_id
    WHERE p.payment_status <> 'REVERSED' AND c.paid_at >= DATE '1998-01-01'
     AND c.installation_id NOT IN (SELECT contract_number FROM fx_exclusions)"""


@query(
    "payment_classification",
    f"""SELECT transaction_id, contract_number, {ts('payment_date')} AS payment_date, {dbl('amount')} AS amount,
     payment_class FROM o_classified""",
)
def payment_classification(t: Tables):
    return present(
        pay.classified_payments(
            t.a_payments, t.b_payments, t.fx_asset_map, t.b_contracts, t.fx_exclusions, RULES
        )
    )


ORACLE_VIEWS["o_paid_fixed"] = f"""
    SELECT ms, sum(u) AS paid_upfront, sum(r) AS paid_recharge, sum(c) AS paid_cash_sales FROM (
      SELECT date_trunc('month', p.payment_date) AS ms, CASE WHEN {A_OK} AND {UP} THEN amount ELSE 0 END AS u,
       CASE WHEN {A_OK} AND {RE} THEN amount ELSE 0 END AS r, CASE WHEN g.deal_type = 'FULL' THEN amount ELSE 0 END AS c
      FROM a_payments p JOIN g1 g USING (contract_number) WHERE p.status = 'ACCEPTED' AND {SCOPE}
      UNION ALL
      SELECT date_trunc('month', p.paid_time), 0, amount, 0 FROM b_payments p
      JOIN fx_asset_map m ON m.asset_number = p.account JOIN g1 g ON g.contract_number = m.installation_id
      WHERE p.payment_status <> 'REVERSED' AND g.categorie = 'b_recent')
    GROUP BY ms"""
ORACLE_VIEWS["o_due_fixed"] = f"""
    SELECT ms, sum(CASE WHEN deal_type <> 'FULL' AND fresh THEN up ELSE 0 END) AS expected_upfront,
     sum(CASE WHEN deal_type <> 'FULL' AND NOT fresh THEN mo ELSE 0 END) AS expected_recharge,
     sum(CASE WHEN deal_type = 'FULL' AND fresh THEN mo ELSE 0 END) AS expected_cash_sales
    FROM (
      SELECT m.ms, g.deal_type, date_trunc('month', g.registration_date) = m.ms AS fresh,
       coalesce(g.upfront_payment, 0) AS up, coalesce(g.monthly_payment, 0) AS mo,
       row_number() OVER (PARTITION BY m.me, s.contract_number ORDER BY s.snapshot_date DESC) AS pos
      FROM {COLLECT} m JOIN snapshots s ON s.snapshot_date BETWEEN m.ms - INTERVAL 45 DAY AND m.me
      JOIN g1 g ON g.contract_number = s.contract_number
      WHERE s.categorie IN ('a_main', 'b_recent')
       AND coalesce(s.contract_status, '') NOT IN ('REPOSSESSED', 'CANCELLED')
       AND g.registration_date <= m.me AND {SCOPE}
       AND (g.paid_off_date IS NULL OR g.paid_off_date > m.me) AND coalesce(s.consecutive_locked_days, 0) <= 120)
    WHERE pos = 1 GROUP BY ms"""


@query(
    "paid_monthly_union",
    f"""SELECT {txt('ms')} AS month_start, {dbl('paid_upfront')} AS paid_upfront, {dbl('paid_recharge')} AS paid_recharge,
     {dbl('paid_cash_sales')} AS paid_cash_sales FROM o_paid_fixed
     WHERE ms BETWEEN DATE '2000-09-01' AND DATE '2001-08-31'""",
)
def paid_monthly(t: Tables):
    return present(
        collection.paid_monthly_fixed(
            t.a_payments, t.b_payments, t.fx_asset_map, contracts(t), RULES.collection_start,
            COLLECTION_LAST, RULES,
        )
    )


@query(
    "expected_monthly",
    f"""SELECT {txt('ms')} AS month_start, {dbl('expected_upfront')} AS expected_upfront,
     {dbl('expected_recharge')} AS expected_recharge, {dbl('expected_cash_sales')} AS expected_cash_sales
     FROM o_due_fixed""",
)
def expected_monthly(t: Tables):
    return present(
        collection.expected_monthly_fixed(
            t.snapshots, contracts(t), RULES.collection_start, COLLECTION_LAST, RULES
        )
    )


def _rate_sql(paid: list[str], expected: list[str], paid_view: str, due_view: str) -> str:
    def total(names):
        return "(" + " + ".join(f"coalesce({n}, 0)" for n in names) + ")"

    parts = [f"{rnd(f'coalesce({n}, 0)', 0)} AS {n}_fcfa" for n in [*paid, *expected]]
    return f"""
    SELECT {txt('m.ms')} AS month_start, {txt('m.me')} AS month_end, strftime(m.ms, '%Y-%m') AS month_year,
     {', '.join(parts)}, {rnd(total(paid), 0)} AS paid_total_fcfa, {rnd(total(expected), 0)} AS expected_total_fcfa,
     {part_of(total(paid), total(expected), 2)} AS collection_rate_pct
    FROM {COLLECT} m LEFT JOIN {paid_view} p ON p.ms = m.ms LEFT JOIN {due_view} e ON e.ms = m.ms"""


FIXED = _rate_sql(
    ["paid_upfront", "paid_recharge", "paid_cash_sales"],
    ["expected_upfront", "expected_recharge", "expected_cash_sales"], "o_paid_fixed", "o_due_fixed",
)


def fixed_rate(t: Tables, unified):
    return collection.collection_rate_fixed(
        t.spark, t.a_payments, t.b_payments, t.fx_asset_map, t.snapshots, unified, COLLECTION_LAST, RULES
    )


@query("collection_rate_fixed", FIXED)
def collection_rate_fixed(t: Tables):
    return present(fixed_rate(t, contracts(t)))


# Every asset is stocked, and most are deployed, some twice and some without a date.
VIEWS["asset_log"] = """
    SELECT payg_number, 'STOCKED' AS event_type, date_added AS event_date FROM a_assets
    UNION ALL SELECT payg_number, 'DEPLOYED', deploy_date FROM a_assets WHERE status = 'DEPLOYED' OR deploy_date IS NULL
    UNION ALL SELECT payg_number, 'DEPLOYED', date_added + INTERVAL 20 DAY FROM a_assets WHERE serial_number LIKE '%1'"""


@query(
    "deploy_reference_events",
    f"""SELECT a.contract_number, {txt('min(e.event_date)')} AS deploy_date FROM a_assets a JOIN asset_log e USING (payg_number)
    WHERE e.event_type = 'DEPLOYED' AND e.event_date IS NOT NULL GROUP BY 1""",
)
def deploy_reference_events(t: Tables):
    return present(co.deploy_reference(t.asset_log, t.a_assets))


@query("collection_rate_laid_out", FIXED)
def collection_rate_laid_out(t: Tables):
    """The fixed rate over tables laid out once by contract or account, which join and group without being shuffled.

    All rows are laid out, with the columns that the rate reads.
    """
    buckets = layout.buckets_for(t.lineitem.count())
    tables = {
        "a_payments": t.a_payments, "b_payments": t.b_payments, "asset_map": t.fx_asset_map, "snapshots": t.snapshots,
        "contracts": contracts(t),
    }
    laid = {name: layout.laid_out(tables[name].select(*columns), columns[0], buckets) for name, columns in collection.FIXED_READS.items()}
    return present(collection.collection_rate_fixed(t.spark, **laid, last_day=COLLECTION_LAST, rules=RULES))


ORACLE_VIEWS["o_paid_free"] = """
    SELECT date_trunc('month', p.payment_date) AS ms,
     sum(CASE WHEN g.deal_type <> 'FULL' AND payment_class = 'upfront' THEN amount ELSE 0 END) AS paid_upfront,
     sum(CASE WHEN g.deal_type <> 'FULL' AND payment_class = 'recharge' THEN amount ELSE 0 END) AS paid_recharge,
     sum(CASE WHEN g.deal_type = 'FULL' THEN amount ELSE 0 END) AS paid_full
    FROM o_classified p JOIN g1 g USING (contract_number) WHERE g.categorie IN ('a_main', 'b_recent') GROUP BY 1"""
def _due_free(free_days: int) -> str:
    return f"""
    SELECT ms, sum(CASE WHEN deal_type = 'FULL' AND date_trunc('month', registration_date) = ms THEN value ELSE 0 END)
      AS expected_full,
     sum(CASE WHEN deal_type <> 'FULL' AND date_trunc('month', registration_date) = ms THEN up ELSE 0 END)
      AS expected_upfront,
     sum(CASE WHEN deal_type <> 'FULL' AND registration_date + {free_days} >= me THEN 0
              WHEN paid_off = 'true' AND paid_date < ms THEN 0
              ELSE greatest(0, date_diff('day', greatest(ms, registration_date + {free_days}), me) + 1)
                   * CAST(mo AS DECIMAL(38,10)) END) / 30.0 AS expected_recharge
    FROM (
      SELECT m.ms, m.me, s.deal_type, s.paid_off, coalesce(s.total_contract_value, 0) AS value,
       coalesce(s.consecutive_locked_days, 0) AS cld, g.registration_date, g.paid_date,
       coalesce(g.upfront_payment, 0) AS up, coalesce(g.monthly_payment, 0) AS mo,
       row_number() OVER (PARTITION BY m.me, s.contract_number ORDER BY s.snapshot_date DESC) AS pos
      FROM {COLLECT} m JOIN snapshots s ON s.snapshot_date <= m.me
      JOIN g1 g ON g.contract_number = s.contract_number
      WHERE s.categorie IN ('a_main', 'b_recent')
       AND coalesce(s.contract_status, '') NOT IN ('REPOSSESSED', 'CANCELLED'))
    WHERE pos = 1 AND cld <= 60 AND registration_date <= me GROUP BY ms"""


ORACLE_VIEWS["o_due_free"] = _due_free(30)
ORACLE_VIEWS["o_due_free_60"] = _due_free(60)


@query(
    "collection_rate_freeperiod",
    _rate_sql(
        ["paid_upfront", "paid_recharge", "paid_full"],
        ["expected_upfront", "expected_recharge", "expected_full"], "o_paid_free", "o_due_free",
    ),
)
def collection_rate_freeperiod(t: Tables):
    return present(
        collection.collection_rate_free_period(
            t.spark, t.a_payments, t.b_payments, t.fx_asset_map, t.b_contracts, t.fx_exclusions,
            t.snapshots, contracts(t), COLLECTION_LAST, RULES,
        )
    )


@query(
    "collection_rate_free_60",
    _rate_sql(
        ["paid_upfront", "paid_recharge", "paid_full"],
        ["expected_upfront", "expected_recharge", "expected_full"], "o_paid_free", "o_due_free_60",
    ),
)
def collection_rate_free_60(t: Tables):
    """Another free period: an instalment still stands for 30 days."""
    return present(
        collection.collection_rate_free_period(
            t.spark, t.a_payments, t.b_payments, t.fx_asset_map, t.b_contracts, t.fx_exclusions,
            t.snapshots, contracts(t), COLLECTION_LAST, replace(RULES, free_days=60),
        )
    )


# ---- month-end tables and report --------------------------------------------------


def _newest(source: str, grace: int, extra: str = "", columns: str = "") -> str:
    return f"""
      SELECT * FROM (SELECT m.ms, m.me, s.*{columns},
        row_number() OVER (PARTITION BY m.me, s.contract_number ORDER BY s.snapshot_date DESC) AS pos
       FROM {REPORT} m JOIN snapshots s ON s.snapshot_date <= m.me + INTERVAL {grace} DAY
        AND s.snapshot_date >= m.ms - INTERVAL 45 DAY {extra}
       WHERE s.source = '{source}' AND s.categorie IN ('a_main', 'b_recent')
        AND coalesce(s.contract_status, '') <> 'CANCELLED') WHERE pos = 1"""


ORACLE_VIEWS["o_end_a"] = _newest(
    "A", 0, "JOIN deploy_reference f ON f.contract_number = s.contract_number AND f.deploy_date <= m.me"
)
ORACLE_VIEWS["o_end_b"] = _newest("B", 3)


def month_table(select_cld: str, status: str, paid: str) -> str:
    return f"""
     {txt('s.me')} AS month_end, s.contract_number, s.source, s.categorie, {select_cld} AS snap_cld,
     {status} AS contract_status, {dbl('s.total_contract_value')} AS total_contract_value,
     {dbl(f'coalesce({paid}, s.total_paid)')} AS total_paid, s.paid_off, {txt('s.snapshot_date')} AS snapshot_date"""


MONTH_A_STATUS = """CASE WHEN CAST(c.repossession_date AS DATE) <= s.me THEN 'REPOSSESSED'
      WHEN CAST(c.paid_off_date AS DATE) <= s.me THEN 'PAIDOFF' WHEN c.status = 'CANCELLED' THEN 'CANCELLED'
      ELSE s.contract_status END"""
MONTH_B_STATUS = """CASE WHEN c.removed_at <= s.me OR c.status = 'Disabled' THEN 'REPOSSESSED'
      WHEN c.status IN ('Active', 'Awaiting Removal') THEN 'ENABLED' ELSE s.contract_status END"""


MONTH_A_SQL = f"""SELECT {month_table('s.consecutive_locked_days', MONTH_A_STATUS, 'p.total')}
    FROM o_end_a s JOIN a_contracts c ON c.contract_number = s.contract_number
    LEFT JOIN (SELECT contract_number, sum(amount) AS total FROM a_payments WHERE {A_OK} GROUP BY 1) p
      ON p.contract_number = s.contract_number"""


@query("month_snapshot_a", MONTH_A_SQL)
def month_snapshot_a(t: Tables):
    return present(
        sn.month_snapshot_a(
            t.snapshots, t.deploy_reference, t.a_contracts, t.a_payments, FIRST_MONTH, LAST_MONTH, RULES
        )
    )


ORACLE_VIEWS["o_running"] = """
    SELECT m.installation_id AS contract_number, date_trunc('month', p.paid_time) AS ms,
     sum(sum(p.amount)) OVER (PARTITION BY m.installation_id ORDER BY date_trunc('month', p.paid_time)) AS total
    FROM b_payments p JOIN fx_asset_map m ON m.asset_number = p.account
    WHERE p.payment_status <> 'REVERSED' GROUP BY 1, 2"""
ORACLE_VIEWS["o_unlocked"] = f"""
    SELECT * FROM (SELECT m.me, h.contract_number, h.unlocked_until,
      row_number() OVER (PARTITION BY m.me, h.contract_number ORDER BY h.transaction_date DESC) AS pos
     FROM {REPORT} m JOIN unlock_history h ON h.transaction_date <= m.me AND h.source = 'B') WHERE pos = 1"""


MONTH_B_SQL = f"""SELECT {month_table(
        "CAST(greatest(0, date_diff('day', coalesce(h.unlocked_until, c.unlocked_until), s.me)) AS INT)",
        MONTH_B_STATUS, 'r.total')}
    FROM o_end_b s JOIN b_contracts c ON c.installation_id = s.contract_number
    LEFT JOIN o_unlocked h ON h.contract_number = s.contract_number AND h.me = s.me
    LEFT JOIN o_running r ON r.contract_number = s.contract_number AND r.ms = s.ms"""


@query("month_snapshot_b", MONTH_B_SQL)
def month_snapshot_b(t: Tables):
    return present(
        sn.month_snapshot_b(
            t.snapshots, t.b_contracts, t.unlock_history, t.b_payments, t.fx_asset_map,
            FIRST_MONTH, LAST_MONTH, RULES,
        )
    )


@query(
    "month_table_reload",
    f"{MONTH_A_SQL} UNION ALL {MONTH_B_SQL}",
)
def month_table_reload(t: Tables):
    """Both sides in one write, twice: the second load replaces the first."""
    path, sides = scratch_path(t.spark, "months"), scratch_path(t.spark, "sides")
    a = sn.month_snapshot_a(t.snapshots, t.deploy_reference, t.a_contracts, t.a_payments, FIRST_MONTH, LAST_MONTH, RULES)
    b = sn.month_snapshot_b(
        t.snapshots, t.b_contracts, t.unlock_history, t.b_payments, t.fx_asset_map, FIRST_MONTH, LAST_MONTH, RULES
    )
    # Both sides are worked out once and stored for the two loads.
    a.write.parquet(f"{sides}/a")
    b.write.parquet(f"{sides}/b")
    for _ in range(2):
        sn.reload_months(t.spark.read.parquet(f"{sides}/a"), t.spark.read.parquet(f"{sides}/b"), path)
    return present(t.spark.read.parquet(path))


LIVE = "bucket NOT IN ('repossessed', 'paidoff', 'hors_portefeuille')"
BUCKETS = {
    "pas_retard": "a. pas_de_retard", "1_30j": "b. 1_30j", "31_60j": "c. 31_60j", "61_90j": "d. 61_90j",
    "91_120j": "e. 91_120j",
}
_COUNTS = ", ".join(f"count(*) FILTER (WHERE bucket = '{b}') AS nb_{n}" for n, b in BUCKETS.items())
_RECS = ", ".join(
    f"{eur(f'''sum(receivables) FILTER (WHERE bucket = '{b}')''')} AS rec_{n}_eur" for n, b in BUCKETS.items()
)

ORACLE_VIEWS["o_rates"] = FIXED
ORACLE_VIEWS["o_report_rows"] = """
    SELECT s.ms, s.me, g.repossession_date, coalesce(s.consecutive_locked_days, 0) AS cld, s.total_contract_value,
     greatest(0, coalesce(s.total_contract_value, 0) - coalesce(s.total_paid, 0)) AS receivables,
     CASE WHEN s.contract_status = 'REPOSSESSED' THEN 'repossessed' WHEN g.paid_off_date <= s.me THEN 'paidoff'
      WHEN s.consecutive_locked_days > 120 THEN 'hors_portefeuille' WHEN s.consecutive_locked_days > 90 THEN 'e. 91_120j'
      WHEN s.consecutive_locked_days > 60 THEN 'd. 61_90j' WHEN s.consecutive_locked_days > 30 THEN 'c. 31_60j'
      WHEN s.consecutive_locked_days > 0 THEN 'b. 1_30j' ELSE 'a. pas_de_retard' END AS bucket
    FROM (SELECT ms, me, contract_number, consecutive_locked_days, contract_status, total_contract_value, total_paid
          FROM o_end_a UNION ALL
          SELECT ms, me, contract_number, consecutive_locked_days, contract_status, total_contract_value, total_paid
          FROM o_end_b) s JOIN g1 g ON g.contract_number = s.contract_number"""
ORACLE_VIEWS["o_report"] = f"""
    SELECT me, count(*) FILTER (WHERE {LIVE}) AS nb_contrats,
     {eur(f'sum(total_contract_value) FILTER (WHERE {LIVE})')} AS valeur_portefeuille_eur,
     {eur(f'sum(receivables) FILTER (WHERE {LIVE})')} AS receivables_eur,
     count(*) FILTER (WHERE cld < 60 AND {LIVE}) AS nb_clients_actifs, {_COUNTS},
     count(*) FILTER (WHERE bucket = 'hors_portefeuille') AS nb_hors_portefeuille,
     count(*) FILTER (WHERE bucket = 'repossessed') AS nb_repossessed, {_RECS},
     {eur("sum(receivables) FILTER (WHERE bucket = 'hors_portefeuille')")} AS rec_writeoff_eur,
     count(*) FILTER (WHERE cld BETWEEN 60 AND 90 AND {LIVE}) AS nb_new_default,
     count(*) FILTER (WHERE repossession_date BETWEEN ms AND me) AS nb_new_repossessions,
     count(*) FILTER (WHERE cld > 90 AND {LIVE}) AS nb_default_90j_plus
    FROM o_report_rows GROUP BY me"""


def _report_sql() -> str:
    return f"""
    SELECT r.* EXCLUDE (me), {txt('r.me')} AS month_end, strftime(r.me, '%Y-%m') AS month_year, c.paid_total_fcfa,
     c.expected_total_fcfa, c.collection_rate_pct,
     {part_of('nb_new_default', 'nb_contrats', 2)} AS new_default_rate_pct,
     {part_of('nb_new_repossessions', 'nb_default_90j_plus', 2)} AS repossession_rate_pct
    FROM o_report r LEFT JOIN o_rates c ON c.month_end = CAST(r.me AS VARCHAR)"""


@query("monthly_report", _report_sql())
def monthly_report(t: Tables):
    # The report reads the contract table twice; store it once, as the daily job does.
    path = scratch_path(t.spark, "contracts")
    contracts(t).write.parquet(path)
    unified = t.spark.read.parquet(path)
    return present(
        report.monthly_report(
            t.snapshots, t.deploy_reference, unified, fixed_rate(t, unified), FIRST_MONTH, LAST_MONTH, RULES
        )
    )


@query(
    "historical_rebuild",
    f"""WITH ends AS (SELECT me FROM {HISTORY}
      WHERE me NOT IN (SELECT snapshot_date FROM snapshots WHERE snapshot_date IS NOT NULL)),
     led AS (SELECT * FROM (SELECT e.me, l.*, row_number() OVER (PARTITION BY e.me, l.installation_id
        ORDER BY l.posting_date DESC) AS pos FROM ends e JOIN b_ledger l ON l.posting_date <= e.me) WHERE pos = 1)
    SELECT {txt('e.me')} AS snapshot_date, c.installation_id AS contract_number, 'B' AS entite, 'B' AS source,
     CASE WHEN x.contract_number IS NOT NULL THEN 'b_excluded' WHEN c.paid_at >= DATE '1998-01-01' THEN 'b_recent'
       ELSE 'b_old' END AS categorie, c.status AS contract_status, coalesce(p.deal_type, 'PAYG') AS deal_type,
     'false' AS paid_off, {dbl('p.total_contract_value')} AS total_contract_value,
     {dbl('coalesce(l.total_cash_collected, 0)')} AS total_paid,
     {dbl('coalesce(l.ending_principal, p.total_contract_value)')} AS remaining_debt,
     CAST(NULL AS INT) AS consecutive_locked_days, c.region
    FROM ends e CROSS JOIN b_contracts c LEFT JOIN fx_exclusions x ON x.contract_number = c.installation_id
    LEFT JOIN b_products p USING (installation_id)
    LEFT JOIN led l ON l.installation_id = c.installation_id AND l.me = e.me WHERE c.activated_at IS NOT NULL
    UNION ALL
    SELECT {txt('e.me')}, c.contract_number, c.entity_name, 'A', 'a_main', upper(trim(c.status)),
     coalesce(c.deal_type, 'PAYG'), if(c.paid_off_status = 'Yes', 'true', 'false'), {dbl('c.total_cost')},
     {dbl('c.total_paid')}, {dbl('c.remaining_debt')}, NULL, c.region
    FROM ends e JOIN a_contracts c ON CAST(c.signing_date AS DATE) <= e.me""",
)
def historical_rebuild(t: Tables):
    return present(
        sn.historical_rebuild(
            t.a_contracts, t.b_contracts, t.b_ledger, t.b_products, t.fx_exclusions,
            HISTORY_FIRST, HISTORY_LAST, RULES, existing=t.snapshots,
        )
    )


@query(
    "snapshot_stats",
    f"""SELECT categorie, contract_status, count(*) AS nb, {rnd('CAST(sum(total_contract_value) AS DOUBLE) / 1e9', 2)} AS valeur_mrd,
     {rnd('CAST(sum(total_paid) AS DOUBLE) / 1e9', 2)} AS paid_mrd,
     {part_of('sum(total_paid)', 'sum(total_contract_value)', 1)} AS cr
    FROM snapshots WHERE snapshot_date = DATE '2001-05-15' GROUP BY 1, 2""",
)
def snapshot_stats(t: Tables):
    return present(portfolio.snapshot_stats(t.snapshots, "2001-05-15"))


@query(
    "snapshot_listing",
    f"""SELECT {txt('snapshot_date')} AS snapshot_date, contrats, paid_mrd, {ts('run_at')} AS run_at FROM (
      SELECT s.snapshot_date, a.run_at, count(*) AS contrats,
       {rnd('CAST(sum(s.total_paid) AS DOUBLE) / 1e9', 2)} AS paid_mrd
      FROM snapshots s JOIN (SELECT DISTINCT snapshot_date, CAST(snapshot_date AS TIMESTAMP) AS run_at FROM snapshots) a
       USING (snapshot_date) GROUP BY 1, 2)
    ORDER BY snapshot_date DESC, run_at DESC LIMIT 10""",
)
def snapshot_listing(t: Tables):
    audit = t.snapshots.select(
        "snapshot_date", F.col("snapshot_date").cast("timestamp").alias("run_at")
    ).distinct()
    return present(portfolio.snapshot_listing(t.snapshots, audit))


@query(
    "calendar_spine",
    f"""SELECT {txt('m.ms')} AS month_start, {txt('m.me')} AS month_end, strftime(m.ms, '%Y-%m') AS month_year,
     coalesce(n, 0) AS n_payments FROM {months('1994-11-15', '2002-02-14').replace('CAST(d AS DATE) AS ms', "CAST(date_trunc('month', d) AS DATE) AS ms")} m
     LEFT JOIN (SELECT date_trunc('month', payment_date) AS ms, count(*) AS n FROM fx_payments GROUP BY 1) p
     ON p.ms = m.ms""",
)
def calendar_spine(t: Tables):
    paid = t.fx_payments.groupBy(F.trunc("payment_date", "MM").alias("month_start")).agg(
        F.count(F.lit(1)).alias("n")
    )
    spine = calendar(t.spark, "1994-11-15", "2002-01-14")
    return present(
        spine.join(paid, "month_start", "left").select(
            "month_start", "month_end", F.date_format("month_start", "yyyy-MM").alias("month_year"),
            F.coalesce("n", F.lit(0)).alias("n_payments"),
        )
    )


@query(
    "replace_slice",
    f"""SELECT {txt('snapshot_date')} AS snapshot_date, contract_number,
     {dbl("CASE WHEN snapshot_date = DATE '2001-05-15' THEN 2 * total_paid ELSE total_paid END")} AS total_paid
    FROM snapshots""",
)
def replace_slice(t: Tables):
    path = scratch_path(t.spark, "slices")
    rows = t.snapshots.select("snapshot_date", "contract_number", "total_paid")
    slices.append_slices(rows, path, "snapshot_date")
    again = rows.withColumn("total_paid", (F.col("total_paid") * 2).cast("decimal(18,2)"))
    for _ in range(2):  # a rerun changes nothing
        slices.replace_slice(again, path, "snapshot_date", "2001-05-15")
    return present(t.spark.read.parquet(path).select("snapshot_date", "contract_number", "total_paid"))


@query(
    "missing_slices",
    f"""SELECT {txt('m.ms')} AS month_start, {txt('m.me')} AS month_end FROM {months('1990-01-01', '2005-12-01')} m
     WHERE m.me NOT IN (SELECT snapshot_date FROM snapshots)""",
)
def missing_slices(t: Tables):
    spine = calendar(t.spark, "1990-01-01", "2005-12-01")
    return present(slices.missing_slices(spine, "month_end", t.snapshots, "snapshot_date"))
