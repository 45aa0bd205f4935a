"""Collection rates: money paid in a month over money expected in it.

Both models follow one plan.  Payments collapse to (contract, month), due contracts
come from the as-of snapshots as (contract, month); the two are stacked and meet the
contract table in ONE join, after which every measure is a conditional sum per month.
The contract table is therefore read and shuffled once, however many measures there are.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearium.functions.amounts import ratio, sum_or_zero, zero_if_null
from arrearium.functions.dates import as_date, calendar, month_label, month_start
from arrearium.operators.asof import asof_month_ends
from arrearium.plans.payments import a_paid_by_month, b_paid_by_month, recent_installations
from arrearium.rules import PortfolioRules

# An instalment is quoted for so many days, whatever the free period.
MONTH_DAYS = 30

# One shape for every fact before the contract join; a fact fills what it has.
FACTS = {
    "upfront": "decimal(38,2)",
    "recharge": "decimal(38,2)",
    "accepted": "decimal(38,2)",
    "counted": "decimal(38,2)",
    "cld": "int",
    "snap_deal": "string",
    "snap_value": "decimal(38,2)",
    "snap_paid_off": "string",
}


#: Columns that the fixed-instalment rate reads, the key of each table first.
FIXED_READS = {
    "a_payments": ["contract_number", "payment_date", "amount", "status", "payment_code"],
    "b_payments": ["account", "paid_time", "transaction_id", "amount", "payment_status"],
    "asset_map": ["asset_number", "installation_id"],
    "snapshots": ["contract_number", "snapshot_date", "categorie", "contract_status", "consecutive_locked_days"],
    "contracts": [
        "contract_number", "entite", "categorie", "deal_type", "paid_date", "paid_off_date", "registration_date",
        "upfront_payment", "monthly_payment",
    ],
}


def _facts(df: DataFrame, kind: str, **cols: Column) -> DataFrame:
    filled = [cols.get(name, F.lit(None)).cast(to).alias(name) for name, to in FACTS.items()]
    return df.select(F.lit(kind).alias("kind"), "contract_number", "month_start", *filled)


def _in_months(df: DataFrame, on: str, first: date | str, last: date | str) -> DataFrame:
    """Keep rows dated within the months first..last (a pushable range filter)."""
    lo = month_start(as_date(first))
    hi = F.add_months(month_start(as_date(last)), 1)
    return df.filter((F.col(on) >= lo) & (F.col(on) < hi))


def _with_contracts(facts: DataFrame, contracts: DataFrame) -> DataFrame:
    c = contracts.select(
        F.col("contract_number").alias("_c"), "entite", "categorie", "deal_type", "paid_date",
        "paid_off_date",
        F.col("registration_date").alias("registered_at"),
        zero_if_null(F.col("upfront_payment")).alias("due_upfront"),
        zero_if_null(F.col("monthly_payment")).alias("due_monthly"),
    )
    return facts.join(c, F.col("contract_number") == F.col("_c"), "inner").drop("_c")


def _live_snapshots(snapshots: DataFrame, rules: PortfolioRules) -> DataFrame:
    status = F.col("contract_status")
    return snapshots.filter(
        F.col("categorie").isin(*rules.core_categories)
        & (status.isNull() | ~status.isin("REPOSSESSED", "CANCELLED"))
    )


# ---- fixed-instalment model ------------------------------------------------------


def _paid_facts_fixed(a_payments, b_payments, asset_map, first, last) -> DataFrame:
    a = a_paid_by_month(_in_months(a_payments, "payment_date", first, last))
    b = b_paid_by_month(_in_months(b_payments, "paid_time", first, last), asset_map)
    return _facts(
        a, "a",
        upfront=F.col("upfront"), recharge=F.col("recharge"), accepted=F.col("accepted"),
        counted=zero_if_null(F.col("upfront")) + zero_if_null(F.col("recharge")),
    ).unionByName(_facts(b, "b", recharge=F.col("amount")))


def _due_facts_fixed(snapshots, first, last, rules: PortfolioRules, cld_max: int) -> DataFrame:
    cld = F.coalesce("consecutive_locked_days", F.lit(0))
    rows = _live_snapshots(snapshots, rules).select(
        "contract_number", "snapshot_date", cld.alias("cld")
    )
    due = asof_month_ends(
        rows.filter(F.col("cld") <= cld_max), "contract_number", "snapshot_date",
        first, last, lookback_days=rules.lookback_days,
    )
    return _facts(due, "due", cld=F.col("cld"))


def _fixed_measures(rules: PortfolioRules, strict: bool) -> dict[str, Column]:
    kind, deal = F.col("kind"), F.col("deal_type")
    in_scope = (F.col("entite") == rules.entity_main) | (F.col("categorie") == rules.category_b_recent)
    from_a = (kind == "a") & in_scope
    from_b = (kind == "b") & (F.col("categorie") == rules.category_b_recent)
    by_code = from_a & (deal != "FULL") if strict else from_a
    cash = F.col("counted") if strict else F.col("accepted")

    last_day = F.last_day("month_start")
    due = (
        (kind == "due")
        & in_scope
        & (F.col("registered_at") <= last_day)
        & (F.col("paid_off_date").isNull() | (F.col("paid_off_date") > last_day))
    )
    starts = month_start(F.col("registered_at").cast("date")) == F.col("month_start")
    return {
        "paid_upfront": sum_or_zero(by_code & F.col("upfront").isNotNull(), F.col("upfront")),
        "paid_recharge": sum_or_zero((by_code | from_b) & F.col("recharge").isNotNull(), F.col("recharge")),
        "paid_cash_sales": sum_or_zero(from_a & (deal == "FULL"), cash),
        "expected_upfront": sum_or_zero(due & (deal != "FULL") & starts, F.col("due_upfront")),
        "expected_recharge": sum_or_zero(due & (deal != "FULL") & ~starts, F.col("due_monthly")),
        "expected_cash_sales": sum_or_zero(due & (deal == "FULL") & starts, F.col("due_monthly")),
    }


def _by_month(facts: DataFrame, measures: dict[str, Column], names: list[str]) -> DataFrame:
    return facts.groupBy("month_start").agg(*[measures[n].alias(n) for n in names])


def paid_monthly_fixed(
    a_payments, b_payments, asset_map, contracts, first, last, rules: PortfolioRules, strict: bool = False
) -> DataFrame:
    """Paid amounts per month: upfront, recharge and cash sales.

    By default a cash sale also counts by its code, as the established report does;
    ``strict`` counts every payment once and only codes that mean money received.
    """
    facts = _with_contracts(_paid_facts_fixed(a_payments, b_payments, asset_map, first, last), contracts)
    in_scope = (F.col("entite") == rules.entity_main) | (F.col("categorie") == rules.category_b_recent)
    return _by_month(
        facts.filter(in_scope), _fixed_measures(rules, strict),
        ["paid_upfront", "paid_recharge", "paid_cash_sales"],
    )


def expected_monthly_fixed(
    snapshots, contracts, first, last, rules: PortfolioRules, cld_max: int | None = None
) -> DataFrame:
    """Expected amounts per month over contracts at most ``cld_max`` days late."""
    limit = rules.write_off_days if cld_max is None else cld_max
    facts = _with_contracts(_due_facts_fixed(snapshots, first, last, rules, limit), contracts)
    return _by_month(
        facts, _fixed_measures(rules, False),
        ["expected_upfront", "expected_recharge", "expected_cash_sales"],
    )


def collection_rate_fixed(
    spark: SparkSession,
    a_payments: DataFrame,
    b_payments: DataFrame,
    asset_map: DataFrame,
    snapshots: DataFrame,
    contracts: DataFrame,
    last_day: date | str,
    rules: PortfolioRules,
    first_day: date | str | None = None,
    cld_max: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """Collection rate with the full instalment expected every month after activation."""
    first = rules.collection_start if first_day is None else first_day
    limit = rules.write_off_days if cld_max is None else cld_max
    facts = _paid_facts_fixed(a_payments, b_payments, asset_map, first, last_day).unionByName(
        _due_facts_fixed(snapshots, first, last_day, rules, limit)
    )
    sums = _by_month(
        _with_contracts(facts, contracts), measures := _fixed_measures(rules, strict), list(measures)
    )
    return _report(
        calendar(spark, first, last_day), sums,
        ["paid_upfront", "paid_recharge", "paid_cash_sales"],
        ["expected_upfront", "expected_recharge", "expected_cash_sales"],
    )


# ---- free-period model -----------------------------------------------------------


def _free_period_measures(
    rules: PortfolioRules, paid_off_source: str, full_has_recharge: bool
) -> dict[str, Column]:
    kind = F.col("kind")
    # What was due depends on the deal as the snapshot had it, what was paid on today's.
    deal = F.when(kind == "due", F.col("snap_deal")).otherwise(F.col("deal_type"))
    core = F.col("categorie").isin(*rules.core_categories)
    paid = kind.isin("a", "b") & core
    m = F.col("month_start")
    last_day = F.last_day(m)
    registered = F.col("registered_at")
    # Activation later on the last day counts for the next month, as dates compare
    # with timestamps at midnight.
    due = (kind == "due") & (registered <= last_day)
    starts = month_start(registered.cast("date")) == m
    free_until = F.date_add(registered.cast("date"), rules.free_days)
    days = F.greatest(F.lit(0), F.datediff(last_day, F.greatest(m, free_until)) + 1)
    recharge_due = (F.col("due_monthly") * days).cast("decimal(38,6)") / F.lit(MONTH_DAYS)
    settled = (F.col("snap_paid_off") == "true") & (F.col(paid_off_source) < m)
    free = (deal != "FULL") & (free_until >= last_day)
    owes = ~F.coalesce(free | settled, F.lit(False))
    if not full_has_recharge:
        owes = owes & (deal != "FULL")
    value = zero_if_null(F.col("snap_value"))
    both = zero_if_null(F.col("upfront")) + zero_if_null(F.col("recharge"))
    return {
        "paid_upfront": sum_or_zero(paid & (deal != "FULL") & F.col("upfront").isNotNull(), F.col("upfront")),
        "paid_recharge": sum_or_zero(
            paid & (deal != "FULL") & F.col("recharge").isNotNull(), F.col("recharge")
        ),
        "paid_full": sum_or_zero(paid & (deal == "FULL"), both),
        "expected_upfront": sum_or_zero(due & (deal != "FULL") & starts, F.col("due_upfront")),
        "expected_recharge": sum_or_zero(due & owes, recharge_due),
        "expected_full": sum_or_zero(due & (deal == "FULL") & starts, value),
    }


def collection_rate_free_period(
    spark: SparkSession,
    a_payments: DataFrame,
    b_payments: DataFrame,
    asset_map: DataFrame,
    b_contracts: DataFrame,
    excluded: DataFrame,
    snapshots: DataFrame,
    contracts: DataFrame,
    last_day: date | str,
    rules: PortfolioRules,
    first_day: date | str | None = None,
    paid_off_source: str = "paid_date",
    full_has_recharge: bool = True,
) -> DataFrame:
    """Collection rate with daily instalments due only after a free period.

    The defaults match the established report.  ``paid_off_source="paid_off_date"``
    stops expecting money from the real pay-off date on, and
    ``full_has_recharge=False`` expects no instalments from full-price deals.
    """
    first = rules.collection_start if first_day is None else first_day
    a = a_paid_by_month(_in_months(a_payments, "payment_date", first, last_day))
    # The first payment decides the class, so all payments up to the last month count.
    end = F.add_months(month_start(as_date(last_day)), 1)
    recent = recent_installations(b_contracts, excluded, rules)
    accounts = asset_map.join(recent, "installation_id", "left_semi")
    b = b_paid_by_month(b_payments.filter(F.col("paid_time") < end), accounts)
    b = _in_months(b, "month_start", first, last_day)
    paid = _facts(a, "a", upfront=F.col("upfront"), recharge=F.col("recharge")).unionByName(
        _facts(
            b, "b",
            upfront=F.col("upfront"),
            recharge=F.col("amount") - zero_if_null(F.col("upfront")),
        )
    )
    rows = _live_snapshots(snapshots, rules).select(
        "contract_number", "snapshot_date", F.coalesce("consecutive_locked_days", F.lit(0)).alias("cld"),
        "deal_type", "total_contract_value", "paid_off",
    )
    newest = asof_month_ends(rows, "contract_number", "snapshot_date", first, last_day)
    due = _facts(
        newest.filter(F.col("cld") <= rules.free_period_cld_max), "due",
        cld=F.col("cld"), snap_deal=F.col("deal_type"),
        snap_value=F.col("total_contract_value"), snap_paid_off=F.col("paid_off"),
    )
    measures = _free_period_measures(rules, paid_off_source, full_has_recharge)
    sums = _by_month(_with_contracts(paid.unionByName(due), contracts), measures, list(measures))
    return _report(
        calendar(spark, first, last_day), sums,
        ["paid_upfront", "paid_recharge", "paid_full"],
        ["expected_upfront", "expected_recharge", "expected_full"],
    )


def _report(months: DataFrame, sums: DataFrame, paid: list[str], expected: list[str]) -> DataFrame:
    """Every month of the calendar with its rounded sums and the rate in percent."""

    def total(names: list[str]) -> Column:
        out = zero_if_null(F.col(names[0]))
        for n in names[1:]:
            out = out + zero_if_null(F.col(n))
        return out

    def rounded(names: list[str], total_name: str) -> list[Column]:
        cols = [F.round(zero_if_null(F.col(n)), 0).alias(f"{n}_fcfa") for n in names]
        return [*cols, F.round(total(names), 0).alias(total_name)]

    # Sums hold one row per month, so this join is between two tiny sides.
    return months.join(sums, "month_start", "left").select(
        "month_start",
        "month_end",
        month_label(F.col("month_start")).alias("month_year"),
        *rounded(paid, "paid_total_fcfa"),
        *rounded(expected, "expected_total_fcfa"),
        ratio(total(paid), total(expected), 2, factor=100).alias("collection_rate_pct"),
    )
