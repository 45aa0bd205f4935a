"""Linearised repayment: money paid against money due by time, per contract."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium.functions.amounts import ZERO, ratio
from arrearium.functions.dates import as_date
from arrearium.rules import PortfolioRules

EXACT = "decimal(28,10)"

COLUMNS = (
    "contract_number", "customer_name", "categorie", "registration_date", "deposit_free_days",
    "total_contract_value", "deposit", "daily_rate", "total_without_deposit", "status",
    "days_to_cutoff", "days_on_books", "cumulative_paid", "paid_without_deposit",
    "account_receivable", "loan_paid_bin", "paid_linearized", "expected_to_date",
    "pvp_linearized", "active_receivable", "paid_plus_receivable", "snapshot_date",
)


def with_repayment(contracts: DataFrame, as_of: date | datetime | str, rules: PortfolioRules) -> DataFrame:
    """Contracts plus the repayment measures and ``is_rated``: do the measures apply?

    Column expressions only, so KPIs can use them in the same pass over the contracts.
    """
    today = as_date(as_of)
    zero = F.lit(ZERO)
    status = F.col("contract_status")
    registered = F.col("registration_date").cast("date")
    rated = (
        F.col("categorie").isin(*rules.core_categories)
        & status.isin("ENABLED", "LOCKED", "PAID_OFF")
        & F.col("registration_date").isNotNull()
        & (F.col("monthly_payment") > 0)
        & (F.col("total_contract_value") > 0)
    )
    due_by = F.when(status == "LOCKED", F.col("last_status_update")).when(
        status == "ENABLED", F.col("next_status_update")
    )
    cutoff = F.when(
        status.isin("LOCKED", "ENABLED"), F.datediff(due_by.cast("date"), today)
    ).otherwise(0)
    base = contracts.withColumns(
        {
            "is_rated": F.coalesce(rated, F.lit(False)),
            "deposit_free_days": F.lit(rules.free_days),
            "daily_rate": (F.col("monthly_payment").cast(EXACT) / F.lit(30)).cast(EXACT),
            "total_without_deposit": F.col("total_contract_value") - F.col("upfront_payment"),
            "days_to_cutoff": cutoff,
            "days_on_books": F.greatest(F.datediff(today, registered) - rules.free_days, F.lit(0)),
            "paid_without_deposit": F.greatest(F.col("total_paid") - F.col("upfront_payment"), zero),
            "active_receivable": F.when(
                status.isin("ENABLED", "PAID_OFF"), F.col("remaining_debt")
            ).otherwise(zero),
        }
    )
    on_books = F.col("days_on_books") > 0
    paid, whole = F.col("paid_without_deposit"), F.col("total_without_deposit")
    ahead = (F.greatest("days_to_cutoff", F.lit(0)) * F.col("daily_rate")).cast(EXACT)
    by_time = (F.col("days_on_books") * F.col("daily_rate")).cast(EXACT)
    running = on_books & status.isin("LOCKED", "ENABLED")
    measured = base.withColumns(
        {
            "loan_paid_bin": F.ceil((paid * 10 / F.nullif(whole, zero)).cast(EXACT)).cast("bigint") * 10,
            "paid_linearized": F.when(running, F.greatest(paid - ahead, zero)).otherwise(paid),
            "expected_to_date": F.when(on_books, F.least(by_time, whole)).otherwise(zero),
            "paid_plus_receivable": paid + F.col("active_receivable"),
        }
    )
    rate = ratio(F.col("paid_linearized"), F.col("expected_to_date"), 4)
    return measured.withColumn(
        "pvp_linearized", F.when(F.col("expected_to_date") > 0, rate).otherwise(F.lit(1))
    )


def linearized_repayment(
    contracts: DataFrame, as_of: date | datetime | str, rules: PortfolioRules
) -> DataFrame:
    """One row per running or paid-off contract of the core categories; no shuffle."""
    rows = with_repayment(contracts, as_of, rules).filter("is_rated")
    return rows.withColumns(
        {
            "registration_date": F.col("registration_date").cast("date"),
            "deposit": F.col("upfront_payment"),
            "status": F.col("contract_status"),
            "cumulative_paid": F.col("total_paid"),
            "account_receivable": F.col("remaining_debt"),
            "snapshot_date": as_date(as_of),
        }
    ).select(*COLUMNS)
