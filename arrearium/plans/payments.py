"""Payment classification and monthly paid amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearium import values
from arrearium.functions.amounts import sum_if
from arrearium.functions.dates import month_start
from arrearium.operators.joins import not_in, spread_join
from arrearium.rules import PortfolioRules
from arrearium.session import scratch_path


def a_class(code: Column) -> Column:
    return F.when(code.isin(*values.UPFRONT_CODES), "upfront").when(
        code.isin(*values.RECHARGE_CODES), "recharge"
    )


def a_collected(a_payments: DataFrame) -> DataFrame:
    """Accepted payments with a code that counts as money received."""
    code = F.col("payment_code")
    return a_payments.filter(
        (F.col("status") == "ACCEPTED") & code.isNotNull() & ~code.isin(*values.IGNORED_CODES)
    )


def b_collected(b_payments: DataFrame) -> DataFrame:
    return b_payments.filter(F.col("payment_status") != "REVERSED")


def recent_installations(b_contracts: DataFrame, excluded: DataFrame, rules: PortfolioRules) -> DataFrame:
    """Installations sold since the cut-off and not on the exclusion list."""
    recent = b_contracts.filter(F.col("paid_at") >= F.lit(rules.b_recent_from)).select("installation_id")
    return not_in(recent, excluded, "installation_id", "contract_number")


def classified_payments(
    a_payments: DataFrame,
    b_payments: DataFrame,
    asset_map: DataFrame,
    b_contracts: DataFrame,
    excluded: DataFrame,
    rules: PortfolioRules,
) -> DataFrame:
    """Every counted payment with its class.

    System A classes by code (other codes drop out).  In system B the first payment of
    an installation is upfront and the rest are recharges.
    """
    a = (
        a_collected(a_payments)
        .select(
            "transaction_id",
            "contract_number",
            F.col("payment_date").cast("timestamp").alias("payment_date"),
            "amount",
            a_class(F.col("payment_code")).alias("payment_class"),
        )
        .filter(F.col("payment_class").isNotNull())
    )
    recent = recent_installations(b_contracts, excluded, rules)
    accounts = asset_map.join(recent, "installation_id", "left_semi")
    b = with_first_payment(b_collected(b_payments), accounts).select(
        "transaction_id",
        F.col("installation_id").alias("contract_number"),
        F.col("paid_time").cast("timestamp").alias("payment_date"),
        "amount",
        F.when(F.col("is_first"), "upfront").otherwise("recharge").alias("payment_class"),
    )
    return a.unionByName(b)


def with_first_payment(payments: DataFrame, accounts: DataFrame) -> DataFrame:
    """Payments with their installation and ``is_first``: the installation's earliest one.

    The earliest payment is found per account, then per installation, as aggregates; its
    id travels with the account, so the payments themselves are shuffled once.  The
    accounts' figures, a row each, are stored first: three later steps read them, and
    the payments are scanned twice in all.
    """
    at = F.struct(F.col("paid_time").isNull().alias("undated"), "paid_time", "transaction_id")
    path = scratch_path(payments.sparkSession, "accounts")
    payments.groupBy("account").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("_at")).write.parquet(path)
    per_account = payments.sparkSession.read.parquet(path)
    firsts = (
        accounts.join(per_account, F.col("asset_number") == F.col("account"), "inner")
        .groupBy("installation_id")
        .agg(F.min("_at").alias("_at"))
        .select("installation_id", F.col("_at.transaction_id").alias("_first_id"))
    )
    linked = accounts.join(firsts, "installation_id").select("asset_number", "installation_id", "_first_id")
    counts = per_account.select("account", "n")
    return (
        spread_join(payments, linked, "account", "asset_number", "transaction_id", counts)
        .withColumn("is_first", F.col("transaction_id") == F.col("_first_id"))
        .drop("_first_id", "asset_number")
    )


def a_paid_by_month(a_payments: DataFrame) -> DataFrame:
    """Per contract and month: upfront, recharge and every accepted amount.

    Null where no payment matches.  Rows combine before the shuffle.
    """
    code = F.col("payment_code")
    counted = code.isNotNull() & ~code.isin(*values.IGNORED_CODES)
    amount = F.col("amount")
    return (
        a_payments.filter((F.col("status") == "ACCEPTED") & F.col("payment_date").isNotNull())
        .groupBy("contract_number", month_start(F.col("payment_date")).alias("month_start"))
        .agg(
            sum_if(counted & code.isin(*values.UPFRONT_CODES), amount).alias("upfront"),
            sum_if(counted & code.isin(*values.RECHARGE_CODES), amount).alias("recharge"),
            F.sum(amount).alias("accepted"),
        )
    )


def b_paid_by_month(b_payments: DataFrame, asset_map: DataFrame) -> DataFrame:
    """Per installation and month: amount, and the installation's first payment.

    The first payment of an installation is the smallest (time, id, amount) struct, an
    aggregate that combines on the map side; no row-level ranking of a hot account.
    """
    first = F.struct("paid_time", "transaction_id", "amount")
    per_account = (
        b_collected(b_payments)
        .filter(F.col("paid_time").isNotNull())
        .groupBy("account", month_start(F.col("paid_time")).alias("month_start"))
        .agg(F.sum("amount").alias("amount"), F.min(first).alias("first"))
    )
    link = asset_map.select("asset_number", F.col("installation_id").cast("string").alias("installation_id"))
    per_month = (
        per_account.join(link, F.col("account") == F.col("asset_number"), "inner")
        .groupBy(F.col("installation_id").alias("contract_number"), "month_start")
        .agg(F.sum("amount").alias("amount"), F.min("first").alias("first"))
    )
    whole = Window.partitionBy("contract_number")
    is_first = F.col("first") == F.min("first").over(whole)
    return per_month.withColumn("upfront", F.when(is_first, F.col("first.amount"))).drop("first")
