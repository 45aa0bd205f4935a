"""Portfolio KPIs over the unified contracts, and snapshot listings."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium import values
from arrearium.functions.amounts import converted, mean_if, mean_of, ratio, sum_if
from arrearium.functions.dates import as_date, month_start
from arrearium.plans.repayment import with_repayment
from arrearium.rules import PortfolioRules


def aging_bucket(cld: Column, repossessed: Column, paid_off: Column, labels: Mapping) -> Column:
    """Bucket label: repossessed and paid off first, then by days late (null counts as 0)."""
    days = F.coalesce(cld, F.lit(0))
    out = (
        F.when(repossessed, labels["repossessed"])
        .when(paid_off, labels["paid_off"])
        .when(days > values.LATE_BOUNDS[-1], labels["write_off"])
        .when(days == 0, labels["on_time"])
    )
    low = 1
    for high, label in zip(values.LATE_BOUNDS, labels["late"], strict=True):
        out = out.when(cld.between(low, high), label)
        low = high + 1
    return out.otherwise(labels["other"])


def aging_buckets(contracts: DataFrame, as_of: date | datetime | str, rules: PortfolioRules) -> DataFrame:
    """Contracts and money per owner, source, category and days-late bucket."""
    cld = F.col("consecutive_locked_days")
    bucket = aging_bucket(
        cld, F.col("contract_status") == "REPOSSESSED", F.col("paid_off") == "true", values.DAILY_BUCKETS
    )
    return (
        contracts.filter(F.col("contract_status") != "CANCELLED")
        .groupBy("entite", "source", "categorie", bucket.alias("par_bucket"))
        .agg(
            F.count(F.lit(1)).alias("nb_contrats"),
            converted(F.sum("total_contract_value"), rules.fx_rate).alias("valeur_eur"),
            converted(F.sum("remaining_debt"), rules.fx_rate).alias("receivables_eur"),
            mean_of(cld, 1).alias("cld_moyen"),
        )
        .select(as_date(as_of).alias("report_date"), "*")
    )


def portfolio_summary(contracts: DataFrame, as_of: date | datetime | str, rules: PortfolioRules) -> DataFrame:
    """One row of headline figures over contracts and their linearised repayment.

    The repayment measures are columns of the same rows, so nothing is joined and the
    only exchange is one partial row per task.
    """
    in_scope = (F.col("entite") == rules.entity_main) | (F.col("categorie") == rules.category_b_recent)
    status, cld = F.col("contract_status"), F.col("consecutive_locked_days")
    active = (status == "ENABLED") & in_scope & (F.coalesce(cld, F.lit(0)) <= rules.write_off_days)
    rated = F.col("is_rated") & (F.col("pvp_linearized") < rules.pvp_cap) & (F.col("days_on_books") > 0)
    late = [
        F.count_if(cld.between(low, high) & in_scope).alias(f"nb_par_{low}_{high}j")
        for low, high in zip((1, 31, 61, 91), values.LATE_BOUNDS, strict=True)
    ]
    return (
        with_repayment(contracts, as_of, rules)
        .agg(
            F.count_if(active).alias("nb_contrats_actifs"),
            F.count_if((status == "LOCKED") & in_scope).alias("nb_contrats_locked"),
            F.count_if((status == "REPOSSESSED") & in_scope).alias("nb_repossedes"),
            F.count_if((F.col("paid_off") == "true") & in_scope).alias("nb_paidoff"),
            converted(sum_if(active, F.col("total_contract_value")), rules.fx_rate).alias(
                "valeur_portefeuille_eur"
            ),
            converted(sum_if(active, F.col("remaining_debt")), rules.fx_rate).alias("receivables_eur"),
            converted(sum_if(in_scope, F.col("total_paid")), rules.fx_rate).alias("total_collected_eur"),
            mean_if(rated, F.col("pvp_linearized"), 4).alias("pvp_moyen"),
            F.count_if((cld == 0) & (status == "ENABLED") & in_scope).alias("nb_cld_0"),
            *late,
            F.count_if((cld > rules.write_off_days) & in_scope).alias("nb_writeoff"),
        )
        .select(as_date(as_of).alias("report_date"), "*")
    )


def activations_monthly(contracts: DataFrame, rules: PortfolioRules) -> DataFrame:
    """Contracts activated per month, owner, source, category and product."""
    return (
        contracts.filter(
            (F.col("registration_date") >= F.lit(rules.activations_from).cast("timestamp"))
            & (F.col("contract_status") != "CANCELLED")
        )
        .groupBy(
            month_start(F.col("registration_date")).alias("mois"),
            "entite", "source", "categorie", "product_name",
        )
        .agg(
            F.count(F.lit(1)).alias("nb_activations"),
            converted(F.sum("total_contract_value"), rules.fx_rate).alias("valeur_eur"),
            mean_of(F.col("monthly_payment"), 0).alias("mensualite_moyenne"),
            mean_of(F.col("upfront_payment"), 0).alias("upfront_moyen"),
        )
    )


def pending_installations(
    contracts: DataFrame, as_of: date | datetime | str, rules: PortfolioRules
) -> DataFrame:
    """Sold but not yet installed, newest sale first (sort at the edge only)."""
    sold = F.col("paid_date").cast("date")
    return (
        contracts.filter(
            F.col("categorie").isin(*rules.core_categories)
            & F.col("paid_date").isNotNull()
            & F.col("registration_date").isNull()
            & (F.col("contract_status") != "CANCELLED")
        )
        .orderBy(F.col("paid_date").desc())
        .select(
            "contract_number", "customer_name", "entite", "categorie", "agent_name", "region",
            "sub_prefecture", "product_name",
            sold.alias("date_vente"),
            F.col("registration_date").cast("date").alias("date_installation"),
            F.datediff(as_date(as_of), sold).alias("jours_attente"),
            "total_contract_value", "upfront_payment", "contract_status",
        )
    )


def snapshot_stats(snapshots: DataFrame, day: date | str) -> DataFrame:
    """Counts, value and paid share per category and status of one daily snapshot."""
    value, paid = F.sum("total_contract_value"), F.sum("total_paid")
    return (
        snapshots.filter(F.col("snapshot_date") == as_date(day))
        .groupBy("categorie", "contract_status")
        .agg(
            F.count(F.lit(1)).alias("nb"),
            in_billions(value).alias("valeur_mrd"),
            in_billions(paid).alias("paid_mrd"),
            ratio(paid, value, 1, factor=100).alias("cr"),
        )
    )


def in_billions(amount: Column) -> Column:
    return F.round(amount / F.lit(1_000_000_000), 2)


def snapshot_listing(snapshots: DataFrame, audit: DataFrame, newest: int = 10) -> DataFrame:
    """The newest snapshots with their size, paid total and build time.

    The newest dates are found from the date column alone (the partition column of a
    stored table); only those slices are then summed, to one row per day.
    """
    runs = audit.select("snapshot_date", "run_at")
    days = (
        snapshots.select("snapshot_date")
        .distinct()
        .join(runs.select("snapshot_date"), "snapshot_date", "left_semi")
        .orderBy(F.col("snapshot_date").desc())
        .limit(newest)
    )
    sums = (
        snapshots.join(days, "snapshot_date", "left_semi")
        .groupBy("snapshot_date")
        .agg(F.count(F.lit(1)).alias("contrats"), F.sum("total_paid").alias("_paid"))
    )
    return (
        sums.join(runs, "snapshot_date", "inner")
        .groupBy("snapshot_date", "run_at")
        .agg(F.sum("contrats").alias("contrats"), in_billions(F.sum("_paid")).alias("paid_mrd"))
        .orderBy(F.col("snapshot_date").desc(), F.col("run_at").desc())
        .limit(newest)
        .select("snapshot_date", "contrats", "paid_mrd", "run_at")
    )
