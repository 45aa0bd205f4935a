"""Monthly portfolio report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium import values
from arrearium.functions.amounts import ZERO, converted, ratio, sum_if, zero_if_null
from arrearium.functions.dates import month_label
from arrearium.plans.portfolio import aging_bucket
from arrearium.plans.snapshots import a_month_ends, b_month_ends
from arrearium.rules import PortfolioRules

# Suffix of the count and receivable columns of each bucket.
BUCKET_SUFFIXES = ("pas_retard", "1_30j", "31_60j", "61_90j", "91_120j")


def _count(cond: Column, name: str) -> Column:
    return F.count_if(cond).alias(name)


def monthly_report(
    snapshots: DataFrame,
    deploy_reference: DataFrame,
    contracts: DataFrame,
    collection: DataFrame,
    first: date | str,
    last: date | str,
    rules: PortfolioRules,
) -> DataFrame:
    """Portfolio size, receivables by lateness, defaults, repossessions and collection.

    ``collection`` is either collection-rate table: the report only reads its totals.
    """
    rows = a_month_ends(snapshots, deploy_reference, first, last, rules).unionByName(
        b_month_ends(snapshots, first, last, rules)
    )
    c = contracts.select(
        F.col("contract_number").alias("_c"), "repossession_date", "paid_off_date"
    )
    value = F.col("total_contract_value")
    cld = F.coalesce("consecutive_locked_days", F.lit(0))
    end = F.col("month_end")
    bucket = aging_bucket(
        F.col("consecutive_locked_days"),
        F.col("contract_status") == "REPOSSESSED",
        F.col("paid_off_date") <= end,
        values.REPORT_BUCKETS,
    )
    # Only the columns below survive the join's shuffle.
    facts = rows.join(c, F.col("contract_number") == F.col("_c"), "inner").select(
        "month_end",
        bucket.alias("bucket"),
        cld.alias("cld"),
        "total_contract_value",
        F.greatest(F.lit(ZERO), zero_if_null(value) - zero_if_null(F.col("total_paid"))).alias("receivables"),
        F.coalesce(
            (F.col("repossession_date") >= F.col("month_start")) & (F.col("repossession_date") <= end),
            F.lit(False),
        ).alias("taken_back"),
    )

    labels = values.REPORT_BUCKETS
    b = F.col("bucket")
    live = ~b.isin(labels["repossessed"], labels["paid_off"], labels["write_off"])
    days = F.col("cld")
    named = dict(zip(BUCKET_SUFFIXES, (labels["on_time"], *labels["late"]), strict=True))
    rec = F.col("receivables")

    def eur(cond: Column, amount: Column, name: str) -> Column:
        return converted(sum_if(cond, amount), rules.fx_rate).alias(name)

    sums = facts.groupBy("month_end").agg(
        _count(live, "nb_contrats"),
        eur(live, F.col("total_contract_value"), "valeur_portefeuille_eur"),
        eur(live, rec, "receivables_eur"),
        _count(live & (days < 60), "nb_clients_actifs"),
        *[_count(b == label, f"nb_{suffix}") for suffix, label in named.items()],
        _count(b == labels["write_off"], "nb_hors_portefeuille"),
        _count(b == labels["repossessed"], "nb_repossessed"),
        *[eur(b == label, rec, f"rec_{suffix}_eur") for suffix, label in named.items()],
        eur(b == labels["write_off"], rec, "rec_writeoff_eur"),
        _count(live & days.between(60, 90), "nb_new_default"),
        _count(F.col("taken_back"), "nb_new_repossessions"),
        _count(live & (days > 90), "nb_default_90j_plus"),
    )
    rates = collection.select("month_end", "paid_total_fcfa", "expected_total_fcfa", "collection_rate_pct")
    return (
        sums.join(rates, "month_end", "left")
        .withColumn("month_year", month_label(end))
        .withColumn("new_default_rate_pct", ratio(F.col("nb_new_default"), F.col("nb_contrats"), 2, 100))
        .withColumn(
            "repossession_rate_pct",
            ratio(F.col("nb_new_repossessions"), F.col("nb_default_90j_plus"), 2, 100),
        )
    )
