from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from arrearium import PortfolioRules
from arrearium.plans import collection, contracts as co, payments as pay, portfolio, report, snapshots as sn
from arrearium.plans.repayment import linearized_repayment
from conftest import rows

R = PortfolioRules()
AS_OF = date(2026, 3, 31)

CONTRACT = {
    "contract_number": "C", "entite": "E1", "source": "A", "categorie": "a_main", "client_number": "1", "customer_name": "n",
    "agent_number": None, "agent_name": None, "paid_date": datetime(2026, 1, 5), "registration_date": datetime(2026, 1, 10),
    "last_status_update": None, "next_status_update": None, "paid_off_date": None, "repossession_date": None,
    "product_name": "p", "asset_number": None, "deal_type": "PAYG", "total_contract_value": Decimal(1000),
    "upfront_payment": Decimal(100), "monthly_payment": Decimal(30), "total_paid": Decimal(0), "remaining_debt": Decimal(1000),
    "contract_status": "ENABLED", "paid_off": "false", "region": None, "sub_prefecture": None, "village": None,
    "consecutive_locked_days": 0, "computed_at": datetime(2026, 3, 31),
}
TYPES = {"total_contract_value": "decimal(18,2)", "upfront_payment": "decimal(18,2)", "monthly_payment": "decimal(18,2)",
         "total_paid": "decimal(18,2)", "remaining_debt": "decimal(18,2)", "consecutive_locked_days": "int"}
TIMES = ("paid_date", "registration_date", "last_status_update", "next_status_update", "paid_off_date", "repossession_date", "computed_at")
SCHEMA = ", ".join(f"{c} {TYPES.get(c, 'timestamp' if c in TIMES else 'string')}" for c in CONTRACT)


def contracts(spark, *changes):
    return spark.createDataFrame([tuple({**CONTRACT, **c}.values()) for c in changes], SCHEMA)


SNAPSHOT = {
    "snapshot_date": date(2026, 2, 10), "contract_number": "C", "entite": "E1", "source": "A", "categorie": "a_main",
    "contract_status": "ENABLED", "deal_type": "PAYG", "paid_off": "false", "total_contract_value": Decimal(1000),
    "total_paid": Decimal(100), "remaining_debt": Decimal(900), "consecutive_locked_days": 0, "region": None,
}
SNAP_SCHEMA = ", ".join(
    f"{c} {TYPES.get(c, 'date' if c == 'snapshot_date' else 'string')}" for c in SNAPSHOT
)


def snapshots(spark, *changes):
    return spark.createDataFrame([tuple({**SNAPSHOT, **c}.values()) for c in changes], SNAP_SCHEMA)


@pytest.mark.parametrize(
    "deal, status, paid_off, next_update, want",
    [
        ("FULL", "ENABLED", "false", datetime(2026, 3, 1), None),
        ("PAYG", "REPOSSESSED", "false", datetime(2026, 3, 1), None),
        ("PAYG", "CANCELLED", "false", datetime(2026, 3, 1), None),
        ("PAYG", "ENABLED", "true", datetime(2026, 3, 1), None),
        ("PAYG", "ENABLED", "false", None, None),
        ("PAYG", None, "false", datetime(2026, 3, 30), 1),
        ("PAYG", "LOCKED", "false", datetime(2026, 4, 30), 0),
        ("PAYG", "LOCKED", "false", datetime(2026, 3, 30, 0, 0, 0, 1), 0),
        ("PAYG", "LOCKED", "false", datetime(2026, 3, 1, 12), 29),
    ],
)
def test_locked_days(spark, deal, status, paid_off, next_update, want):
    df = spark.createDataFrame([(deal, status, paid_off, next_update)], "d string, s string, p string, n timestamp")
    days = co.locked_days(F.col("d"), F.col("s"), F.col("p"), F.col("n"), F.lit(AS_OF).cast("timestamp"))
    assert df.select(days).first()[0] == want


def test_aging_boundaries(spark):
    days = [None, 0, 1, 30, 31, 60, 61, 90, 91, 120, 121]
    df = contracts(spark, *[{"contract_number": str(d), "consecutive_locked_days": d} for d in days])
    df = df.unionByName(contracts(spark, {"contract_status": "REPOSSESSED", "paid_off": "true"},
                                  {"paid_off": "true", "consecutive_locked_days": 200},
                                  {"contract_status": "CANCELLED"}, {"contract_status": None}))
    got = {r.par_bucket: (r.nb_contrats, r.cld_moyen) for r in portfolio.aging_buckets(df, AS_OF, R).collect()}
    assert {k: v[0] for k, v in got.items()} == {
        "0. pas_retard": 2, "1. PAR_1_30j": 2, "2. PAR_31_60j": 2, "3. PAR_61_90j": 2, "4. PAR_91_120j": 2,
        "writeoff": 1, "repossessed": 1, "paidoff": 1,
    }
    assert got["1. PAR_1_30j"][1] == Decimal("15.5")


def test_unified_contracts_small(spark):
    a = spark.createDataFrame(
        [("A1", "E2", " active ", "no", None), ("A2", "X", None, "1", "yes"), (" ", "E1", None, None, None)],
        "contract_number string, entity_name string, status string, paid_off_status string, deal_type string",
    ).select(
        "*", F.when(F.col("contract_number") != "A9", F.lit(datetime(2026, 1, 1))).alias("signing_date"),
        *[F.lit(None).cast("timestamp").alias(c) for c in ("last_status_update", "paid_off_date", "repossession_date")],
        F.lit(datetime(2026, 3, 1)).alias("next_status_update"),
        *[F.lit(None).cast("decimal(18,2)").alias(c) for c in ("total_cost", "total_paid", "remaining_debt", "upfront_payment", "monthly_payment")],
        *[F.lit(None).cast("string").alias(c) for c in ("product_name", "client_number", "customer_name", "agent_number", "agent_name", "region", "village")],
        F.lit("own").alias("asset_number"), F.lit("D").alias("district"),
    )
    assets = spark.createDataFrame(
        [("p1", "A1", "DEPLOYED", "s", None, datetime(2026, 1, 3)), ("p2", "A1", "DEPLOYED", "s", datetime(2026, 1, 2), None),
         ("p3", "A1", "STOCK", "s", datetime(2026, 2, 2), None)],
        "payg_number string, contract_number string, status string, serial_number string, deploy_date timestamp, date_added timestamp",
    )
    b = spark.createDataFrame(
        [("B1", "Active", date(2024, 3, 31)), ("B2", "Active", date(2024, 4, 1)), ("B3", "Disabled", date(2025, 1, 1))],
        "installation_id string, status string, paid_at date",
    ).select(
        "*", *[F.lit(None).cast("string").alias(c) for c in ("customer_id", "customer_name", "region", "ward", "installed_by")],
        F.lit("loan").alias("financial_type"), *[F.lit(None).cast("date").alias(c) for c in ("activated_at", "unlocked_until", "removed_at")],
    )
    fin = spark.createDataFrame([("B2", Decimal("1500"))], "installation_id string, total_paid decimal(18,2)")
    products = spark.createDataFrame(
        [("B2", "kit", "FULL", Decimal(1000), None, None)],
        "installation_id string, product_name string, deal_type string, total_contract_value decimal(18,2), upfront_payment decimal(18,2), monthly_payment decimal(18,2)",
    )
    excluded = spark.createDataFrame([("B3",), ("B3",), (None,)], "contract_number string")
    paid_off = spark.createDataFrame([("B1", date(2026, 1, 1))], "contract_number string, paid_off_date date")
    got = {r.contract_number: r for r in co.unified_contracts(a, assets, b, fin, products, excluded, paid_off, R, AS_OF).collect()}
    assert set(got) == {"A1", "A2", "B1", "B2", "B3"}
    assert (got["A1"].entite, got["A1"].categorie, got["A1"].contract_status, got["A1"].asset_number) == ("E2", "a_other", "ENABLED", "p1")
    assert got["A1"].registration_date == datetime(2026, 1, 3) and got["A1"].consecutive_locked_days == 30
    assert (got["A2"].entite, got["A2"].deal_type, got["A2"].paid_off, got["A2"].asset_number) == ("E1", "FULL", "true", "own")
    assert [got[k].categorie for k in ("B1", "B2", "B3")] == ["b_old", "b_recent", "b_excluded"]
    assert (got["B1"].contract_status, got["B1"].paid_off, got["B1"].remaining_debt) == ("PAID_OFF", "true", None)
    assert (got["B2"].remaining_debt, got["B2"].product_name, got["B1"].product_name) == (Decimal("0.00"), "kit", "loan")
    old = co.unified_contracts(a, assets, b, fin, products, excluded, paid_off, R, AS_OF, paid_off_overrides_status=False)
    assert old.filter("contract_number = 'B1'").first().contract_status == "ENABLED"
    assert co.entity_contracts(old, "E2").count() == 1
    day = sn.daily_snapshot(old, AS_OF)
    assert day.columns == list(sn.SNAPSHOT_COLUMNS) and day.count() == 4  # the unknown status drops out


NO_PAY_A = "transaction_id string, contract_number string, payment_date date, amount decimal(18,2), status string, payment_code string"
NO_PAY_B = "transaction_id string, account string, paid_time date, amount decimal(18,2), payment_status string"


def fixed(spark, a_pay, snaps, cons, **options):
    return collection.collection_rate_fixed(
        spark, spark.createDataFrame(a_pay, NO_PAY_A), spark.createDataFrame([], NO_PAY_B),
        spark.createDataFrame([], "asset_number string, installation_id string"),
        snaps, cons, "2026-02-28", R, first_day="2026-01-01", **options,
    ).orderBy("month_start").collect()


def test_fixed_collection_rate(spark):
    cons = contracts(spark, {}, {"contract_number": "F", "deal_type": "FULL"})
    snaps = snapshots(spark, {"snapshot_date": date(2026, 1, 20)}, {"snapshot_date": date(2026, 1, 20), "contract_number": "F"})
    paid = [
        ("1", "C", date(2026, 1, 10), Decimal(100), "ACCEPTED", "DOWNPAYMENT_SUCCESS"),
        ("2", "C", date(2026, 2, 10), Decimal(15), "ACCEPTED", "FINAL_PAYMENT"),
        ("3", "C", date(2026, 2, 10), Decimal(99), "ACCEPTED", "SURVEY_SUCCESS"),
        ("4", "F", date(2026, 2, 10), Decimal(500), "ACCEPTED", "PAYMENT_SUCCESS"),
        ("5", "F", date(2026, 2, 10), Decimal(7), "ACCEPTED", "REVERSED"),
        ("6", "nobody", date(2026, 2, 10), Decimal(7), "ACCEPTED", "PAYMENT_SUCCESS"),
    ]
    jan, feb = fixed(spark, paid, snaps, cons)
    assert (jan.paid_upfront_fcfa, jan.expected_upfront_fcfa, jan.expected_cash_sales_fcfa, jan.expected_recharge_fcfa) == (100, 100, 30, 0)
    assert jan.collection_rate_pct == Decimal("76.92")
    # a full-price payment counts by its code and as a cash sale, reversed codes included
    assert (feb.paid_recharge_fcfa, feb.paid_cash_sales_fcfa, feb.expected_recharge_fcfa) == (515, 507, 30)
    _, strict = fixed(spark, paid, snaps, cons, strict=True)
    assert (strict.paid_recharge_fcfa, strict.paid_cash_sales_fcfa) == (15, 500)


def test_rate_is_null_when_nothing_is_expected(spark):
    jan, feb = fixed(spark, [], snapshots(spark, {"consecutive_locked_days": 121}), contracts(spark, {}))
    assert (feb.expected_total_fcfa, feb.collection_rate_pct, jan.paid_total_fcfa) == (0, None, 0)
    _, limit = fixed(spark, [], snapshots(spark, {"consecutive_locked_days": 120}), contracts(spark, {}))
    assert limit.expected_recharge_fcfa == 30


def free(spark, snaps, cons, b_pay=(), **options):
    b = spark.createDataFrame([("B", date(2025, 1, 1))], "installation_id string, paid_at date")
    return collection.collection_rate_free_period(
        spark, spark.createDataFrame([], NO_PAY_A), spark.createDataFrame(list(b_pay), NO_PAY_B),
        spark.createDataFrame([("a1", "B"), ("a2", "B")], "asset_number string, installation_id string"), b,
        spark.createDataFrame([], "contract_number string"), snaps, cons, "2026-03-31", R, first_day="2026-01-01", **options,
    ).orderBy("month_start").collect()


def test_free_period_days(spark):
    # registered 10 January: free until 9 February, so 20 of February's days are due
    jan, feb, mar = free(spark, snapshots(spark, {"snapshot_date": date(2026, 1, 15)}), contracts(spark, {}))
    assert [m.expected_recharge_fcfa for m in (jan, feb, mar)] == [0, 20, 31]
    assert jan.expected_upfront_fcfa == 100
    # the free period ends exactly on the month end
    ends = contracts(spark, {"registration_date": datetime(2026, 1, 29)})
    _, feb, mar = free(spark, snapshots(spark, {"snapshot_date": date(2026, 1, 30)}), ends)
    assert [feb.expected_recharge_fcfa, mar.expected_recharge_fcfa] == [0, 31]


def test_free_period_options(spark):
    full = snapshots(spark, {"snapshot_date": date(2026, 1, 15), "deal_type": "FULL"})
    jan, feb, _ = free(spark, full, contracts(spark, {"deal_type": "FULL"}))
    assert (jan.expected_full_fcfa, feb.expected_recharge_fcfa) == (1000, 20)
    _, feb, _ = free(spark, full, contracts(spark, {"deal_type": "FULL"}), full_has_recharge=False)
    assert feb.expected_recharge_fcfa == 0
    done = snapshots(spark, {"snapshot_date": date(2026, 1, 15), "paid_off": "true"})
    late = contracts(spark, {"paid_off_date": datetime(2026, 2, 20)})
    assert [m.expected_recharge_fcfa for m in free(spark, done, late)] == [0, 0, 0]  # the sale date counts
    got = free(spark, done, late, paid_off_source="paid_off_date")
    assert [m.expected_recharge_fcfa for m in got] == [0, 20, 0]


def test_first_payment_of_an_installation_is_upfront_across_accounts(spark):
    b_pay = [
        ("t3", "a1", date(2026, 2, 1), Decimal(5), "OK"), ("t1", "a2", date(2025, 12, 1), Decimal(50), "OK"),
        ("t2", "a1", date(2026, 1, 3), Decimal(7), "OK"), ("t0", "a1", date(2025, 11, 1), Decimal(9), "REVERSED"),
    ]
    cons = contracts(spark, {"contract_number": "B", "categorie": "b_recent"})
    jan, feb, _ = free(spark, snapshots(spark, {}), cons, b_pay)
    assert (jan.paid_upfront_fcfa, jan.paid_recharge_fcfa, feb.paid_recharge_fcfa) == (0, 7, 5)
    labelled = pay.classified_payments(
        spark.createDataFrame([], NO_PAY_A), spark.createDataFrame(b_pay, NO_PAY_B),
        spark.createDataFrame([("a1", "B"), ("a2", "B")], "asset_number string, installation_id string"),
        spark.createDataFrame([("B", date(2025, 1, 1))], "installation_id string, paid_at date"),
        spark.createDataFrame([], "contract_number string"), R,
    )
    assert rows(labelled.select("transaction_id", "payment_class")) == [("t1", "upfront"), ("t2", "recharge"), ("t3", "recharge")]


def test_repayment(spark):
    def at(**change):
        r = linearized_repayment(contracts(spark, change), AS_OF, R).first()
        return r and (r.days_on_books, r.paid_linearized, r.expected_to_date, r.pvp_linearized)

    assert at(registration_date=datetime(2026, 3, 31), total_paid=Decimal(130)) == (0, 30, 0, 1)
    assert at(registration_date=datetime(2026, 3, 1), total_paid=Decimal(130))[0] == 0
    day31 = at(registration_date=datetime(2026, 2, 28), total_paid=Decimal(130), next_status_update=datetime(2026, 4, 10))
    assert day31 == (1, 20, 1, 20)
    locked = at(registration_date=datetime(2026, 2, 28), contract_status="LOCKED", total_paid=Decimal(130),
                last_status_update=datetime(2026, 3, 1), next_status_update=datetime(2026, 4, 10))
    assert locked == (1, 30, 1, 30)
    assert at(total_contract_value=Decimal(0)) is None and at(monthly_payment=Decimal(0)) is None
    assert at(categorie="a_other") is None and at(contract_status="REPOSSESSED") is None
    bins = [linearized_repayment(contracts(spark, {"total_paid": Decimal(p)}), AS_OF, R).first().loan_paid_bin for p in ("50", "100.01", "190", "190.01", "1000")]
    assert bins == [0, 10, 10, 20, 100]


def test_month_snapshots(spark):
    a = spark.createDataFrame(
        [("C", "ACTIVE", None, datetime(2026, 2, 28)), ("D", "CANCELLED", datetime(2026, 2, 28, 0, 0, 1), None)],
        "contract_number string, status string, repossession_date timestamp, paid_off_date timestamp",
    )
    ref = spark.createDataFrame([("C", date(2026, 2, 1)), ("D", date(2026, 2, 1)), ("D", date(2027, 1, 1))], "contract_number string, deploy_date date")
    paid = spark.createDataFrame([("1", "C", date(2026, 9, 1), Decimal(5), "ACCEPTED", "PAYMENT_SUCCESS"), ("2", "D", date(2026, 1, 1), Decimal(9), "ACCEPTED", None)], NO_PAY_A)
    snaps = snapshots(spark, {}, {"contract_number": "D"})
    got = rows(sn.month_snapshot_a(snaps, ref, a, paid, "2026-01-01", "2026-02-28", R).select("month_end", "contract_number", "contract_status", "total_paid"))
    feb = date(2026, 2, 28)
    assert got == [(feb, "C", "PAIDOFF", Decimal("5.00")), (feb, "D", "CANCELLED", Decimal("100.00"))]


def test_month_snapshot_b(spark):
    b = spark.createDataFrame([("B", "Active", None, date(2026, 1, 1)), ("G", "Active", date(2026, 2, 28), None)], "installation_id string, status string, removed_at date, unlocked_until date")
    hist = spark.createDataFrame([("B", "B", date(2026, 2, 1), date(2026, 2, 18)), ("B", "B", date(2026, 3, 9), date(2026, 5, 1))], "source string, contract_number string, transaction_date date, unlocked_until date")
    paid = spark.createDataFrame([("1", "x", date(2026, 1, 5), Decimal(10), "OK"), ("2", "x", date(2026, 2, 5), Decimal(5), "OK")], NO_PAY_B)
    link = spark.createDataFrame([("x", "B")], "asset_number string, installation_id string")
    on = {"source": "B", "categorie": "b_recent"}
    snaps = snapshots(spark, {**on, "contract_number": "B", "snapshot_date": date(2026, 3, 3)}, {**on, "contract_number": "G"})

    def table(**o):
        df = sn.month_snapshot_b(snaps, b, hist, paid, link, "2026-02-01", "2026-03-31", R, **o)
        return rows(df.select("month_end", "contract_number", "snap_cld", "contract_status", "total_paid"))

    feb, mar = date(2026, 2, 28), date(2026, 3, 31)
    assert table() == [
        (feb, "B", 10, "ENABLED", Decimal("15.00")), (feb, "G", 0, "REPOSSESSED", Decimal("100.00")),
        (mar, "B", 0, "ENABLED", Decimal("100.00")), (mar, "G", 0, "REPOSSESSED", Decimal("100.00")),
    ]
    assert table(carry_forward=True)[2] == (mar, "B", 0, "ENABLED", Decimal("15.00"))


def test_report_boundaries(spark):
    days = [None, 0, 59, 60, 61, 90, 91, 120, 121]
    snaps = snapshots(spark, *[{"contract_number": str(d), "consecutive_locked_days": d} for d in days])
    cons = contracts(spark, *[{"contract_number": str(d)} for d in days[:-1]],
                     {"contract_number": "121", "repossession_date": datetime(2026, 2, 3)})
    ref = cons.select("contract_number", F.lit(date(2026, 1, 1)).alias("deploy_date"))
    rate = spark.createDataFrame([], "month_end date, paid_total_fcfa decimal(18,0), expected_total_fcfa decimal(18,0), collection_rate_pct decimal(18,2)")
    r = report.monthly_report(snaps, ref, cons, rate, "2026-02-01", "2026-02-28", R).first()
    assert (r.nb_contrats, r.nb_clients_actifs, r.nb_pas_retard, r.nb_31_60j, r.nb_61_90j, r.nb_91_120j) == (8, 3, 2, 2, 2, 2)
    assert (r.nb_hors_portefeuille, r.nb_new_default, r.nb_default_90j_plus, r.nb_new_repossessions) == (1, 3, 2, 1)
    assert (r.new_default_rate_pct, r.repossession_rate_pct, r.month_year) == (Decimal("37.50"), Decimal("50.00"), "2026-02")


def test_history(spark):
    a = spark.createDataFrame([("A1", "E2", " locked", "Yes", "2024-02-29"), ("B1", "E1", "x", "no", "2024-01-01")], "contract_number string, entity_name string, status string, paid_off_status string, s string").select(
        "*", F.col("s").cast("timestamp").alias("signing_date"), F.lit(None).cast("string").alias("deal_type"),
        *[F.lit(Decimal(1)).cast("decimal(18,2)").alias(c) for c in ("total_cost", "total_paid", "remaining_debt")], F.lit("r").alias("region"))
    b = spark.createDataFrame([("B1", "Active", date(2024, 5, 1), date(2024, 3, 1)), ("B2", "Active", date(2024, 1, 1), None)], "installation_id string, status string, paid_at date, activated_at date").withColumn("region", F.lit("r"))
    ledger = spark.createDataFrame([("O", "B1", date(2024, 2, 29), Decimal(5), None), ("O", "B1", date(2024, 3, 31), Decimal(7), Decimal(93))], "contract_ogc string, installation_id string, posting_date date, total_cash_collected decimal(18,2), ending_principal decimal(18,2)")
    products = spark.createDataFrame([("B1", None, Decimal(100))], "installation_id string, deal_type string, total_contract_value decimal(18,2)")
    none = spark.createDataFrame([], "contract_number string")

    def run(**o):
        df = sn.historical_rebuild(a, b, ledger, products, none, "2024-01-01", "2024-04-30", R, **o)
        return rows(df.select("snapshot_date", "contract_number", "entite", "contract_status", "categorie", "total_paid", "remaining_debt"))

    got = run()
    b1 = [r for r in got if r[1] == "B1"]
    assert [(r[0].month, r[2], r[3], r[5], r[6]) for r in b1] == [
        (1, "B", "Active", 0, 100), (2, "B", "Active", 5, 100), (3, "B", "Active", 7, 93), (4, "B", "Active", 7, 93)
    ]
    a1 = [r for r in got if r[1] == "A1"]
    assert [(r[0], r[2], r[3], r[4]) for r in a1] == [(d, "E2", "LOCKED", "a_main") for d in (date(2024, 2, 29), date(2024, 3, 31), date(2024, 4, 30))]
    assert len(got) == 7
    fixed_labels = run(corrected=True)
    assert {(r[2], r[3], r[4]) for r in fixed_labels} == {("E1", "ENABLED", "b_recent"), ("E2", "LOCKED", "a_other")}
    assert [r[0].month for r in fixed_labels if r[1] == "B1"] == [3, 4]
    existing = snapshots(spark, {"snapshot_date": date(2024, 3, 31)})
    assert {r[0].month for r in run(existing=existing)} == {1, 2, 4}


def test_pending_and_activations(spark):
    cons = contracts(spark, {"registration_date": None}, {"contract_number": "new", "paid_date": datetime(2026, 3, 1), "registration_date": None},
                     {"contract_number": "off", "registration_date": None, "contract_status": "CANCELLED"},
                     {"contract_number": "unknown", "registration_date": None, "contract_status": None}, {"contract_number": "on"})
    got = portfolio.pending_installations(cons, AS_OF, R).collect()
    assert [(r.contract_number, r.jours_attente) for r in got] == [("new", 30), ("C", 85)]
    r = portfolio.activations_monthly(cons, R).collect()
    assert [(x.mois, x.nb_activations, x.mensualite_moyenne) for x in r] == [(date(2026, 1, 1), 1, Decimal(30))]


def test_listing_and_stats(spark):
    days = [date(2026, 1, d) for d in range(1, 15)]
    snaps = snapshots(spark, *[{"snapshot_date": d, "contract_number": str(i)} for d in days for i in range(2)])
    audit = spark.createDataFrame([(d, datetime(2026, 1, d.day, 6)) for d in days[1:]], "snapshot_date date, run_at timestamp")
    got = portfolio.snapshot_listing(snaps, audit).collect()
    assert [r.snapshot_date.day for r in got] == list(range(14, 4, -1)) and {r.contrats for r in got} == {2}
    s = portfolio.snapshot_stats(snaps, "2026-01-02").first()
    assert (s.nb, s.cr) == (2, Decimal("10.0"))


BASE_ROWS = {
    "region": "0 r_regionkey, 'R' r_name",
    "nation": "0 n_nationkey, 'N' n_name, 0 n_regionkey",
    "customer": "id c_custkey, 'C' c_name, 0 c_nationkey, 'M' c_mktsegment, 0D c_acctbal",
    "supplier": "id s_suppkey, 'S' s_name, 0 s_nationkey, 0D s_acctbal",
    "part": "id p_partkey, 'P' p_name, 'B' p_brand, 'T' p_type, 1 p_size, 1D p_retailprice",
    "orders": "id o_orderkey, id o_custkey, 'O' o_orderstatus, 900D o_totalprice, TIMESTAMP'2001-01-02' o_orderdate, '1-URGENT' o_orderpriority",
    "lineitem": """id l_orderkey, id l_partkey, id l_suppkey, 1 l_linenumber, 5D l_quantity, 100D l_extendedprice, 0D l_discount, 0D l_tax,
        'A' l_returnflag, 'F' l_linestatus, TIMESTAMP'2001-03-30' l_shipdate""",
    "events": "id event_id, TIMESTAMP'2001-03-30' ts, id user_id, 'x' event_type, 1D value, '' props",
}


def test_month_reload_works_out_its_sides_once(spark, monkeypatch, tmp_path):
    from catalog import kpis
    from catalog.tables import Tables

    plans, reload = [], kpis.sn.reload_months

    def loads(a, b, path):
        plans.append(a.unionByName(b)._jdf.queryExecution().optimizedPlan().toString())
        reload(a, b, path)

    monkeypatch.setattr(kpis.sn, "reload_months", loads)
    for name, columns in BASE_ROWS.items():
        n = 1 if name in ("region", "nation") else 40
        spark.sql(f"SELECT {columns} FROM range({n})").write.parquet(f"{tmp_path}/{name}.parquet")
    assert kpis.month_table_reload(Tables.of(spark, str(tmp_path))).count() > 0
    assert len(plans) == 2 and not any("Join" in p for p in plans)
