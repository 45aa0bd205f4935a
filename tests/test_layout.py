"""Tables laid out by key join and group without shuffles."""

import pytest

from arrearium.operators.layout import BUCKETS, buckets_for, exchanges, laid_out
from arrearium.plans import collection
from arrearium.session import scratch_path
from catalog import kpis
from catalog.tables import Tables
from conftest import rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_joins_and_groups_on_the_key_need_no_exchange(no_broadcast):
    spark = no_broadcast
    left = spark.range(1000).selectExpr("CASE WHEN id % 50 > 0 THEN id % 50 END k", "id v")
    right = spark.range(60).selectExpr("id k", "id * 2 w")
    a, b = laid_out(left, "k", 4), laid_out(right, "k", 4)
    joined = a.join(b, "k").groupBy("k", "w").count()
    assert exchanges(joined) == 0
    assert rows(joined) == rows(left.join(right, "k").groupBy("k", "w").count())
    assert rows(a) == rows(left) and laid_out(left.limit(0), "k", 4).count() == 0


def test_the_fixed_rate_has_less_than_half_the_exchanges(no_broadcast):
    t = Tables.of(no_broadcast, FOLDER)

    def stored(df):
        path = scratch_path(no_broadcast, "plain")
        df.write.parquet(path)
        return no_broadcast.read.parquet(path)

    contracts = stored(kpis.contracts(t))
    given = [(t.a_payments, "contract_number"), (t.b_payments, "account"), (t.fx_asset_map, "asset_number"),
             (t.snapshots, "contract_number"), (contracts, "contract_number")]
    plain = collection.collection_rate_fixed(no_broadcast, *[stored(df) for df, _ in given], kpis.COLLECTION_LAST, kpis.RULES)
    laid = collection.collection_rate_fixed(no_broadcast, *[laid_out(df, key) for df, key in given], kpis.COLLECTION_LAST, kpis.RULES)
    assert exchanges(laid) * 2 <= exchanges(plain)
    assert rows(laid) == rows(plain)


def test_buckets_grow_with_the_rows():
    assert buckets_for(0) == buckets_for(BUCKETS * 1_000_000) == BUCKETS
    assert buckets_for(BUCKETS * 1_000_000 + 1) == 2 * BUCKETS and buckets_for(216_000_000) == 256


def test_the_fixed_rate_reads_the_named_columns_only(no_broadcast):
    t = Tables.of(no_broadcast, FOLDER)
    tables = {"a_payments": t.a_payments, "b_payments": t.b_payments, "asset_map": t.fx_asset_map, "snapshots": t.snapshots,
              "contracts": kpis.contracts(t)}
    few = {name: tables[name].select(*columns) for name, columns in collection.FIXED_READS.items()}
    whole, part = (
        collection.collection_rate_fixed(no_broadcast, **given, last_day=kpis.COLLECTION_LAST, rules=kpis.RULES) for given in (tables, few)
    )
    assert rows(part) == rows(whole) and len(rows(whole)) > 0
