"""Readers and landings under the conditions that lose or mix data: quotes, changed headers, cut pages, second landings."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from arrearium.functions.jsonpath import json_text
from arrearium.session import scratch_path
from arrearium.sources import bronze, ingest
from arrearium.sources.specs import A_PAYMENTS
from catalog.registry import dbl, query, ts, txt
from catalog.sources import raw_payments
from catalog.tables import AS_OF, VIEWS, Tables, present

# A customer name with quotes, a comma and a line break; some are missing.
NAME = "c_name || ' \"A\", Lee' || chr(10) || 'Co. \\' || c_custkey"


@query(
    "src_csv_quoting",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 7 > 0 THEN {NAME} END AS name,
     CAST(c_nationkey AS VARCHAR) AS nation FROM customer""",
)
def src_csv_quoting(t: Tables):
    path = scratch_path(t.spark, "quoted")
    name = F.concat("c_name", F.lit(' "A", Lee\nCo. \\'), F.col("c_custkey").cast("string"))
    export = t.customer.select(
        F.lit(AS_OF).alias("ingest_date"), F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 7 > 0, name).otherwise("N/A").alias("name"), F.col("c_nationkey").alias("nation"),
    )
    bronze.land_csv(export, path)
    return bronze.read_csv_export(t.spark, path, ["id", "name", "nation"]).select("id", "name", "nation")


@query(
    "src_csv_split_quoted",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 7 > 0 THEN {NAME} END AS name,
     CAST(c_nationkey AS VARCHAR) AS nation, true AS many_splits FROM customer""",
)
def src_csv_split_quoted(t: Tables):
    """An export whose cells hold quotes and line breaks; every file is read in splits of a few kilobytes."""
    path, out = scratch_path(t.spark, "quoted"), scratch_path(t.spark, "read")
    name = F.concat("c_name", F.lit(' "A", Lee\nCo. \\'), F.col("c_custkey").cast("string"))
    export = t.customer.select(
        F.lit(AS_OF).alias("ingest_date"), F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 7 > 0, name).otherwise("N/A").alias("name"), F.col("c_nationkey").alias("nation"),
    )
    bronze.land_csv(export, path)
    small = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1"}
    old = {k: t.spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            t.spark.conf.set(k, v)
        bronze.read_csv_export(t.spark, path, ["id", "name", "nation"]).write.parquet(out)
    finally:
        for k, v in old.items():
            t.spark.conf.set(k, v)
    read = t.spark.read.parquet(out)
    many = read.agg(F.count_distinct("file_path", "block_start") > F.count_distinct("file_path")).scalar()
    return read.select("id", "name", "nation", many.alias("many_splits"))


@query(
    "src_csv_header_change",
    f"""SELECT transaction_id, account, CASE WHEN year(paid_time) % 3 < 2 THEN payment_status END AS status,
     {dbl('amount')} AS amount FROM b_payments WHERE paid_time IS NOT NULL""",
)
def src_csv_header_change(t: Tables):
    """Three days whose exports have their columns in another order, or lack one."""
    path = scratch_path(t.spark, "headers")
    columns = [["ID", "Account", "Payment Status", "Amount"], ["Payment Status", "Amount", "ID", "Account"], ["Amount", "ID", "Account"]]
    export = t.b_payments.where("paid_time IS NOT NULL").select(
        (F.year("paid_time") % 3).alias("kind"), F.col("transaction_id").alias("ID"), F.col("account").alias("Account"),
        F.col("payment_status").alias("Payment Status"), F.col("amount").cast("string").alias("Amount"),
    )
    for kind, names in enumerate(columns):
        day = export.where(F.col("kind") == kind).select(F.lit(f"2001-08-0{kind + 1}").cast("date").alias("ingest_date"), *names)
        bronze.land_csv(day, path)
    got = bronze.read_csv_export(t.spark, path)
    return present(
        got.select(
            F.col("ID").alias("transaction_id"), F.col("Account").alias("account"), F.col("Payment Status").alias("status"),
            F.col("Amount").cast("decimal(18,2)").alias("amount"),
        )
    )


VIEWS["reject_events"] = "SELECT event_id, event_type FROM fx_events"


@query(
    "src_json_reject",
    """SELECT kind, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids, count(*) FILTER (type = 'last') AS n_last FROM (
     SELECT CASE WHEN event_id % 5 = 0 THEN 'reject' ELSE 'item' END AS kind, event_id AS id,
      CASE WHEN event_id % 5 > 0 THEN CASE WHEN event_id % 3 = 0 THEN 'last' ELSE event_type END END AS type FROM reject_events
     UNION ALL SELECT 'odd element', event_id, NULL FROM reject_events WHERE event_id % 7 = 0 AND event_id % 5 > 0) GROUP BY 1""",
)
def src_json_reject(t: Tables):
    """Every fifth page was cut off, every third item has a name twice, every seventh page a number among its items."""
    path, id = scratch_path(t.spark, "cut"), F.col("event_id")
    item = F.concat(
        F.lit('{"_id":'), id.cast("string"), F.lit(',"type":"'), F.col("event_type"),
        F.when(id % 3 == 0, '","type":"last').otherwise(""), F.lit('"}'),
    )
    page = F.concat(F.lit("["), item, F.when(id % 7 == 0, F.concat(F.lit(","), id.cast("string"))).otherwise(""), F.lit("]"))
    t.reject_events.select(F.when(id % 5 == 0, F.left(page, F.length(page) - 2)).otherwise(page).alias("value")).write.text(path)
    items = bronze.read_items(t.spark, path, skip_unreadable=True)
    good = items.select(
        F.lit("item").alias("kind"), json_text(F.col("raw"), "_id").cast("long").alias("id"), json_text(F.col("raw"), "type").alias("type")
    )
    number = F.col("raw").try_cast("long")
    bad = bronze.read_rejects(t.spark, path).select(
        F.when(number.isNull(), "reject").otherwise("odd element").alias("kind"),
        F.coalesce(number, F.regexp_extract("raw", '"_id":([0-9]+)', 1).try_cast("long")).alias("id"), F.lit(None).cast("string").alias("type"),
    )
    return good.unionByName(bad).groupBy("kind").agg(
        F.count("*").alias("n"), F.sum("id").alias("ids"), F.count_if(F.col("type") == "last").alias("n_last")
    )


@query(
    "land_same_day_twice",
    f"""SELECT transaction_id, {ts('payment_date')} AS payment_date,
     CASE WHEN hash_part = 0 THEN 'CORRECTED' ELSE status END AS status, {dbl('amount')} AS amount
    FROM (SELECT *, length(transaction_id) % 2 AS hash_part FROM a_payments)""",
)
def land_same_day_twice(t: Tables):
    """One day lands twice; the second landing corrects some payments and wins."""
    path = scratch_path(t.spark, "twice")
    raw, day = raw_payments(t), AS_OF.isoformat()
    for rows in (raw, raw.where("length(transactionId) % 2 = 0").withColumn("status", F.lit("CORRECTED"))):
        bronze.land_items(rows, path, bronze.next_landing(t.spark, path, day))
    current = A_PAYMENTS.current(A_PAYMENTS.rows(bronze.read_items(t.spark, path)))
    return present(current.select("transaction_id", "payment_date", "status", "amount"))


@query(
    "src_preferred_file",
    f"""SELECT event_id, event_type, {txt('CAST(ts AS DATE)')} AS day FROM fx_events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM fx_events WHERE event_id % 2 = 0) AND event_id % 2 = 0""",
)
def src_preferred_file(t: Tables):
    """Every day has a ``daily`` and an ``extra`` export; the newest day's ``daily`` one is chosen."""
    path = scratch_path(t.spark, "exports")
    events = t.fx_events.select(
        F.when(F.col("event_id") % 2 == 0, "daily").otherwise("extra").alias("kind"),
        F.col("ts").cast("date").alias("day"), "event_id", "event_type",
    )
    newest = events.where("kind = 'daily'").agg(F.max("day")).scalar()
    age = F.when(F.col("day") < newest, "old").otherwise("new")
    events.withColumn("export", F.concat_ws("-", age, "kind")).drop("kind").write.partitionBy("export").parquet(path)
    chosen = bronze.preferred_export(bronze.list_files(t.spark, path, "*.parquet"), "new-daily").first()["folder"]
    return present(t.spark.read.parquet(chosen).where(F.col("day") == newest).select("event_id", "event_type", "day"))


@query(
    "keep_raw_payload",
    """SELECT c_custkey, c_nationkey, '{"c_custkey":' || c_custkey || ',"c_nationkey":' || c_nationkey || '}' AS raw_data
    FROM customer""",
)
def keep_raw_payload(t: Tables):
    return bronze.with_raw(t.customer.select("c_custkey", "c_nationkey"))


@query(
    "filter_counted",
    """SELECT count(*) AS n_before, count(*) FILTER (status = 'ACCEPTED') AS n_kept,
     CAST(count(*) FILTER (status = 'ACCEPTED') AS BIGINT) AS n_rows FROM a_payments""",
)
def filter_counted(t: Tables):
    seen, path = Observation(), scratch_path(t.spark, "kept")
    ingest.filter_counted(t.a_payments, F.col("status") == "ACCEPTED", seen).write.parquet(path)
    rows = t.spark.read.parquet(path).agg(F.count("*").alias("n_rows"))
    return rows.select(F.lit(seen.get["n_before"]).alias("n_before"), F.lit(seen.get["n_kept"]).alias("n_kept"), "n_rows")
