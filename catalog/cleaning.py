"""Cleaning, projection, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrearium import values
from arrearium.functions import amounts as am, cleaning as cl, dates as da, jsonpath as js
from arrearium.operators import learned
from arrearium.sources import bronze
from catalog.registry import dbl, query, rnd, ts, txt
from catalog.tables import RULES, VIEWS, Tables, present

# Messy text built from the given tables; both engines start from the same rows.
VIEWS["messy_text"] = """
    SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN 'nan' WHEN 3 THEN ' NaN '
     WHEN 4 THEN 'None' WHEN 5 THEN 'NULL' WHEN 6 THEN concat('  ', o_orderpriority, ' ') WHEN 7 THEN NULL
     ELSE o_orderpriority END AS raw FROM orders"""
VIEWS["messy_numbers"] = """
    SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
     CASE o_orderkey % 7 WHEN 0 THEN concat(' ', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING), ' ')
      WHEN 1 THEN concat('1,', CAST(100000 + o_orderkey AS STRING), '.50') WHEN 2 THEN concat('2 ', CAST(o_orderkey AS STRING))
      WHEN 3 THEN concat('$', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)) WHEN 4 THEN 'abc' WHEN 5 THEN NULL
      ELSE concat('-', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)) END AS raw FROM orders"""
_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
VIEWS["messy_dates"] = f"""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CASE o_orderkey % 8
      WHEN 0 THEN concat({_DAY}, 'T02:12:10.123Z') WHEN 1 THEN concat({_DAY}, 'T02:12:10Z') WHEN 2 THEN {_DAY}
      WHEN 3 THEN concat(substr({_DAY}, 9, 2), '-', substr('JanFebMarAprMayJunJulAugSepOctNovDec',
           3 * CAST(substr({_DAY}, 6, 2) AS INT) - 2, 3), '-', substr({_DAY}, 1, 4), ' 02:12:10')
      WHEN 4 THEN concat({_DAY}, ' 02:12:10') WHEN 5 THEN 'not a date' WHEN 6 THEN '' ELSE NULL END AS raw
    FROM orders"""
VIEWS["people"] = """
    SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN concat('Test', c_mktsegment)
      ELSE c_mktsegment END AS first_name,
     CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'aTESTed' ELSE c_name END AS last_name FROM customer"""
VIEWS["raw_items"] = """
    SELECT o_orderkey, concat('{"contractNumber":"', CAST(o_orderkey AS STRING), '","client":',
      CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE concat('{"clientNumber":"', CAST(o_custkey AS STRING),
        '","profile":{"firstName":"', o_orderpriority, '"}}') END,
      CASE o_orderkey % 6 WHEN 0 THEN ',"agent":{"agentNumber":"G1"}' WHEN 1 THEN ',"agent":"G2"'
        WHEN 2 THEN ',"agent":null,"assignedTo":{"id":"G3"}' WHEN 3 THEN ',"agent":{}' WHEN 4 THEN ',"assignedTo":"G4"'
        ELSE '' END,
      CASE o_orderkey % 4 WHEN 0 THEN ',"asset":{"serials":["S0","S1"]},"serial":"X"' WHEN 1 THEN ',"asset":{"serials":[]},"serial":"Y"'
        WHEN 2 THEN ',"asset":{"serials":[""]},"serial":"Z"' ELSE '' END,
      ',"amount":', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING), '}') AS raw FROM orders"""


@query(
    "clean_null_tokens",
    """SELECT o_orderkey, CASE WHEN lower(trim(raw)) IN ('', 'nan', 'none', 'null') THEN NULL ELSE trim(raw) END AS cleaned,
     CASE WHEN lower(trim(raw)) IN ('', 'nan', 'none') THEN NULL ELSE trim(raw) END AS ledger_cleaned FROM messy_text""",
)
def clean_null_tokens(t: Tables):
    return t.messy_text.select(
        "o_orderkey",
        cl.clean_text(F.col("raw")).alias("cleaned"),
        cl.clean_text(F.col("raw"), values.LEDGER_NULL_TOKENS).alias("ledger_cleaned"),
    )


@query(
    "clean_numbers",
    f"""SELECT o_orderkey,
     {dbl("TRY_CAST(replace(replace(raw, ',', ''), ' ', '') AS DECIMAL(18,2))")} AS comma_blank,
     {dbl("TRY_CAST(trim(replace(raw, ',', '')) AS DECIMAL(18,2))")} AS comma_only,
     {dbl("TRY_CAST(trim(replace(replace(raw, ',', ''), '$', '')) AS DECIMAL(18,2))")} AS comma_dollar,
     CAST(trunc(TRY_CAST(replace(replace(raw, ',', ''), ' ', '') AS DECIMAL(18,2))) AS INT) AS whole
    FROM messy_numbers""",
)
def clean_numbers(t: Tables):
    raw = F.col("raw")
    return present(
        t.messy_numbers.select(
            "o_orderkey",
            cl.clean_number(raw).alias("comma_blank"),
            cl.clean_number(raw, ",").alias("comma_only"),
            cl.clean_number(raw, ",$").alias("comma_dollar"),
            cl.clean_int(raw).alias("whole"),
        )
    )


_AT = "CAST(d AS TIMESTAMP) + INTERVAL 7930 SECOND"
_MS = "CAST(d AS TIMESTAMP) + INTERVAL 7930123 MILLISECOND"


def _parsed(*kinds: int) -> str:
    value = {0: _MS, 1: _AT, 2: "CAST(d AS TIMESTAMP)", 3: _AT, 4: _AT}
    whens = " ".join(f"WHEN {k} THEN {ts(value[k])}" for k in kinds)
    return f"CASE o_orderkey % 8 {whens} END"


@query(
    "clean_dates",
    f"""SELECT o_orderkey, {_parsed(0, 1)} AS strict_at, {_parsed(0, 1, 2)} AS form_at, {_parsed(0, 1, 2, 3)} AS task_at,
     {_parsed(0, 1, 2, 4)} AS event_at, CASE WHEN o_orderkey % 8 IN (2, 3, 4) THEN CAST(d AS VARCHAR) END AS lenient_day
    FROM messy_dates""",
)
def clean_dates(t: Tables):
    raw = F.col("raw")
    lenient = F.when(~raw.contains("T"), cl.clean_date(raw))
    return present(
        t.messy_dates.select(
            "o_orderkey",
            cl.parse_timestamp(raw, values.A_FORMATS).alias("strict_at"),
            cl.parse_timestamp(raw, values.FORM_FORMATS).alias("form_at"),
            cl.parse_timestamp(raw, values.TASK_FORMATS).alias("task_at"),
            cl.parse_timestamp(raw, values.EVENT_FORMATS).alias("event_at"),
            lenient.alias("lenient_day"),
        )
    )


@query(
    "json_extract",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS contract_number, if(o_orderkey % 5 = 0, NULL, CAST(o_custkey AS VARCHAR)) AS client_number,
     if(o_orderkey % 5 = 0, NULL, o_orderpriority) AS first_name, {dbl('CAST(o_totalprice AS DECIMAL(18,2))')} AS amount,
     true AS raw_kept FROM orders""",
)
def json_extract(t: Tables):
    schema = "contractNumber string, client struct<clientNumber: string, profile: struct<firstName: string>>, amount string"
    j = t.raw_items.withColumn("j", F.from_json("raw", schema))
    return present(
        j.select(
            F.col("j.contractNumber").alias("contract_number"),
            F.col("j.client.clientNumber").alias("client_number"),
            F.col("j.client.profile.firstName").alias("first_name"),
            cl.clean_number(F.col("j.amount")).alias("amount"),
            (js.json_text(F.col("raw"), "contractNumber") == F.col("j.contractNumber")).alias("raw_kept"),
        )
    )


@query(
    "json_first_path",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'G1' WHEN 1 THEN 'G2' WHEN 2 THEN 'G3' WHEN 4 THEN 'G4' END AS agent_number,
     CASE o_orderkey % 4 WHEN 0 THEN 'S0' WHEN 1 THEN 'Y' WHEN 2 THEN 'Z' END AS serial,
     CAST(o_orderkey AS VARCHAR) AS item_id FROM orders""",
)
def json_first_path(t: Tables):
    raw = F.col("raw")
    return t.raw_items.select(
        "o_orderkey",
        js.object_or_text(
            ("agentNumber", "number", "id"), js.json_text(raw, "agent"), js.json_text(raw, "assignedTo")
        ).alias("agent_number"),
        js.first_path(raw, "asset.serials.0", "serial").alias("serial"),
        js.first_path(raw, "_id", "contractNumber").alias("item_id"),
    )


@query(
    "surrogate_key",
    """SELECT o_orderkey, sha1(concat(coalesce(CAST(o_custkey AS VARCHAR), ''), '||', coalesce(trim(raw), ''), '||',
      CAST(o_orderkey AS VARCHAR))) AS key FROM (SELECT m.o_orderkey, m.raw, o.o_custkey FROM messy_text m JOIN orders o USING (o_orderkey))""",
)
def surrogate_key(t: Tables):
    both = t.messy_text.join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    return both.select(
        "o_orderkey",
        js.surrogate_key(F.col("o_custkey"), F.trim("raw"), F.col("o_orderkey")).alias("key"),
    )


def _part(c: str) -> str:
    return f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


HASHED = ("o_orderkey", "o_custkey", "o_orderstatus", "CAST(o_totalprice AS DECIMAL(18,2))", "CAST(o_orderdate AS DATE)")


@query(
    "content_hash",
    f"SELECT o_orderkey, sha256({' || '.join(_part(c) for c in HASHED)}) AS content_id FROM orders",
)
def content_hash(t: Tables):
    return t.orders.select("o_orderkey", js.content_id(*[F.expr(c) for c in HASHED]).alias("content_id"))


@query(
    "name_concat",
    """SELECT c_custkey, CASE WHEN coalesce(trim(first_name), '') = '' AND coalesce(trim(last_name), '') = '' THEN NULL
      WHEN coalesce(trim(first_name), '') = '' THEN last_name WHEN coalesce(trim(last_name), '') = '' THEN first_name
      ELSE first_name || ' ' || last_name END AS full_name FROM people""",
)
def name_concat(t: Tables):
    return t.people.select("c_custkey", cl.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"))


@query(
    "filter_test_records",
    """SELECT c_custkey FROM people WHERE (first_name IS NULL OR first_name NOT ILIKE '%test%')
      AND (last_name IS NULL OR last_name NOT ILIKE '%test%')""",
)
def filter_test_records(t: Tables):
    return t.people.filter(~cl.is_test_name(F.col("first_name"), F.col("last_name"))).select("c_custkey")


@query(
    "filter_required",
    """SELECT o_orderkey, raw FROM messy_text WHERE raw IS NOT NULL AND trim(raw) <> ''""",
)
def filter_required(t: Tables):
    return t.messy_text.filter(cl.has_text(F.col("raw")))


@query(
    "filter_prefix",
    """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority LIKE '1-%'""",
)
def filter_prefix(t: Tables):
    return t.orders.filter(F.col("o_orderpriority").startswith("1-")).select("o_orderkey", "o_orderpriority")


@query(
    "filter_three_valued",
    f"""SELECT contract_number, status, payment_code, {dbl('amount')} AS amount FROM a_payments
     WHERE (payment_code IS NULL OR payment_code NOT IN ('REVERSED', 'SURVEY_SUCCESS')) AND amount BETWEEN 1000 AND 50000
      AND status <> 'PENDING' AND NOT (payment_code = 'MANUAL_CREDIT' AND amount > 20000)""",
)
def filter_three_valued(t: Tables):
    code = F.col("payment_code")
    return present(
        t.a_payments.filter(
            (code.isNull() | ~code.isin("REVERSED", "SURVEY_SUCCESS"))
            & F.col("amount").between(1000, 50000)
            & (F.col("status") != "PENDING")
            & ~((code == "MANUAL_CREDIT") & (F.col("amount") > 20000))
        ).select("contract_number", "status", "payment_code", "amount")
    )


@query(
    "normalize_status",
    """SELECT k, CASE WHEN ostatus = 'O' THEN 'ENABLED' WHEN ostatus = 'P' THEN 'LOCKED'
       ELSE CASE k % 8 WHEN 0 THEN 'REPOSSESSED' WHEN 2 THEN 'PAID_OFF' WHEN 4 THEN 'CANCELLED' WHEN 5 THEN 'ENABLED'
        WHEN 7 THEN 'IN REVIEW' ELSE NULL END END AS contract_status,
     CASE WHEN k % 13 = 0 THEN 'PAID_OFF' WHEN ostatus = 'O' THEN 'ENABLED' WHEN ostatus = 'P' THEN 'LOCKED'
       ELSE CASE k % 8 WHEN 0 THEN 'REPOSSESSED' WHEN 2 THEN 'PAID_OFF' WHEN 4 THEN 'CANCELLED' WHEN 5 THEN 'ENABLED'
        WHEN 7 THEN 'IN REVIEW' ELSE NULL END END AS overridden_status,
     if(k % 3 = 0, 'true', 'false') AS paid_off, if(priority IN ('1-URGENT', '2-HIGH'), 'FULL', 'PAYG') AS deal_type,
     CASE WHEN priority IN ('1-URGENT', '2-HIGH') THEN 'FULL' WHEN priority = '5-LOW' THEN NULL ELSE 'PAYG' END AS lookup_deal
    FROM sold""",
)
def normalize_status(t: Tables):
    raw = t.sql(
        """SELECT k, deal_raw, CASE WHEN ostatus = 'O' THEN ' active ' WHEN ostatus = 'P' THEN 'Locked' ELSE
             CASE k % 8 WHEN 0 THEN 'Disabled' WHEN 2 THEN 'PaidOff' WHEN 4 THEN 'cancelled'
              WHEN 5 THEN 'Awaiting Removal' WHEN 7 THEN ' in review' ELSE NULL END END AS status_raw,
            CASE k % 3 WHEN 0 THEN CASE k % 2 WHEN 0 THEN ' Yes' ELSE 'TRUE' END WHEN 1 THEN 'no' ELSE NULL END AS flag
           FROM sold"""
    )
    status = F.col("status_raw")
    return raw.select(
        "k",
        cl.normal_status(status).alias("contract_status"),
        cl.normal_status(status, F.col("k") % 13 == 0).alias("overridden_status"),
        cl.normal_flag(F.col("flag")).alias("paid_off"),
        cl.normal_deal(F.col("deal_raw")).alias("deal_type"),
        cl.lookup_deal(F.col("deal_raw")).alias("lookup_deal"),
    )


@query(
    "project_rename",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS installation_id, CAST(o_custkey AS VARCHAR) AS customer_id,
     o_orderstatus AS status, {txt('o_orderdate')} AS paid_at, CAST(NULL AS VARCHAR) AS removal_reason,
     CAST(NULL AS DOUBLE) AS latitude FROM orders""",
)
def project_rename(t: Tables):
    export = t.orders.select(
        F.col("o_orderkey").cast("string").alias("ID"), F.col("o_custkey").cast("string").alias("Customer Id"),
        F.col("o_orderstatus").alias("Status"), F.col("o_orderdate").cast("date").alias("Paid At"),
        F.col("o_totalprice").alias("Not Needed"),
    )
    return present(
        bronze.project(
            export,
            {
                "ID": "installation_id", "Customer Id": "customer_id", "Status": "status", "Paid At": "paid_at",
                "Removal Reason": "removal_reason", "Latitude": "latitude",
            },
            {"latitude": "decimal(18,8)"},
        )
    )


@query(
    "scalar_null_math",
    f"""SELECT k, {dbl('coalesce(paid, 0)')} AS paid_or_zero, {dbl('nullif(paid, price)')} AS unless_equal,
     {dbl('greatest(0, price - coalesce(paid, 0))')} AS owed, {dbl('least(price, paid)')} AS smaller,
     {rnd('CAST(price AS DOUBLE) / 655.957', 0)} AS converted, {rnd('CAST(paid AS DOUBLE) / nullif(CAST(price AS DOUBLE), 0)', 4)} AS share,
     CAST(ceil(price) AS BIGINT) AS up, CAST(floor(price) AS BIGINT) AS down, {rnd('CAST(price AS DOUBLE) / 1e9', 2)} AS billions
    FROM sold""",
)
def scalar_null_math(t: Tables):
    price, paid = F.col("price"), F.col("paid")
    return present(
        t.sold.select(
            "k",
            am.zero_if_null(paid).alias("paid_or_zero"),
            F.nullif(paid, price).alias("unless_equal"),
            F.greatest(F.lit(am.ZERO), price - am.zero_if_null(paid)).alias("owed"),
            F.least(price, paid).alias("smaller"),
            am.converted(price, RULES.fx_rate).alias("converted"),
            am.ratio(paid, price, 4).alias("share"),
            F.ceil(price).cast("bigint").alias("up"),
            F.floor(price).cast("bigint").alias("down"),
            F.round(price / F.lit(1_000_000_000), 2).alias("billions"),
        )
    )


@query(
    "scalar_string",
    """SELECT o_orderkey, upper(trim(raw)) AS up, lower(trim(raw)) AS low, trim(raw) AS trimmed,
     replace(raw, ' ', '') AS no_blanks, CAST(o_orderkey AS VARCHAR) AS text_key, raw LIKE '%NULL%' AS has_null,
     starts_with(raw, '1') AS starts FROM messy_text""",
)
def scalar_string(t: Tables):
    raw = F.col("raw")
    return t.messy_text.select(
        "o_orderkey", F.upper(F.trim(raw)).alias("up"), F.lower(F.trim(raw)).alias("low"),
        cl.strip(raw).alias("trimmed"), F.translate(raw, " ", "").alias("no_blanks"),
        F.col("o_orderkey").cast("string").alias("text_key"), raw.contains("NULL").alias("has_null"),
        raw.startswith("1").alias("starts"),
    )


@query(
    "scalar_dates",
    f"""SELECT k, {txt("date_trunc('month', sold_on)")} AS month_start, {txt('last_day(sold_on)')} AS month_end,
     strftime(sold_on, '%Y-%m') AS month_year, CAST(date_diff('day', sold_on, DATE '2001-08-31') AS INT) AS days_since,
     {txt('sold_on + INTERVAL 30 DAY')} AS free_until, {txt('sold_on - INTERVAL 45 DAY')} AS lookback,
     CAST(greatest(0, date_diff('day', sold_on, DATE '2001-08-31')) AS INT) AS locked_days,
     CAST(epoch(CAST(sold_on AS TIMESTAMP)) AS BIGINT) AS seconds, CAST(date_diff('month', sold_on, DATE '2001-08-31') + 1 AS INT) AS n_months
    FROM sold""",
)
def scalar_dates(t: Tables):
    d, today = F.col("sold_on"), da.as_date("2001-08-31")
    return present(
        t.sold.select(
            "k", da.month_start(d).alias("month_start"), da.month_end(d).alias("month_end"),
            da.month_label(d).alias("month_year"), F.datediff(today, d).alias("days_since"),
            F.date_add(d, 30).alias("free_until"), F.date_sub(d, 45).alias("lookback"),
            da.whole_days_since(d.cast("timestamp"), da.as_timestamp("2001-08-31")).alias("locked_days"),
            F.unix_seconds(d.cast("timestamp")).alias("seconds"),
            F.size(da.months_between(d, today)).alias("n_months"),
        )
    )


@query(
    "clean_dates_learned",
    f"""SELECT o_orderkey, {txt('o_orderdate')} AS day_first, {txt('o_orderdate')} AS month_first,
     CASE WHEN day(o_orderdate) <= 12 THEN CAST(make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) AS VARCHAR) END AS no_evidence,
     CASE WHEN day(o_orderdate) <= 12 AND o_orderkey % 2 = 0
      THEN CAST(make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) AS VARCHAR) ELSE {txt('o_orderdate')} END AS mixed,
     CASE WHEN o_orderkey % 3 > 0 THEN {txt('o_orderdate')} END AS shapes FROM orders""",
)
def clean_dates_learned(t: Tables):
    """Columns with the day first, the month first, no day above 12, both orders, and several shapes with missing values."""
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    dmy, mdy = F.date_format(day, "d/M/yyyy"), F.date_format(day, "M/d/yyyy")
    texts = t.orders.select(
        "o_orderkey", dmy.alias("day_first"), F.date_format(day, "MM-dd-yyyy HH:mm:ss").alias("month_first"),
        F.when(F.dayofmonth(day) <= 12, dmy).alias("no_evidence"), F.when(key % 2 == 0, dmy).otherwise(mdy).alias("mixed"),
        F.when(key % 3 == 0, "N/A").when(key % 3 == 1, F.date_format(day, "dd.MM.yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd")).alias("shapes"),
    )
    columns = [c for c in texts.columns if c != "o_orderkey"]
    return present(learned.with_learned_dates(texts, columns).select("o_orderkey", *[F.col(c).cast("date").alias(c) for c in columns]))
