"""Queries over transactions, rates, the vault and its staging."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import temporal
from tidemark.operators import aggregates as agg
from tidemark.operators import filters as flt
from tidemark.operators import joins, paging, sets
from tidemark.plans import daily, marts, staging, state, vault
from tidemark.scale import cut_lineage, scratch_path
from tidemark.schemas import CURRENCY, MESSAGE_COLUMNS, TRANSACTION
from tidemark.sinks import write
from tidemark.sinks.quarantine import copy_with_rejects, quarantine
from tidemark.sources import events as event_source
from tidemark.streaming import ingest
from workload import views
from workload.base import Registry, plain
from workload.views import sql, table

QUERIES = Registry()
query = QUERIES.query

# --- marts ----------------------------------------------------------------------

_METRICS = """
    SELECT m.day AS date_update, m.code AS currency_from, cast(m.total * {rate} AS double) AS amount_total,
           m.cnt AS cnt_transactions, cast(m.cnt AS double) / m.accounts AS avg_transactions_per_account,
           m.accounts AS cnt_accounts_make_transactions
    FROM metrics m {join}"""
# Counts take all done operations; sums and accounts only those with a positive amount, and days without any drop out.
_TOTALS = """
    SELECT transaction_dt::date AS day, currency_code AS code, count(*) AS cnt, sum(amount) FILTER (amount > 0) AS total,
           count(DISTINCT account_number_from) FILTER (amount > 0) AS accounts
    FROM tx WHERE status = 'done' GROUP BY ALL HAVING total IS NOT NULL"""


@query(
    "currency_metrics_asof",
    sql("tx rates", _METRICS.format(
        rate="r.currency_with_div",
        join="""ASOF JOIN (SELECT * FROM rates WHERE currency_code_with = '420') r
                ON r.currency_code = m.code AND r.date_update <= m.day"""), metrics=_TOTALS),
)
def currency_metrics_asof(spark, sf):
    return plain(marts.daily_currency_metrics(views.tx(spark, sf), views.rates(spark, sf)))


@query(
    "currency_metrics_literal",
    sql("tx rates", _METRICS.format(rate="l.rate", join="JOIN latest l ON list_contains(l.codes, m.code)"), metrics=_TOTALS, latest="""
        SELECT arg_max(currency_with_div, {'day': date_update, 'code': currency_code}) AS rate, list(DISTINCT currency_code) AS codes
        FROM rates JOIN (SELECT currency_code, max(transaction_dt)::date AS last_day FROM tx WHERE status = 'done' GROUP BY ALL)
             USING (currency_code)
        WHERE currency_code_with = '420' AND date_update::date <= last_day"""),
)
def currency_metrics_literal(spark, sf):
    return plain(marts.daily_currency_metrics(views.tx(spark, sf), views.rates(spark, sf), mode="literal"))


@query(
    "asof_rate_per_tx",
    sql("tx rates", """
    SELECT t.operation_id, t.currency_code, r.date_update::date AS rate_day,
           cast(r.currency_with_div AS double) AS currency_with_div
    FROM tx t ASOF LEFT JOIN (SELECT * FROM rates WHERE currency_code_with = '420') r
         ON r.currency_code = t.currency_code AND r.date_update <= date_trunc('day', t.transaction_dt)"""),
)
def asof_rate_per_tx(spark, sf):
    rated = marts.asof_rate_per_tx(views.tx(spark, sf), views.rates(spark, sf))
    return plain(rated.select("operation_id", "currency_code", "rate_day", "currency_with_div"))


@query(
    "asof_join_events",
    """SELECT e.event_id, p.event_id AS error_id, p.value AS error_value
       FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') p
            ON p.user_id = e.user_id AND p.ts <= e.ts""",
)
def asof_join_events(spark, sf):
    """The same user's latest error at or before every event, at full time resolution."""
    events = table(spark, sf, "events")
    errors = events.filter(F.col("event_type") == "error").select(
        "user_id", F.col("ts").alias("error_ts"), F.col("event_id").alias("error_id"),
        F.col("value").alias("error_value"),
    )
    found = joins.asof_join(events, errors, "user_id", "ts", "error_ts", ["error_id", "error_value"])
    return found.select("event_id", "error_id", "error_value")


# --- aggregates and windows --------------------------------------------------------

@query(
    "tx_window_count",
    sql("tx", """
    SELECT DISTINCT transaction_dt::date AS date_update, currency_code,
           count(operation_id) OVER (PARTITION BY transaction_dt::date, currency_code) AS cnt
    FROM tx WHERE status = 'done'"""),
)
def tx_window_count(spark, sf):
    days = flt.only_done(views.tx(spark, sf)).withColumn("date_update", F.to_date("transaction_dt"))
    return agg.window_count(days, ["date_update", "currency_code"], "operation_id", "cnt")


@query(
    "tx_window_count_rows",
    sql("tx", """
    SELECT operation_id, count(operation_id) OVER (PARTITION BY transaction_dt::date, currency_code) AS cnt FROM tx"""),
)
def tx_window_count_rows(spark, sf):
    days = views.tx(spark, sf).withColumn("date_update", F.to_date("transaction_dt"))
    counted = agg.window_count(days, ["date_update", "currency_code"], "operation_id", "cnt", per_row=True)
    return counted.select("operation_id", "cnt")


@query(
    "accounts_distinct",
    sql("tx", """
    SELECT transaction_dt::date AS day, currency_code, count(DISTINCT account_number_from) AS accounts
    FROM tx WHERE amount > 0 GROUP BY 1, 2"""),
)
def accounts_distinct(spark, sf):
    days = flt.positive(views.tx(spark, sf), "amount").withColumn("day", F.to_date("transaction_dt"))
    return agg.distinct_count(days, ["day", "currency_code"], "account_number_from", "accounts")


@query(
    "latest_rate",
    sql("rates", """
    SELECT currency_code, currency_code_with, cast(arg_max(currency_with_div, date_update) AS double) AS currency_with_div
    FROM rates GROUP BY 1, 2"""),
)
def latest_rate(spark, sf):
    keys = ["currency_code", "currency_code_with"]
    return plain(agg.latest_value(views.rates(spark, sf), "currency_with_div", "date_update", keys))


@query(
    "latest_rate_overall",
    sql("rates", """
    SELECT cast(currency_with_div AS double) AS rate FROM rates
    ORDER BY date_update DESC, currency_code DESC, currency_code_with DESC LIMIT 1"""),
)
def latest_rate_overall(spark, sf):
    order = F.struct("date_update", "currency_code", "currency_code_with")
    return plain(agg.latest_value(views.rates(spark, sf), "currency_with_div", order, out="rate"))


@query(
    "day_slice",
    sql("tx", "SELECT * FROM tx WHERE transaction_dt::date = DATE '1997-05-28'"),
)
def day_slice(spark, sf):
    return flt.day_slice(views.tx(spark, sf), "transaction_dt", "1997-05-28")


@query(
    "date_between",
    sql("tx", "SELECT operation_id, amount FROM tx WHERE transaction_dt::date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"),
)
def date_between(spark, sf):
    rows = views.tx(spark, sf).withColumn("day", F.to_date("transaction_dt"))
    return flt.date_between(rows, "day", "1996-01-01", "1996-12-31").select("operation_id", "amount")


@query(
    "ids_lookup",
    sql("tx", """
    SELECT operation_id, country FROM tx WHERE operation_id IN (
        SELECT cast(l_orderkey AS varchar) FROM lineitem WHERE l_returnflag = 'R')"""),
)
def ids_lookup(spark, sf):
    """Rows of the ids found in another table."""
    ids = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    ids = ids.select(F.col("l_orderkey").cast("string").alias("operation_id"))
    return flt.by_id(views.tx(spark, sf), "operation_id", ids).select("operation_id", "country")


@query(
    "distinct_rows",
    sql("tx", "SELECT DISTINCT country, currency_code, status FROM tx"),
)
def distinct_rows(spark, sf):
    return agg.distinct_rows(views.tx(spark, sf), ["country", "currency_code", "status"])


@query(
    "composite_join",
    sql("tx", """
    SELECT a.day, a.currency_code, a.cnt, b.total FROM (
        SELECT transaction_dt::date AS day, currency_code, count(*) AS cnt FROM tx GROUP BY 1, 2) a
    LEFT JOIN (SELECT transaction_dt::date AS day, currency_code, cast(sum(amount) AS bigint) AS total FROM tx
               WHERE amount > 0 GROUP BY 1, 2) b USING (day, currency_code)"""),
)
def composite_join(spark, sf):
    days = views.tx(spark, sf).withColumn("day", F.to_date("transaction_dt"))
    keys = ["day", "currency_code"]
    total = agg.totals(flt.positive(days, "amount"), keys, ["amount"]).withColumnRenamed("amount", "total")
    return joins.left_join(agg.row_counts(days, keys, "cnt"), total, keys)


@query(
    "role_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c.c_mktsegment AS buyer_c_mktsegment, s.n_name AS seller_nation,
              b.n_name AS buyer_nation
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer c ON c_custkey = o_custkey
       JOIN supplier ON s_suppkey = l_suppkey JOIN nation s ON s.n_nationkey = s_nationkey
       JOIN nation b ON b.n_nationkey = c.c_nationkey""",
)
def role_join(spark, sf):
    """One dimension joined once as the buyer's and once as the seller's."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    bought = lines.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    people = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("buyer_c_mktsegment"))
    sellers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    sides = bought.join(people, F.col("o_custkey") == F.col("c_custkey")).join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    named = joins.join_role(sides, nations, "n_nationkey", {"s_nationkey": "seller_", "c_nationkey": "buyer_"})
    return named.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "buyer_c_mktsegment", "seller_nation", "buyer_nation"
    )


@query(
    "union_roles",
    sql("tx", "SELECT account_number_from AS account_number FROM tx UNION SELECT account_number_to FROM tx"),
)
def union_roles(spark, sf):
    return sets.union_roles(views.tx(spark, sf), ["account_number_from", "account_number_to"], "account_number")


@query(
    "union_tagged",
    """SELECT 'customer' AS side, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 2 UNION ALL
       SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY 2""",
)
def union_tagged(spark, sf):
    def counts(name, key):
        return agg.row_counts(table(spark, sf, name).withColumnRenamed(key, "nation"), ["nation"], "n")

    return sets.union_tagged(
        {"customer": counts("customer", "c_nationkey"), "supplier": counts("supplier", "s_nationkey")}, "side"
    )


# --- vault ----------------------------------------------------------------------------
# Every hub, link and satellite is loaded in two rounds: the early days first,
# then everything, where only what is new may be added.

EARLY, LATE = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
CUT = "1995-01-01"
SRC = "messages"


def _early(rows, ts="transaction_dt"):
    return rows.filter(F.col(ts) < F.lit(CUT).cast("timestamp_ntz"))


def _stamp(value):
    return F.lit(value).cast("timestamp_ntz")


def _two_rounds(src, load, keys, ts="transaction_dt"):
    """Both rounds; the first is a table bucketed by its keys by the time of the second."""
    first = load(None, _early(src, ts), _stamp(EARLY))
    stored = write.append_bucketed(first, scratch_path(src.sparkSession, "vault"), first.schema, keys)
    return stored.unionByName(load(stored, src, _stamp(LATE)))


def _accounts(log):
    return _two_rounds(
        log,
        lambda target, src, at: vault.load_hub(
            target, src, "account_number", at, SRC, roles=["account_number_from", "account_number_to"]
        ),
        ["account_number"],
    )


def _countries(log):
    return _two_rounds(
        log.withColumnRenamed("country", "country_name"),
        lambda target, src, at: vault.load_hub(target, src, "country_name", at, SRC),
        ["country_name"],
    )


def _currencies(log, quotes):
    """Codes of transactions and of both sides of the rates."""
    codes = log.select(F.col("currency_code").alias("code"), F.col("transaction_dt").alias("at"))
    quoted = sets.union_roles(quotes, ["currency_code", "currency_code_with"], "code", keep=["date_update"])
    both = codes.unionByName(quoted.withColumnRenamed("date_update", "at"))
    renamed = both.withColumnRenamed("code", "currency_code")
    return _two_rounds(
        renamed, lambda target, src, at: vault.load_hub(target, src, "currency_code", at, SRC), ["currency_code"], "at"
    )


def _operations(log):
    return _two_rounds(
        log,
        lambda target, src, at: vault.load_hub(
            target, src, "operation_id", at, SRC, ["amount", "transaction_type", "transaction_dt"], "transaction_dt"
        ),
        ["operation_id"],
    )


_ROUND = f"CASE WHEN min({{ts}}) < DATE '{CUT}' THEN TIMESTAMP '{EARLY}' ELSE TIMESTAMP '{LATE}' END AS load_dt, '{SRC}' AS load_src"


@query(
    "hub_accounts",
    sql("tx tx_log", f"""
    SELECT account_number, {_ROUND.format(ts='transaction_dt')} FROM (
        SELECT account_number_from AS account_number, transaction_dt FROM tx_log UNION ALL
        SELECT account_number_to, transaction_dt FROM tx_log) GROUP BY 1"""),
)
def hub_accounts(spark, sf):
    return _accounts(views.tx_log(spark, sf)).drop("hk")


@query(
    "hub_countries",
    sql("tx tx_log", f"SELECT country AS country_name, {_ROUND.format(ts='transaction_dt')} FROM tx_log GROUP BY 1"),
)
def hub_countries(spark, sf):
    return _countries(views.tx_log(spark, sf)).drop("hk")


@query(
    "hub_currencies",
    sql("tx tx_log rates", f"""
    SELECT currency_code, {_ROUND.format(ts='seen')} FROM (
        SELECT currency_code, transaction_dt AS seen FROM tx_log UNION ALL
        SELECT currency_code, date_update FROM rates UNION ALL
        SELECT currency_code_with, date_update FROM rates) GROUP BY 1"""),
)
def hub_currencies(spark, sf):
    return _currencies(views.tx_log(spark, sf), views.rates(spark, sf)).drop("hk")


@query(
    "hub_transactions",
    sql("tx tx_log", f"""
    SELECT operation_id, any_value(amount) AS amount, any_value(transaction_type) AS transaction_type,
           min(transaction_dt) AS transaction_dt, {_ROUND.format(ts='transaction_dt')}
    FROM tx_log GROUP BY 1"""),
)
def hub_transactions(spark, sf):
    return _operations(views.tx_log(spark, sf)).drop("hk")


def _named(links, hub, key, out):
    """Put the business key in place of a hub key."""
    names = hub.select(F.col("hk").alias(out), F.col(key).alias(f"{out}_name"))
    return links.join(names, out).drop(out)


def _stored(*hubs):
    """Hubs as the tables that links and satellites find."""
    return [cut_lineage(hub, "hub") for hub in hubs]


def _tx_ref(operations):
    return vault.Ref(operations, "operation_id", "operation_id", "hk_transaction")


def _link(log, refs):
    return _two_rounds(log, lambda target, src, at: vault.load_link(target, src, refs, at, SRC), [ref.out for ref in refs])


@query(
    "link_tx_account",
    sql("tx tx_log", f"""
    SELECT operation_id AS hk_transaction_name, account_number_from AS hk_account_from_name,
           account_number_to AS hk_account_to_name, {_ROUND.format(ts='transaction_dt')}
    FROM tx_log GROUP BY 1, 2, 3"""),
)
def link_tx_account(spark, sf):
    log = views.tx_log(spark, sf)
    operations, accounts = _stored(_operations(log), _accounts(log))
    links = _link(
        log,
        [
            _tx_ref(operations),
            vault.Ref(accounts, "account_number", "account_number_from", "hk_account_from"),
            vault.Ref(accounts, "account_number", "account_number_to", "hk_account_to"),
        ],
    ).drop("hk")
    links = _named(links, operations, "operation_id", "hk_transaction")
    links = _named(links, accounts, "account_number", "hk_account_from")
    return _named(links, accounts, "account_number", "hk_account_to")


@query(
    "link_reload",
    sql("tx tx_log", "SELECT count(*) AS links, count(DISTINCT (operation_id, account_number_from, account_number_to)) AS pairs"
        " FROM (SELECT DISTINCT operation_id, account_number_from, account_number_to FROM tx_log)"),
)
def link_reload(spark, sf):
    """Loads of a part of the rows and then of all give as many links as one load."""
    log = views.tx_log(spark, sf)
    operations, accounts = _stored(_operations(log), _accounts(log))
    refs = [
        _tx_ref(operations),
        vault.Ref(accounts, "account_number", "account_number_from", "hk_account_from"),
        vault.Ref(accounts, "account_number", "account_number_to", "hk_account_to"),
    ]
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    part = vault.load_link(None, log.filter(F.pmod(F.xxhash64("account_number_to"), F.lit(2)) == 0), refs, at, SRC)
    links = part.unionByName(vault.load_link(part, log, refs, at, SRC))
    columns = ["hk_transaction", "hk_account_from", "hk_account_to"]
    return links.agg(F.count("*").alias("links"), F.count_distinct(F.struct(*columns)).alias("pairs"))


@query(
    "link_tx_country",
    sql("tx tx_log", f"""
    SELECT operation_id AS hk_transaction_name, country AS hk_country_name, {_ROUND.format(ts='transaction_dt')}
    FROM tx_log GROUP BY 1, 2"""),
)
def link_tx_country(spark, sf):
    log = views.tx_log(spark, sf)
    operations, countries = _stored(_operations(log), _countries(log))
    links = _link(log, [_tx_ref(operations), vault.Ref(countries, "country_name", "country", "hk_country")]).drop("hk")
    return _named(_named(links, operations, "operation_id", "hk_transaction"), countries, "country_name", "hk_country")


@query(
    "link_tx_currency",
    sql("tx tx_log", f"""
    SELECT operation_id AS hk_transaction_name, currency_code AS hk_currency_name, {_ROUND.format(ts='transaction_dt')}
    FROM tx_log GROUP BY 1, 2"""),
)
def link_tx_currency(spark, sf):
    log = views.tx_log(spark, sf)
    operations, currencies = _stored(_operations(log), _currencies(log, views.rates(spark, sf)))
    refs = [_tx_ref(operations), vault.Ref(currencies, "currency_code", "currency_code", "hk_currency")]
    links = _link(log, refs).drop("hk")
    return _named(_named(links, operations, "operation_id", "hk_transaction"), currencies, "currency_code", "hk_currency")


@query(
    "sat_tx_status",
    sql("tx tx_log", f"""
    SELECT operation_id AS hk_transaction_name, status, transaction_dt AS status_dt,
           {_ROUND.format(ts='transaction_dt')} FROM tx_log GROUP BY 1, 2, 3"""),
)
def sat_tx_status(spark, sf):
    log = views.tx_log(spark, sf)
    (operations,) = _stored(_operations(log))
    statuses = _two_rounds(
        log,
        lambda target, src, at: vault.load_satellite(
            target, src, [_tx_ref(operations)], {"status": "status", "transaction_dt": "status_dt"},
            ["status_dt", "status"], at, SRC,
        ),
        ["hk_transaction", "status_dt", "status"],
    )
    return _named(statuses, operations, "operation_id", "hk_transaction")


@query(
    "sat_currency_div",
    sql("rates", f"""
    SELECT currency_code AS hk_currency_name, currency_code_with AS hk_currency_with_name,
           cast(currency_with_div AS double) AS div, date_update, {_ROUND.format(ts='date_update')}
    FROM rates GROUP BY 1, 2, 3, 4"""),
)
def sat_currency_div(spark, sf):
    quotes = views.rates(spark, sf)
    (currencies,) = _stored(_currencies(views.tx_log(spark, sf), quotes))
    refs = [
        vault.Ref(currencies, "currency_code", "currency_code", "hk_currency"),
        vault.Ref(currencies, "currency_code", "currency_code_with", "hk_currency_with"),
    ]
    rows = _two_rounds(
        quotes,
        lambda target, src, at: vault.load_satellite(
            target, src, refs, {"currency_with_div": "div", "date_update": "date_update"}, ["date_update"], at, SRC
        ),
        ["hk_currency", "hk_currency_with", "date_update"],
        "date_update",
    )
    named = _named(rows, currencies, "currency_code", "hk_currency")
    return plain(_named(named, currencies, "currency_code", "hk_currency_with"))


# --- staging ------------------------------------------------------------------------------


def _of_type(spark, sf, kind):
    return views.messages(spark, sf).filter(F.col("object_type") == kind)


@query(
    "strict_payload_filter",
    sql("tx tx_log", """
    SELECT operation_id || '/' || status AS object_id FROM tx_log
    WHERE transaction_type NOT IN ('5-LOW', '1-URGENT')"""),
)
def strict_payload_filter(spark, sf):
    return staging.payload_fields(_of_type(spark, sf, "TRANSACTION"), TRANSACTION)[0].select("object_id")


@query(
    "payload_misfits",
    sql("tx tx_log", """
    SELECT operation_id || '/' || status AS object_id,
           CASE transaction_type WHEN '5-LOW' THEN 8 ELSE 10 END AS keys
    FROM tx_log WHERE transaction_type IN ('5-LOW', '1-URGENT')"""),
)
def payload_misfits(spark, sf):
    rest = staging.payload_fields(_of_type(spark, sf, "TRANSACTION"), TRANSACTION)[1]
    return rest.select("object_id", F.size("payload").alias("keys"))


@query(
    "stage_transactions",
    sql("tx tx_log", """
    SELECT operation_id || '/' || status AS object_id, * FROM tx_log
    WHERE transaction_type NOT IN ('5-LOW', '1-URGENT') AND amount >= 0"""),
)
def stage_transactions(spark, sf):
    good = staging.read_staged(spark, _staged(spark, sf)[0], "TRANSACTION")
    return good.select(
        "object_id", *[c for c in TRANSACTION.names if c != "transaction_dt"],
        F.col("transaction_dt").cast("timestamp_ntz").alias("transaction_dt"),
    )


def _staged(spark, sf):
    """Folder and numbers of all messages staged in one pass."""
    path = scratch_path(spark, "staged")
    return path, staging.stage_all(views.messages(spark, sf), path)


@query(
    "stage_currencies",
    sql("rates", """
    SELECT date_update, currency_code, currency_code_with, cast(currency_with_div AS double) AS currency_with_div FROM rates"""),
)
def stage_currencies(spark, sf):
    good = staging.read_staged(spark, _staged(spark, sf)[0], "CURRENCY")
    good = good.select(*CURRENCY.names).withColumn("date_update", F.col("date_update").cast("timestamp_ntz"))
    return plain(good)


@query(
    "stage_outcomes",
    sql("tx tx_log rates", """
    SELECT 'TRANSACTION' AS object_type, CASE WHEN transaction_type IN ('5-LOW', '1-URGENT') THEN 'misfit'
           WHEN amount < 0 THEN 'bad' ELSE 'good' END AS outcome, count(*) AS rows, count(*) AS observed FROM tx_log GROUP BY 2
    UNION ALL SELECT 'CURRENCY', 'good', count(*), count(*) FROM rates"""),
)
def stage_outcomes(spark, sf):
    """Rows of the staged table beside the numbers observed while it was written."""
    path, counts = _staged(spark, sf)
    observed = spark.createDataFrame([(*k, n) for k, n in counts.items()], "object_type string, outcome string, observed bigint")
    stored = spark.read.parquet(path).groupBy("object_type", "outcome").agg(F.count("*").alias("rows"))
    return stored.join(observed, ["object_type", "outcome"])


@query(
    "copy_with_rejects",
    sql("tx tx_log", """
    SELECT operation_id, status, 'amount: not a bigint' AS reject_reason, 'n/a' AS amount FROM tx_log
    WHERE transaction_type NOT IN ('5-LOW', '1-URGENT') AND amount < 0"""),
)
def rejected_rows(spark, sf):
    shaped, _ = staging.payload_fields(_of_type(spark, sf, "TRANSACTION"), TRANSACTION)
    _, bad = copy_with_rejects(shaped, TRANSACTION)
    return bad.select("operation_id", "status", "reject_reason", "amount")


@query(
    "reject_counts",
    sql("tx tx_log", """
    SELECT 'TRANSACTION' AS table_name, count(*) AS rejects FROM tx_log
    WHERE transaction_type NOT IN ('5-LOW', '1-URGENT') AND amount < 0
    UNION ALL SELECT 'CURRENCY', 0"""),
)
def rejects_per_table(spark, sf):
    return staging.staged_rejects(spark, _staged(spark, sf)[1])


@query(
    "quarantine_units",
    """SELECT 'orders' AS table_name, 'order without a price' AS description, 'feed' AS src,
              cast(o_custkey AS varchar) AS file_name, cast(NULL AS varchar) AS row, TIMESTAMP '2024-01-01' AS date
       FROM orders WHERE o_totalprice < 10000 GROUP BY o_custkey""",
)
def quarantine_units(spark, sf):
    """One log entry per customer with a bad order."""
    orders = table(spark, sf, "orders")
    problem = F.when(F.col("o_totalprice") < 10_000, "order without a price")
    return quarantine(
        orders, problem, "orders", "feed", _stamp("2024-01-01"), file_name=F.col("o_custkey"), unit=["o_custkey"]
    )[1]


@query(
    "quarantine_split",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (
           SELECT o_custkey FROM orders WHERE o_totalprice < 10000)""",
)
def quarantine_split(spark, sf):
    orders = table(spark, sf, "orders")
    problem = F.when(F.col("o_totalprice") < 10_000, "order without a price")
    good, _ = quarantine(orders, problem, "orders", "feed", _stamp("2024-01-01"), unit=["o_custkey"])
    return good.select("o_orderkey", "o_custkey")


@query(
    "read_messages",
    sql("tx tx_log", """
    SELECT operation_id || '/' || status AS object_id, transaction_dt AS sent_dttm FROM tx_log
    WHERE transaction_dt::date = DATE '1997-05-28'"""),
)
def read_messages(spark, sf):
    day = event_source.read_messages(views.messages(spark, sf), "1997-05-28", "TRANSACTION")
    return day.select("object_id", "sent_dttm")


_DECODED = """
    SELECT CASE WHEN event_type <> 'error' THEN cast(event_id AS varchar) END AS object_id,
           CASE WHEN event_type <> 'error' THEN event_type END AS object_type,
           CASE WHEN event_type <> 'error' THEN ts END AS sent_dttm,
           CASE WHEN event_type <> 'error' THEN '{"k":"' || (props->>'$.k') || '"}' END AS payload FROM events"""


def _decoded(spark, sf):
    rows = event_source.decode_envelope(views.envelopes(spark, sf))
    return rows.withColumn("sent_dttm", F.col("sent_dttm").cast("timestamp_ntz"))


@query("envelope_decode", _DECODED)
def envelope_decode(spark, sf):
    return _decoded(spark, sf)


@query("dropna_messages", f"SELECT * FROM ({_DECODED}) WHERE object_id IS NOT NULL")
def dropna_messages(spark, sf):
    return flt.drop_incomplete(_decoded(spark, sf), MESSAGE_COLUMNS)


# --- paging, state, idempotent writes -----------------------------------------------------


@query(
    "keyset_page",
    "SELECT * FROM orders WHERE o_orderkey > 1000 AND o_orderkey <= 6000",
)
def keyset_page(spark, sf):
    return paging.keyset_page(table(spark, sf, "orders"), "o_orderkey", 1000, 5000)


@query(
    "keyset_pages",
    """SELECT cast(floor((o_orderkey - 1) / 5000.0) AS bigint) AS page, count(*) AS rows, min(o_orderkey) AS first_id,
              max(o_orderkey) AS last_id FROM orders GROUP BY 1""",
)
def keyset_pages(spark, sf):
    """Every page of the table at once."""
    orders = table(spark, sf, "orders")
    return orders.groupBy(paging.page_of("o_orderkey", 5000).alias("page")).agg(
        F.count("*").alias("rows"), F.min("o_orderkey").alias("first_id"), F.max("o_orderkey").alias("last_id")
    )


def _state(spark, sf):
    """The stored mark of an earlier load: as many orders as there are customers."""
    marks = table(spark, sf, "customer").agg(F.count("*").alias("last_loaded"))
    return marks.select(F.lit("orders").alias(state.KEY), F.to_json(F.struct("last_loaded")).alias(state.SETTINGS))


@query(
    "vault_day",
    sql("tx", """
    SELECT 'h_transactions' AS name, count(DISTINCT operation_id) AS rows FROM d
    UNION ALL SELECT 'h_accounts', count(DISTINCT a) FROM (SELECT account_number_from AS a FROM d UNION SELECT account_number_to FROM d)
    UNION ALL SELECT 'h_countries', count(DISTINCT country) FROM d
    UNION ALL SELECT 'l_transaction_account', count(DISTINCT (operation_id, account_number_from, account_number_to)) FROM d
    UNION ALL SELECT 'l_transaction_country', count(DISTINCT (operation_id, country)) FROM d
    UNION ALL SELECT 'l_transaction_currency', count(DISTINCT (operation_id, currency_code)) FROM d
    UNION ALL SELECT 's_transaction_status', count(DISTINCT (operation_id, transaction_dt, status)) FROM d""",
        d="""SELECT * FROM tx WHERE transaction_dt::date IN
             ((SELECT min(transaction_dt)::date FROM tx), (SELECT max(transaction_dt)::date FROM tx))"""),
)
def vault_day(spark, sf):
    """The whole vault load of the first and the last day, each run twice."""
    root, tx = scratch_path(spark, "vault-day"), views.tx(spark, sf)
    days = tx.agg(F.to_date(F.min("transaction_dt")), F.to_date(F.max("transaction_dt"))).first()
    for day in (days[0], days[1], days[1]):
        daily.load_vault_day(spark, tx, views.rates(spark, sf), root, day)
    names = ["h_transactions", "h_accounts", "h_countries", "l_transaction_account", "l_transaction_country",
             "l_transaction_currency", "s_transaction_status"]
    return sets.union_tagged({n: spark.read.parquet(f"{root}/{n}").agg(F.count("*").alias("rows")) for n in names}, "name")


@query("exists_probe", "SELECT o_orderstatus, bool_or(o_totalprice > 400000) AS found FROM orders GROUP BY 1")
def exists_probe(spark, sf):
    orders = table(spark, sf, "orders")
    kinds = [r[0] for r in orders.select("o_orderstatus").distinct().collect()]
    rows = [(k, paging.exists(orders, (F.col("o_orderstatus") == k) & (F.col("o_totalprice") > 400_000))) for k in kinds]
    return spark.createDataFrame(rows, "o_orderstatus string, found boolean")


@query("after_mark", "SELECT * FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'F')")
def after_mark(spark, sf):
    orders = table(spark, sf, "orders")
    mark = orders.filter(F.col("o_orderstatus") == "F").agg(F.max("o_orderkey")).first()[0]
    return flt.after_mark(orders, "o_orderkey", mark)


@query("cluster_within", "SELECT o_orderstatus, count(*) AS rows FROM orders GROUP BY 1")
def cluster_within(spark, sf):
    """Orders stored in date order inside each file; rows out of order would be dropped by the count."""
    path = scratch_path(spark, "clustered")
    paging.cluster_within(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"]).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("_at", F.monotonically_increasing_id())
    in_file = Window.partitionBy(F.input_file_name()).orderBy("_at")
    before = F.lag(F.struct("o_orderdate", "o_orderkey")).over(in_file)
    ordered = stored.withColumn("_before", before).filter(F.col("_before").isNull() | (F.col("_before") <= F.struct("o_orderdate", "o_orderkey")))
    return ordered.groupBy("o_orderstatus").agg(F.count("*").alias("rows"))


@query("run_time", "SELECT c_custkey, TIMESTAMP '2024-03-01 05:06:07' AS load_dt FROM customer")
def run_time(spark, sf):
    stamped = table(spark, sf, "customer").select("c_custkey", temporal.run_ts("2024-03-01 05:06:07").alias("load_dt"))
    return stamped.withColumn("load_dt", F.col("load_dt").cast("timestamp_ntz"))


@query("incremental_load", "SELECT * FROM orders WHERE o_orderkey > (SELECT count(*) FROM customer)")
def incremental_load(spark, sf):
    return state.incremental_load(table(spark, sf, "orders"), _state(spark, sf), "orders", "o_orderkey")[0]


@query(
    "incremental_mark",
    """SELECT 'orders' AS workflow_key, '{"last_loaded":' || cast(max(o_orderkey) AS varchar) || '}' AS workflow_settings
       FROM orders""",
)
def incremental_mark(spark, sf):
    return state.incremental_load(table(spark, sf, "orders"), _state(spark, sf), "orders", "o_orderkey")[1]


def _states(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("workflow_key"),
        F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("workflow_settings"),
        F.struct("o_orderdate", "o_orderkey").alias("version"),
        "o_orderstatus",
    )


@query(
    "state_upsert",
    """SELECT o_custkey AS workflow_key, arg_max(o_orderkey || '|' || o_orderstatus, {'d': o_orderdate, 'k': o_orderkey}) AS workflow_settings
       FROM orders GROUP BY 1""",
)
def state_upsert(spark, sf):
    """Latest order per customer, the finished ones stored and the others coming in."""
    rows = _states(spark, sf)
    kept = ["workflow_key", "workflow_settings", "version"]
    merged = write.upsert_state(
        rows.filter(F.col("o_orderstatus") == "F").select(*kept),
        rows.filter(F.col("o_orderstatus") != "F").select(*kept),
        "workflow_key",
        "version",
    )
    return merged.drop("version")


@query(
    "insert_ignore",
    """SELECT o_custkey, o_orderpriority, min(o_orderkey) AS o_orderkey FROM orders
       WHERE o_orderstatus <> 'F' AND (o_custkey, o_orderpriority) NOT IN (
           SELECT (o_custkey, o_orderpriority) FROM orders WHERE o_orderstatus = 'F')
       GROUP BY 1, 2""",
)
def insert_ignore(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderstatus")
    fresh = write.insert_ignore(
        orders.filter(F.col("o_orderstatus") == "F"),
        orders.filter(F.col("o_orderstatus") != "F"),
        ["o_custkey", "o_orderpriority"],
        ["o_orderkey"],
    )
    return fresh.drop("o_orderstatus")


@query(
    "append_partition",
    """SELECT ts::date AS day, event_type, count(*) AS rows FROM events GROUP BY 1, 2""",
)
def append_partition(spark, sf):
    """Events written by day, and the same days written again."""
    path = scratch_path(spark, "append-partition")
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    for _ in range(2):
        write.append_partition(events, path, "ts")
    return spark.read.parquet(path).groupBy("day", "event_type").agg(F.count("*").alias("rows"))


@query(
    "append_partition_empty_rerun",
    """SELECT ts::date AS day, event_type, count(*) AS rows FROM events
       WHERE ts::date <> (SELECT min(ts)::date FROM events) GROUP BY 1, 2""",
)
def append_partition_empty_rerun(spark, sf):
    """A day whose rerun has no rows is empty afterwards."""
    path = scratch_path(spark, "append-partition")
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    write.append_partition(events, path, "ts")
    first = events.agg(F.to_date(F.min("ts"))).first()[0]
    write.append_partition(events.filter(F.lit(False)), path, "ts", days=[first])
    return spark.read.parquet(path).groupBy("day", "event_type").agg(F.count("*").alias("rows"))


@query(
    "stream_fresh_checkpoint",
    "SELECT event_type AS object_type, 2 * count(DISTINCT event_id) AS rows FROM events GROUP BY 1",
)
def stream_fresh_checkpoint(spark, sf):
    """A second stream with a checkpoint of its own adds its rows and replaces none."""
    path = scratch_path(spark, "stream-twice")
    for _ in range(2):
        _run(ingest.dedup_stream(_event_stream(spark, sf)), ingest.write_microbatch(path), spark)
    return spark.read.parquet(path).groupBy("object_type").agg(F.count("*").alias("rows"))


# --- streams ----------------------------------------------------------------------------------


def _event_stream(spark, sf):
    """Events as a stream in which every message comes twice."""
    schema = table(spark, sf, "events").schema
    # A pattern, since the table may be one file or a folder of them.
    source = event_source.read_event_files(spark, f"{sf}/event[s].parquet", schema).select(
        F.col("event_id").cast("string").alias("object_id"),
        F.col("event_type").alias("object_type"),
        F.col("ts").cast("timestamp").alias("sent_dttm"),
        F.col("props").alias("payload"),
    )
    return source.unionByName(source)


def _run(stream, sink, spark):
    query_ = ingest.start(stream, sink, scratch_path(spark, "stream-checkpoint"), interval=None)
    query_.awaitTermination()


@query(
    "stream_dedup",
    "SELECT DISTINCT cast(event_id AS varchar) AS object_id, event_type AS object_type, ts AS sent_dttm, props AS payload FROM events",
)
def stream_dedup(spark, sf):
    path = scratch_path(spark, "stream-dedup")
    _run(ingest.dedup_stream(_event_stream(spark, sf)), ingest.write_microbatch(path), spark)
    rows = spark.read.parquet(path).select(*MESSAGE_COLUMNS)
    return rows.withColumn("sent_dttm", F.col("sent_dttm").cast("timestamp_ntz"))


@query(
    "stream_fanout",
    """SELECT DISTINCT event_type AS sink, cast(event_id AS varchar) AS object_id, ts AS sent_dttm, props AS payload
       FROM events WHERE event_type <> 'error'""",
)
def stream_fanout(spark, sf):
    """All types but errors, each into its folder, in one write per batch."""
    path = scratch_path(spark, "stream-fanout")
    # A handful of types.
    kinds = [r[0] for r in table(spark, sf, "events").select("event_type").distinct().collect()]
    _run(ingest.dedup_stream(_event_stream(spark, sf)), ingest.fan_out(path, [k for k in kinds if k != "error"]), spark)
    stored = spark.read.parquet(path)
    return stored.select("sink", "object_id", F.col("sent_dttm").cast("timestamp_ntz").alias("sent_dttm"), "payload")


def _drained_twice(spark, sf, first, second, name):
    """Progress rows and table of a stream that is stopped and started again from its checkpoint; ``second`` comes in between."""
    inbox, out, checkpoint, log = (scratch_path(spark, f"stream-{name}") for _ in range(4))
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    last = F.to_date(F.lit(events.agg(F.max("ts")).first()[0]))
    with ingest.ProgressLog(spark, log):
        for part in (first, second):
            events.where(part(F.to_date("ts"), last)).write.mode("append").parquet(inbox)
            source = event_source.read_event_files(spark, inbox, events.schema).select(
                F.col("event_id").cast("string").alias("object_id"), F.col("event_type").alias("object_type"),
                F.col("ts").alias("sent_dttm"), F.col("props").alias("payload"),
            )
            ingest.start(ingest.dedup_stream(source), ingest.write_microbatch(out), checkpoint, interval=None, name=f"{name}-stream").awaitTermination()
    progress = ingest.read_progress(spark, log).where(F.col("name") == f"{name}-stream")
    return progress, spark.read.parquet(out)


@query(
    "stream_late_rows",
    """SELECT count(*) AS input_rows, count(*) FILTER (ts::date < (SELECT max(ts)::date FROM events)) AS late_rows, 2 AS runs
       FROM events""",
)
def stream_late_rows(spark, sf):
    """The last day first: all days before it come after the watermark has passed them."""
    progress, _ = _drained_twice(spark, sf, lambda day, last: day == last, lambda day, last: day < last, "late")
    return progress.agg(
        F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"), F.count_distinct("run_id").cast("int").alias("runs")
    )


@query(
    "stream_restart",
    """SELECT cast(event_id AS varchar) AS object_id, event_type AS object_type, ts AS sent_dttm, (SELECT count(*) FROM events) AS read_rows
       FROM events""",
)
def stream_restart(spark, sf):
    """Started again from its checkpoint, a stream reads only what is new and keeps what it wrote."""
    progress, rows = _drained_twice(spark, sf, lambda day, last: day < last, lambda day, last: day == last, "again")
    read = progress.agg(F.sum("input_rows").alias("read_rows"))
    return rows.select("object_id", "object_type", F.col("sent_dttm").cast("timestamp_ntz").alias("sent_dttm")).withColumn("read_rows", read.scalar())
