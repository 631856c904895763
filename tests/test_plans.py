"""Warehouse jobs: decisions, repeatability and order independence."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.plans import ads, daily, marts, quality, registry, staging, star, state, vault
from tidemark.schemas import CURRENCY, PRICE, TRANSACTION, struct_of
from tidemark.sinks.write import append_partition

D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def now():
    return F.lit("2024-03-10 12:00:00").cast("timestamp")


def tx_rows():
    hour = dt.timedelta(hours=1)
    return [
        ("op1", 1, 2, "430", "x", "queued", "t", 100, D1),
        ("op1", 1, 2, "430", "x", "in_progress", "t", 100, D1 + hour),
        ("op1", 1, 2, "430", "x", "done", "t", 100, D1 + 2 * hour),
        ("op2", 2, 1, "430", "y", "done", "t", -50, D1),
        ("op3", 3, 1, "440", "y", "done", "t", -5, D1),
        ("op4", 1, 4, "420", "x", "done", "t", 10, D1),
        ("op5", 1, 4, "430", "x", "done", "t", 7, D2),
        ("op6", 1, 4, "470", "x", "done", "t", 9, D2),
    ]


def rate_rows():
    return [
        (D1 - dt.timedelta(days=3), "430", "420", Decimal("1.5")),
        (D1 - dt.timedelta(days=1), "430", "420", Decimal("2.0")),
        (D2 + dt.timedelta(days=1), "430", "420", Decimal("9.0")),
        (D1, "420", "420", Decimal("1.0")),
        (D1, "430", "840", Decimal("7.0")),
        (D1, "440", "420", Decimal("3.0")),
    ]


@pytest.fixture(scope="module")
def tx(spark):
    return spark.createDataFrame(tx_rows(), TRANSACTION)


@pytest.fixture(scope="module")
def rates(spark):
    return spark.createDataFrame(rate_rows(), CURRENCY)


def test_metrics_as_of(tx, rates):
    got = {(str(r["date_update"]), r["currency_from"]): r for r in marts.daily_currency_metrics(tx, rates).collect()}
    # Only positive amounts are summed, yet every done row is counted; a
    # currency without a positive amount or without a rate has no row.
    assert set(got) == {("2024-01-01", "430"), ("2024-01-01", "420"), ("2024-01-02", "430")}
    row = got["2024-01-01", "430"]
    assert float(row["amount_total"]) == 200 and row["cnt_transactions"] == 2
    assert row["cnt_accounts_make_transactions"] == 1 and row["avg_transactions_per_account"] == 2.0
    one_day = marts.daily_currency_metrics(tx, rates, "2024-01-02").collect()
    assert [r["currency_from"] for r in one_day] == ["430"]


def test_metrics_literal(tx, rates):
    got = {(str(r["date_update"]), r["currency_from"]): float(r["amount_total"]) for r in marts.daily_currency_metrics(tx, rates, mode="literal").collect()}
    # The latest usable rate of all currencies is that of 1 January.
    assert set(got) == {("2024-01-01", "430"), ("2024-01-01", "420"), ("2024-01-02", "430")}
    assert len({v / {"430": 100, "420": 10}[k[1]] for k, v in got.items() if k[0] == "2024-01-01"}) == 1


def test_rate_per_transaction(tx, rates):
    got = {r["operation_id"]: r["currency_with_div"] for r in marts.asof_rate_per_tx(tx, rates).collect()}
    assert got["op5"] == Decimal("2.0") and got["op6"] is None and len(got) == 6


def test_hub_takes_the_earliest_row(spark, tx):
    hub = vault.load_hub(None, tx, "operation_id", now(), "s", ["amount", "transaction_dt"], "transaction_dt")
    rows = {r["operation_id"]: r for r in hub.collect()}
    assert len(rows) == 6 and rows["op1"]["transaction_dt"].replace(tzinfo=None) == D1
    assert vault.load_hub(hub, tx, "operation_id", now(), "s", ["amount"], "transaction_dt").count() == 0


def test_account_in_both_roles(tx):
    hub = vault.load_hub(None, tx, "account_number", now(), "s", roles=["account_number_from", "account_number_to"])
    assert sorted(r["account_number"] for r in hub.collect()) == [1, 2, 3, 4]


def _vault_counts(spark, root):
    names = ["h_transactions", "h_accounts", "h_countries", "h_currencies", "l_transaction_account", "l_transaction_country",
             "l_transaction_currency", "s_transaction_status", "s_currency_div"]
    return {n: spark.read.parquet(f"{root}/{n}").count() for n in names}


def test_vault_day_twice(spark, tx, rates, tmp_path):
    root = str(tmp_path / "vault")
    daily.load_vault_day(spark, tx, rates, root, "2024-01-01")
    once = _vault_counts(spark, root)
    assert once == {
        "h_transactions": 4, "h_accounts": 4, "h_countries": 2, "h_currencies": 4, "l_transaction_account": 4,
        "l_transaction_country": 4, "l_transaction_currency": 4, "s_transaction_status": 6, "s_currency_div": 3,
    }
    daily.load_vault_day(spark, tx.orderBy(F.rand(3)), rates, root, "2024-01-01")
    assert _vault_counts(spark, root) == once
    daily.load_vault_day(spark, tx, rates, root, "2024-01-02")
    assert _vault_counts(spark, root)["h_transactions"] == 6

    mart = str(tmp_path / "mart")
    for day in ("2024-01-01", "2024-01-02", "2024-01-01"):
        daily.load_currency_mart(tx, rates, mart, day)
    assert spark.read.parquet(mart).count() == 3


def test_staging_of_a_day(spark, tmp_path):
    good = {n: "1" for n in TRANSACTION.names} | {"transaction_dt": "2024-01-01 10:00:00.123"}
    rows = [
        ("1", "TRANSACTION", D1, good),
        ("2", "TRANSACTION", D1, good | {"amount": "x"}),
        ("3", "TRANSACTION", D1, good | {"more": "1"}),
        ("4", "TRANSACTION", D1, {k: v for k, v in good.items() if k != "country"}),
        ("5", "TRANSACTION", D2, good),
        ("6", "CURRENCY", D1, {n: "2024-01-01" if n == "date_update" else "1.25" for n in CURRENCY.names}),
        ("7", "TRANSACTION", D1, None),
    ]
    stored = spark.createDataFrame(rows, "object_id string, object_type string, sent_dttm timestamp, payload map<string,string>")
    as_text = stored.withColumn("payload", F.to_json("payload"))
    for messages in (stored, as_text):
        parts = staging.stage_messages(messages.filter("sent_dttm < '2024-01-02'"), "TRANSACTION")
        assert [sorted(r["object_id"] for r in p.collect()) for p in parts] == [["1"], ["2"], ["3", "4", "7"]]
    for _ in range(2):
        daily.stage_day(spark, as_text, str(tmp_path), "2024-01-01")
    ids = lambda t: sorted(r["object_id"] for r in spark.read.parquet(str(tmp_path / t)).collect())
    assert ids("transactions") == ["1"] and ids("transactions_rej") == ["2"]
    assert ids("transactions_misfit") == ["3", "4", "7"] and ids("currencies") == ["6"]


# --- prices ------------------------------------------------------------------------------


def price_rows(symbol="A", day=D1, n=3):
    return [
        (symbol, day + dt.timedelta(minutes=5 * i), *[Decimal(f"{10 + i}.5")] * 4, 5 if i else 7) for i in range(n)
    ]


def price_frame(spark, rows):
    return spark.createDataFrame(rows, struct_of({"symbol": "string", **{f.name: f.dataType for f in PRICE}}))


def test_price_change(spark):
    rows = [
        ("A", D1, Decimal(0), Decimal(9), Decimal(1), Decimal(5), 3),
        ("A", D1 + dt.timedelta(minutes=5), Decimal(4), Decimal(9), Decimal(0), Decimal(6), 3),
    ]
    bars = price_frame(spark, rows)
    row = marts.daily_price_change(bars).first()
    assert (row["price_open"], row["price_close"], row["change_per"]) == (0, 6, None)
    assert row["max_vol_time"] == row["max_price_time"] == D1 or str(row["max_vol_time"]).startswith("2024-01-01 00:00")
    literal = marts.daily_price_change(bars, literal=True).first()
    assert literal["price_close"] == 4 and "max_price_time" not in literal.asDict()


def test_prices_load(spark, tmp_path):
    root = str(tmp_path)
    first = price_frame(spark, price_rows("A") + price_rows("B"))
    daily.load_prices(spark, first, "5min", root)
    fact = lambda: spark.read.parquet(f"{root}/f_price").count()
    assert fact() == 6
    # The same day again is refused; another symbol and day are added.
    more = price_frame(spark, price_rows("A", n=4) + price_rows("A", D2) + price_rows("C", D1, 1))
    daily.load_prices(spark, more, "5min", root)
    assert fact() == 10
    ledger = spark.read.parquet(f"{root}/ledger").collect()
    assert len({r["upload_id"] for r in ledger}) == 4 and all(r["uploaded"] for r in ledger)
    symbols = spark.read.parquet(f"{root}/d_symbol_act").collect()
    assert {r["symbol_name"]: r["symbol_id"] for r in symbols} == {"A": 1, "B": 2, "C": 3}
    assert spark.read.parquet(f"{root}/d_symbol_hist").count() == 3
    mart = daily.price_mart(spark, root).collect()
    assert {(r["symbol"], r["sum_vol"]) for r in mart} == {("A", 17), ("B", 17), ("C", 7)} and len(mart) == 4

    core = star.fact_bars(*[spark.read.parquet(f"{root}/{t}") for t in ("f_price", "d_symbol_act", "d_time_serial")])
    loaded = price_frame(spark, price_rows("A") + price_rows("B") + price_rows("A", D2) + price_rows("C", D1, 1))
    assert quality.check_symbols(loaded, core).count() == 0
    assert quality.check_ohlcv(loaded, core).filter("not matches").count() == 0


def test_interrupted_load_is_taken_up_again(spark, tmp_path):
    root = str(tmp_path)
    bars = price_frame(spark, price_rows("A"))
    left_over = spark.createDataFrame([(1, D1.date(), "A", "5min", None), (2, D1.date(), "B", "5min", None)], "upload_id bigint, date date, symbol_name string, interval_name string, uploaded boolean")
    left_over.write.parquet(f"{root}/ledger")
    daily.load_prices(spark, bars, "5min", root)
    assert spark.read.parquet(f"{root}/f_price").count() == 3
    # The load whose bars did not come stays open.
    assert {r["symbol_name"]: r["uploaded"] for r in spark.read.parquet(f"{root}/ledger").collect()} == {"A": True, "B": None}


def test_fact_keeps_intervals_apart_and_lowest_upload(spark):
    ledger = spark.createDataFrame(
        [(1, "A", "5min", None), (2, "A", "5min", False), (3, "A", "15min", None), (4, "A", "5min", True)],
        "upload_id bigint, symbol_name string, interval_name string, uploaded boolean",
    )
    bar = lambda upload, price: (D1, *[Decimal(price)] * 4, 1, upload)
    stocks = spark.createDataFrame(
        [bar(2, 20), bar(1, 10), bar(3, 30), bar(4, 40)],
        struct_of({**{f.name: f.dataType for f in PRICE}, "upload_id": "bigint"}),
    )
    intervals = spark.createDataFrame([(1, "5min"), (2, "15min")], "interval_id bigint, interval_name string")
    symbols = spark.createDataFrame([(1, "A")], "symbol_id bigint, symbol_name string")
    times = spark.createDataFrame([(1, D1, 1), (2, D1, 2)], struct_of("time_serial_id bigint, time_serial_time timestamp, time_serial_interval_id bigint"))
    fact = star.load_fact_price(None, stocks, ledger, intervals, symbols, times)
    assert {(r["price_time_id"], int(r["price_open"])) for r in fact.collect()} == {(1, 10), (2, 30)}
    assert star.load_fact_price(fact, stocks, ledger, intervals, symbols, times).count() == 0


def test_two_renames(spark):
    act = spark.createDataFrame([(1, "old"), (2, "other")], "symbol_id bigint, symbol_name string")
    hist = spark.createDataFrame(
        [(1, "old", D1, None), (2, "other", D1, None)],
        struct_of("symbol_id bigint, symbol_name string, symbol_valid_from timestamp, symbol_valid_to timestamp"),
    )
    for old, new, at in (("old", "mid", D2), ("mid", "new", D2 + dt.timedelta(days=1)), ("gone", "x", D2)):
        rename = spark.createDataFrame([(old, new, at)], "old_name string, new_name string, at timestamp")
        act, hist = star.scd4_rename(act, hist, rename)
    assert {r["symbol_name"] for r in act.collect()} == {"new", "other"}
    rows = {r["symbol_name"]: r["symbol_valid_to"] is None for r in hist.collect()}
    assert rows == {"old": False, "mid": False, "new": True, "other": True}


def test_state_and_marks(spark):
    empty = spark.createDataFrame([], "workflow_key string, workflow_settings string")
    src = spark.range(1, 11)
    rows, new = state.incremental_load(src, empty, "k", "id")
    assert rows.count() == 10 and state.read_mark(new, "k", "last_loaded") == 10
    rows, again = state.incremental_load(src, new, "k", "id")
    assert rows.count() == 0 and state.read_mark(again, "k", "last_loaded") == 10


def test_status(spark):
    queue = spark.createDataFrame([(1, "no"), (2, "proceed"), (3, "proceed")], "id int, status string")
    results = spark.createDataFrame([(2, "err"), (2, "ok"), (3, "err")], "id int, status string")
    done = state.advance_status(state.claim(queue), results)
    assert {(r["id"], r["status"]) for r in done.collect()} == {(1, "proceed"), (2, "ok"), (3, "err")}


# --- registry ------------------------------------------------------------------------------


def test_bad_date_keeps_out_the_file(spark):
    parcels = spark.createDataFrame(
        [(1, "2024-02-30", None), (1, "2024-01-01", None), (2, "2024-01-01", "2024-01-02"), (3, None, None)],
        "request_file_id int, date_created string, foundation_date string",
    )
    good, log = registry.load_parcels(parcels, now())
    assert {r["request_file_id"] for r in good.collect()} == {2, 3}
    assert [(r["row"], r["description"]) for r in log.collect()] == [("1", "date_created: 2024-02-30")]


def test_links_leave_linked_rows(spark):
    day = dt.date(2023, 2, 5)
    requests = spark.createDataFrame([(9, day), (4, day), (7, dt.date(2023, 3, 1))], "request_id bigint, request_date date")
    responses = spark.createDataFrame(
        [(1, dt.date(2023, 6, 1), "a 05.02", None), (2, dt.date(2023, 6, 1), "a 05.02", 7), (3, dt.date(2023, 6, 1), "a 31.02", None),
         (4, dt.date(2023, 1, 1), "a 05.02", None), (5, dt.date(2023, 6, 1), "a", None)],
        "response_id bigint, response_date date, response_name string, response_request_id bigint",
    )
    linked = registry.link_responses(responses, requests, "2023-01-01", "2023-01-24")
    assert {r["response_id"]: r["response_request_id"] for r in linked.collect()} == {1: 4, 2: 7, 3: None, 4: None, 5: None}
    files = spark.createDataFrame(
        [(1, "коды 01.03.xlsx", dt.date(2023, 9, 1), None), (2, "x 05.02", dt.date(2023, 9, 1), 50), (3, "x", dt.date(2023, 9, 1), None)],
        "file_id int, name string, date date, response_id bigint",
    )
    assert {r["file_id"]: r["response_id"] for r in registry.link_codes(files, requests, linked).collect()} == {1: 2, 2: 50, 3: None}


def test_group_without_number_and_number_without_group(spark):
    costs = spark.createDataFrame([(1, 5, '"a"', "1,5", "2"), (1, 5, "b", None, None)], "response_file_id int, response_id int, cad_num string, cost string, upks string")
    groups = spark.createDataFrame([(5, "g1", "G"), (5, "g2", "unused")], "response_id int, id_group string, name_group string")
    members = spark.createDataFrame([(5, "a", "g1"), (6, "b", "g1"), (5, "z", "g9")], "response_id int, cad_num string, id_group string")
    got = {r["cad_num"]: (r["cost"], r["group"]) for r in registry.result_parcels(costs, groups, members).collect()}
    assert got == {"a": (Decimal("1.5"), "G"), "b": (None, None)}


# --- listings -----------------------------------------------------------------------------------

PAGE = """<h1><span itemprop="name">{name}</span></h1><span itemprop="price" content="10"></span>
<span itemprop="priceCurrency" content="RUB"></span><div data-marker="item-params"><li>{params}</li></div>
<span data-marker="item-view/item-date">{date}</span><span class="breadcrumbs-link">А · Б · В</span>{more}"""


def page(i, params="Площадь: 5 м²", date="сегодня в 10:00", kind="flat", name="n", more=""):
    return (f"https://x.example/ad_{i}", PAGE.format(params=params, date=date, name=name, more=more), kind, "place", 1)


def test_parse_ads(spark):
    rows = [
        page(1, "Общая площадь: 54,3 м²</li><li>Этаж: 12 из 16"),
        page(1, "Общая площадь: 54,3 м²</li><li>Этаж: 12 из 16"),
        page(2, kind="house", name="x" * 300),
        page(3, date="когда-то"),
        page(4, params="без размера"),
        page(5, more="Доступ ограничен"),
        page(6, more="Такой страницы нe существует"),
        ("https://x.example/none", page(7)[1], "zu", "place", 1),
        ("https://x.example/ad_8", None, "zu", "place", 1),
        page(9, kind="garage"),
    ]
    pages = spark.createDataFrame(rows, "url string, html string, kind string, locality string, section_id int")
    good, bad = ads.parse_ads(pages, now())
    found = {r["ad_id"]: r for r in good.collect()}
    assert set(found) == {1, 2, 9}
    flat, house = found[1], found[2]
    assert (flat["floor"], flat["house_floors"], flat["rooms"], flat["wall"]) == (12, 16, 0, None)
    assert (flat["square_value"], flat["category"], flat["address"], flat["x"]) == (54.3, " Б ", "Без адреса", 0.0)
    assert len(house["name"]) == 49 and house["wall"] == "" and house["floor"] is None
    assert {(r["url"][-2:], r["reason"]) for r in bad.collect()} == {
        ("_3", "no readable date"), ("_4", "no area"), ("_5", "blocked page"), ("_6", "no such page"),
        ("ne", "no ad id in the address"), ("_8", "blocked page"),
    }
    tables = ads.ad_tables(good)
    assert {k: t.count() for k, t in tables.items()} == {"flat": 1, "house": 1, "zu": 0, "garage": 1, "commercial": 0}
    again, _ = ads.parse_ads(pages, now(), known=good)
    assert again.count() == 0


def test_partition_writer_spreads_a_large_day(spark, tmp_path):
    rows = spark.range(200_000).repartition(4).select("id", F.lit(D1).alias("ts"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "100KB")
    try:
        append_partition(rows, str(tmp_path / "t"), "ts")
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "t" / "day=2024-01-01").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_partition_writer_replaces_days_without_rows_and_its_own_part(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, D1), (2, D2)], "id int, ts timestamp")
    append_partition(rows, path, "ts", part=("sent_day", "2024-01-02"))
    append_partition(rows.filter("id = 1"), path, "ts", part=("sent_day", "2024-01-03"))
    # What was sent on the 2nd is sent again, without its row of the 1st.
    append_partition(rows.filter("id = 2"), path, "ts", part=("sent_day", "2024-01-02"))
    assert sorted((r["id"], str(r["sent_day"])) for r in spark.read.parquet(path).collect()) == [(1, "2024-01-03"), (2, "2024-01-02")]
    plain = str(tmp_path / "p")
    append_partition(rows, plain, "ts")
    append_partition(rows.filter("false"), plain, "ts", days=["2024-01-01", "2024-02-02"])
    assert [r["id"] for r in spark.read.parquet(plain).collect()] == [2]


def test_links_and_satellites_join_no_hub(spark):
    tx = spark.createDataFrame(tx_rows(), TRANSACTION)
    hub = vault.load_hub(None, tx, "operation_id", now(), "src")
    accounts = vault.load_hub(None, tx, "account_number", now(), "src", roles=["account_number_from", "account_number_to"])
    refs = [
        vault.Ref(hub, "operation_id", "operation_id", "hk_transaction"),
        vault.Ref(accounts, "account_number", "account_number_from", "hk_account_from"),
    ]
    links = vault.load_link(None, tx, refs, now(), "src")
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    # Keys are those of the hubs; loading in two cuts gives the same links.
    assert {r["hk_transaction"] for r in links.collect()} == {r["hk"] for r in hub.collect()}
    part = vault.load_link(None, tx.filter("account_number_from = 1"), refs, now(), "src")
    rest = vault.load_link(part, tx, refs, now(), "src")
    assert {tuple(r) for r in part.union(rest).collect()} == {tuple(r) for r in links.collect()}
    missing = vault.load_link(None, tx, [vault.Ref(hub.filter("operation_id <> 'op1'"), *("operation_id",) * 2, "hk_transaction")], now(), "src", checked=True)
    assert missing.count() == links.select("hk_transaction").distinct().count() - 1


def test_uploads_of_other_intervals_are_loads_of_their_own(spark, tmp_path):
    bars = spark.createDataFrame([("A", D1, "1.0", "2.0", "0.5", "1.5", 7)], "symbol string, time timestamp, open string, high string, low string, close string, volume bigint")
    bars = bars.select("symbol", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in PRICE])
    for interval in ("5min", "15min", "5min"):
        daily.load_prices(spark, bars, interval, str(tmp_path))
    ledger = spark.read.parquet(str(tmp_path / "ledger")).collect()
    assert sorted(r["interval_name"] for r in ledger) == ["15min", "5min"] and all(r["uploaded"] for r in ledger)
    assert spark.read.parquet(str(tmp_path / "f_price")).count() == 2


def test_links_are_dealt_by_their_rows(spark, monkeypatch):
    """Tasks follow the number of rows, also where their keys are few bytes; repeated rows stay one link."""
    monkeypatch.setattr(vault, "LINK_ROWS", 10)
    rows = spark.range(200).selectExpr("id % 100 AS a", "id % 50 AS b").unionByName(spark.createDataFrame([(None, 1)], "a long, b long"))
    none = spark.createDataFrame([], "k long")
    links = vault.load_link(None, rows, [vault.Ref(none, "k", "a", "hk_a"), vault.Ref(none, "k", "b", "hk_b")], now(), "src")
    assert links.count() == links.select("hk").distinct().count() == 100
    assert links.select(F.spark_partition_id()).distinct().count() > 12
