"""Views over the given tables that stand in for the operators' inputs.

Each view exists twice: as a DataFrame and as a SQL table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.scale import micros, packed_order, scratch_path, spread

BAR_SECONDS = 300


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def currency_of(key) -> F.Column:
    return (F.lit(410) + 10 * key).cast("string")


def tx(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    people = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "n_name", "n_regionkey"
    )
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "queued")
    return orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("operation_id"),
        F.col("o_custkey").alias("account_number_from"),
        ((F.col("o_custkey") * 31 + 7) % 1000).alias("account_number_to"),
        currency_of(F.col("n_regionkey")).alias("currency_code"),
        F.col("n_name").alias("country"),
        status.otherwise("in_progress").alias("status"),
        F.col("o_orderpriority").alias("transaction_type"),
        # Large orders stand for payments, small ones for reversals.
        (F.round(F.col("o_totalprice") * 100) - 5_000_000).cast("bigint").alias("amount"),
        F.col("o_orderdate").alias("transaction_dt"),
    )


def tx_log(spark: SparkSession, sf: str) -> DataFrame:
    """The statuses each operation went through, an hour apart."""
    steps = (
        F.when(F.col("status") == "done", F.array(F.lit("queued"), F.lit("in_progress"), F.lit("done")))
        .when(F.col("status") == "in_progress", F.array(F.lit("queued"), F.lit("in_progress")))
        .otherwise(F.array(F.lit("queued")))
    )
    base = tx(spark, sf)
    rows = base.select(*[c for c in base.columns if c != "status"], F.posexplode(steps).alias("_step", "status"))
    later = F.col("transaction_dt") + F.make_dt_interval(hours=F.col("_step"))
    return rows.withColumn("transaction_dt", later).drop("_step").select(*base.columns)


def rates(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        currency_of(F.col("l_suppkey") % 5).alias("currency_code"),
        F.when(F.col("l_returnflag") == "R", "840").otherwise("420").alias("currency_code_with"),
        F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("date_update"),
        "l_discount",
    )
    return lines.groupBy("currency_code", "currency_code_with", "date_update").agg(
        (1 + F.max("l_discount")).cast("decimal(18,6)").alias("currency_with_div")
    )


def prices(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    second = F.floor(micros(F.col("ts")) / (BAR_SECONDS * 1_000_000)).cast("bigint") * BAR_SECONDS
    price = F.col("value").cast("decimal(10,4)")
    order = packed_order(micros(F.col("ts")), F.col("event_id"))
    return (
        events.groupBy(
            F.col("event_type").alias("symbol"), F.timestamp_seconds(second).cast("timestamp_ntz").alias("time")
        )
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.count("*").alias("volume"),
        )
    )


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    """One load per symbol and day: uploaded, refused or open."""
    days = table(spark, sf, "events").select(F.col("event_type").alias("symbol_name"), F.to_date("ts").alias("date"))
    first = F.datediff("date", F.lit("2024-01-01").cast("date")).cast("bigint")
    loads = days.distinct().withColumn("upload_id", first * 1000 + F.ascii("symbol_name"))
    turn = F.dayofmonth("date") % 3
    return loads.select(
        "upload_id",
        "date",
        "symbol_name",
        F.when(F.dayofmonth("date") % 2 == 0, "5min").otherwise("15min").alias("interval_name"),
        F.when(turn == 0, F.lit(True)).when(turn == 1, F.lit(False)).alias("uploaded"),
    )


def stocks(spark: SparkSession, sf: str) -> DataFrame:
    """Bars with the id of the load that brought them."""
    loads = ledger(spark, sf).select("upload_id", F.col("symbol_name").alias("symbol"), F.col("date").alias("_day"))
    bars = prices(spark, sf).withColumn("_day", F.to_date("time"))
    return bars.join(loads, ["symbol", "_day"]).drop("_day", "symbol")


def classifier(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("value")
    )


SQL = {
    "tx": """
        SELECT cast(o_orderkey AS varchar) AS operation_id, o_custkey AS account_number_from,
               (o_custkey * 31 + 7) % 1000 AS account_number_to,
               cast(410 + 10 * n_regionkey AS varchar) AS currency_code, n_name AS country,
               CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'queued' ELSE 'in_progress' END AS status,
               o_orderpriority AS transaction_type,
               cast(round(o_totalprice * 100) - 5000000 AS bigint) AS amount, o_orderdate AS transaction_dt
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "tx_log": """
        SELECT t.* REPLACE (s.status AS status, t.transaction_dt + s.step * INTERVAL 1 HOUR AS transaction_dt)
        FROM tx t JOIN (VALUES ('queued', 0, 'queued'), ('in_progress', 0, 'queued'), ('in_progress', 1, 'in_progress'),
                               ('done', 0, 'queued'), ('done', 1, 'in_progress'), ('done', 2, 'done')
                       ) s(final, step, status) ON s.final = t.status""",
    "rates": """
        SELECT cast(410 + 10 * (l_suppkey % 5) AS varchar) AS currency_code,
               CASE WHEN l_returnflag = 'R' THEN '840' ELSE '420' END AS currency_code_with,
               date_trunc('day', l_shipdate)::timestamp AS date_update,
               cast(1 + max(l_discount) AS decimal(18, 6)) AS currency_with_div
        FROM lineitem GROUP BY 1, 2, 3""",
    "prices": """
        SELECT event_type AS symbol, time_bucket(INTERVAL 5 MINUTE, ts) AS time,
               arg_min(cast(value AS decimal(10, 4)), {'t': ts, 'i': event_id}) AS open,
               max(cast(value AS decimal(10, 4))) AS high, min(cast(value AS decimal(10, 4))) AS low,
               arg_max(cast(value AS decimal(10, 4)), {'t': ts, 'i': event_id}) AS close, count(*) AS volume
        FROM events GROUP BY 1, 2""",
    "ledger": """
        SELECT datediff('day', DATE '2024-01-01', date) * 1000 + ascii(symbol_name) AS upload_id, date, symbol_name,
               CASE WHEN day(date) % 2 = 0 THEN '5min' ELSE '15min' END AS interval_name,
               CASE day(date) % 3 WHEN 0 THEN true WHEN 1 THEN false END AS uploaded
        FROM (SELECT DISTINCT event_type AS symbol_name, ts::date AS date FROM events)""",
    "stocks": """
        SELECT p.time, p.open, p.high, p.low, p.close, p.volume, l.upload_id
        FROM prices p JOIN ledger l ON l.symbol_name = p.symbol AND l.date = p.time::date""",
    "classifier": "SELECT cast(n_nationkey AS varchar) AS code, n_name AS value FROM nation",
}


def sql(names: str, body: str, **more: str) -> str:
    """The body behind table expressions for the named views and any extra ones."""
    parts = {name: SQL[name] for name in names.split()} | more
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in parts.items())
    return f"WITH {ctes}\n{body}" if parts else body


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions and rates as stored messages; some payloads are misshapen."""
    log = tx_log(spark, sf)
    fields = [
        F.struct(F.lit(name).alias("key"), F.col(name).cast("string").alias("value"))
        for name in log.columns
        if name not in ("amount", "transaction_type")
    ]
    amount = F.when(F.col("amount") < 0, "n/a").otherwise(F.col("amount").cast("string"))
    fields.append(F.struct(F.lit("amount").alias("key"), amount.alias("value")))
    # One type of operation lacks a key, another has one too many.
    typed = F.struct(F.lit("transaction_type").alias("key"), F.col("transaction_type").alias("value"))
    extra = F.struct(F.lit("comment").alias("key"), F.lit("x").alias("value"))
    optional = (
        F.when(F.col("transaction_type") == "5-LOW", F.array().cast("array<struct<key:string,value:string>>"))
        .when(F.col("transaction_type") == "1-URGENT", F.array(typed, extra))
        .otherwise(F.array(typed))
    )
    operations = log.select(
        F.concat_ws("/", "operation_id", "status").alias("object_id"),
        F.lit("TRANSACTION").alias("object_type"),
        F.col("transaction_dt").alias("sent_dttm"),
        F.map_from_entries(F.concat(F.array(*fields), optional)).alias("payload"),
    )
    quotes = rates(spark, sf).select(
        F.concat_ws("/", "currency_code", "currency_code_with", F.date_format("date_update", "yyyy-MM-dd")).alias(
            "object_id"
        ),
        F.lit("CURRENCY").alias("object_type"),
        F.col("date_update").alias("sent_dttm"),
        F.create_map(
            *[
                x
                for name in ("date_update", "currency_code", "currency_code_with", "currency_with_div")
                for x in (F.lit(name), F.col(name).cast("string"))
            ]
        ).alias("payload"),
    )
    return operations.unionByName(quotes)


def envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Events as raw message bytes; those of errors are cut off, as on a broken link."""
    events = table(spark, sf, "events")
    payload = F.from_json("props", "map<string,string>")
    text = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("object_id"),
            F.col("event_type").alias("object_type"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("sent_dttm"),
            payload.alias("payload"),
        )
    )
    cut = F.when(F.col("event_type") == "error", F.substring(text, 1, 30)).otherwise(text)
    return events.select(cut.cast("binary").alias("value"))


def _cells(*columns) -> F.Column:
    return F.array(*[c if isinstance(c, F.Column) else F.lit(c).cast("string") for c in columns])


def code_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Cell rows of workbooks of codes: one per nation, a sheet per half of its suppliers.

    Every fifth workbook starts with its header, the others with two rows of preamble.
    """
    suppliers = table(spark, sf, "supplier").select(
        F.concat(F.lit("codes_"), F.col("s_nationkey").cast("string"), F.lit(".xlsx")).alias("file"),
        F.when(F.col("s_suppkey") % 2 == 0, "ОКС").otherwise("ЗУ").alias("sheet"),
        "s_nationkey",
        "s_suppkey",
        "s_acctbal",
        "s_name",
    )
    number = F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("05:"), F.col("s_suppkey").cast("string")))
    data = suppliers.select(
        "file", "sheet", (F.col("s_suppkey") + 10).cast("int").alias("row_no"),
        _cells(F.col("s_suppkey").cast("string"), number, F.col("s_nationkey").cast("string"), F.col("s_name"), "again").alias("cells"),
    )
    sheets = suppliers.select("file", "sheet", "s_nationkey").distinct()
    key = F.when(F.col("sheet") == "ОКС", "Кадастровый № ОКС").otherwise("Кад №")
    header = sheets.select("file", "sheet", F.lit(2).alias("row_no"), _cells("№", key, "код", None, "Код").alias("cells"))
    preamble = sheets.filter(F.col("s_nationkey") % 5 != 0).select(
        "file", "sheet", F.explode(F.array(F.lit(0), F.lit(1))).alias("row_no"), _cells("List", None, None, None, None).alias("cells")
    )
    return data.unionByName(header).unionByName(preamble)


def act_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Cell rows of acts: accepted customers on sheet II, refused ones on sheet III."""
    people = table(spark, sf, "customer").select(
        F.concat(F.lit("act_"), F.col("c_nationkey").cast("string"), F.lit(".ods")).alias("file"),
        F.when(F.col("c_acctbal") >= 0, "II").otherwise("III").alias("sheet"),
        "c_custkey", "c_nationkey", "c_mktsegment",
    )
    first = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey").cast("string"))
    data = people.select(
        "file", "sheet", (F.col("c_custkey") + 10).cast("int").alias("row_no"), _cells(first, F.col("c_mktsegment")).alias("cells"),
        "c_nationkey",
    )
    # Both sheets of an act have a header; some refuse nobody.
    data = data.filter((F.col("sheet") == "II") | (F.col("c_nationkey") % 7 != 1)).drop("c_nationkey")
    sheets = people.select("file", "c_nationkey").distinct().withColumn("sheet", F.explode(F.array(F.lit("II"), F.lit("III"))))
    header = sheets.select("file", "sheet", F.lit(2).alias("row_no"), _cells("№", "segment").alias("cells"))
    preamble = sheets.filter(F.col("c_nationkey") % 5 != 0).select(
        "file", "sheet", F.lit(0).alias("row_no"), _cells("Act", None).alias("cells")
    )
    return data.unionByName(header).unionByName(preamble)


def _part_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Largest quantity of each line number of a part, one column per number."""
    lines = table(spark, sf, "lineitem")
    return lines.groupBy("l_partkey").agg(
        *[
            F.max(F.when(F.col("l_linenumber") == n, F.col("l_quantity").cast("int"))).alias(f"k{n}")
            for n in range(1, 8)
        ]
    )


def _attr(name: str, column) -> F.Column:
    return F.concat(F.lit(f' {name}="'), column.cast("string"), F.lit('"'))


def _tag(name: str, content, *attrs) -> F.Column:
    """An element, or nothing where its content or an attribute is NULL."""
    text = F.concat(F.lit(f"<{name}"), *attrs, F.lit(">"), content, F.lit(f"</{name}>"))
    return F.coalesce(text, F.lit(""))


def _part_objects(spark: SparkSession, sf: str) -> DataFrame:
    """(p_partkey, construction, plot): two objects of every part."""
    parts = table(spark, sf, "part")
    joined = parts.join(_part_lines(spark, sf), F.col("p_partkey") == F.col("l_partkey"), "left")
    rows = spread(joined, "p_partkey", rows=parts.count())
    key, size = F.col("p_partkey"), F.col("p_size")
    text = lambda c: F.col(c).cast("string")
    parameters = F.concat(
        *[_tag("KeyParameter", F.lit(""), _attr("Type", F.lit(f"0{n}")), _attr("Value", F.col(f"k{n}"))) for n in range(1, 8)]
    )
    location = _tag(
        "Location",
        F.concat(
            _tag("FIAS", F.concat(F.lit("f-"), key.cast("string"))),
            _tag("Note", F.concat(F.lit("near\t"), F.col("p_name"))),
            _tag("District", F.lit(""), _attr("Type", F.lit("р-н")), _attr("Name", F.col("p_brand"))),
            _tag("Street", F.lit(""), _attr("Type", F.lit("ул")), _attr("Name", F.col("p_type"))),
            _tag("Level1", F.lit(""), _attr("Type", F.lit("д")), _attr("Value", size)),
            _tag("Level2", F.lit(""), _attr("Type", F.lit("корп")), _attr("Value", F.when(size > 25, size))),
        ),
    )
    construction = _tag(
        "Construction",
        F.concat(
            _tag("CadastralBlock", F.concat(F.lit("05:"), size.cast("string"))),
            _tag("ObjectType", size.cast("string")),
            _tag("Name", F.col("p_name")),
            location,
            _tag("AssignationName", F.concat(F.lit(" "), size.cast("string"), F.lit(" "))),
            _tag("Area", text("p_retailprice")),
            _tag(
                "ElementsConstruct",
                F.concat(
                    _tag("Material", F.lit(""), _attr("Wall", size)),
                    _tag("Material", F.lit(""), _attr("Wall", F.when(size % 2 == 0, key % 30))),
                ),
            ),
            _tag("KeyParameters", F.nullif(parameters, F.lit(""))),
            _tag("ExploitationChar", F.lit(""), _attr("YearBuilt", 1950 + size), _attr("YearUsed", 1951 + size)),
        ),
        _attr("CadastralNumber", F.concat_ws(":", F.lit("05"), key.cast("string"), F.lit("1"))),
        _attr("DateCreated", F.when(size == 13, "2020-02-31").otherwise("2020-02-03")),
    )
    inner = F.concat(
        _tag("FIAS", F.concat(F.lit("g-"), key.cast("string"))),
        _tag("OKATO", size.cast("string")),
        _tag("Note", F.concat(F.lit("by "), F.col("p_brand"))),
        _tag("Street", F.lit(""), _attr("Type", F.lit("ул")), _attr("Name", F.col("p_type"))),
        _tag("Level3", F.lit(""), _attr("Type", F.lit("стр")), _attr("Value", size)),
        _tag("Other", F.lit("край")),
    )
    plot = _tag(
        "Parcel",
        F.concat(
            _tag("Location", _tag("Address", inner)),
            _tag("Category", size.cast("string")),
            _tag("Area", _tag("Area", size.cast("string"))),
            _tag("Utilization", F.lit(""), _attr("Utilization", key % 30), _attr("ByDoc", F.col("p_type"))),
            _tag("ObjectPermittedUses", F.concat(_tag("ObjectPermittedUse", F.col("p_type")), _tag("ObjectPermittedUse", F.col("p_brand")))),
            _tag("InnerCadastralNumbers", _tag("CadastralNumber", F.concat_ws(":", F.lit("05"), key.cast("string"), F.lit("1")))),
            _tag("CadastralCost", F.lit(""), _attr("Value", F.col("p_retailprice"))),
        ),
        _attr("CadastralNumber", F.concat_ws(":", F.lit("05"), key.cast("string"), F.lit("2"))),
    )
    return rows.select("p_partkey", construction.alias("construction"), plot.alias("plot"))


def _document(constructions, plots, quantity) -> F.Column:
    body = F.concat(_tag("Constructions", constructions), F.lit("\r\n"), _tag("Parcels", plots), F.lit("<Flats/>"))
    return F.concat(
        F.lit('﻿<?xml version="1.0" encoding="UTF-8"?>\n<ListForRating><ListInfo DateForm="2023-05-06" Quantity="'),
        quantity.cast("string"), F.lit('"/>'), _tag("Objects", body), F.lit("</ListForRating>"),
    )


def registry_texts(spark: SparkSession, sf: str) -> DataFrame:
    """One registry document per part: a construction and a plot."""
    document = _document(F.col("construction"), F.col("plot"), F.lit(2))
    return _part_objects(spark, sf).select(F.col("p_partkey").alias("request_file_id"), document.alias("text"))


# Parts of one registry file.
FILE_PARTS = 40
# Files that one task writes: their number costs, not their size.
FILES_PER_TASK = 100


def registry_folder(spark: SparkSession, sf: str) -> str:
    """A folder of registry files of ``FILE_PARTS`` parts, as ``request=<number>/part-….txt``.

    Of eleven files in a row one ends within its first construction and one
    has a plot whose location is not closed.
    """
    number = F.floor(F.col("p_partkey") / FILE_PARTS).alias("request")
    listed = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", c))), lambda o: o[c])
    files = _part_objects(spark, sf).groupBy(number).agg(listed("construction").alias("c"), listed("plot").alias("p"), F.count("*").alias("n"))
    plots = F.array_join("p", "")
    plots = F.when(F.col("request") % 11 == 5, F.replace(plots, F.lit("</Location>"), F.lit(""))).otherwise(plots)
    text = _document(F.array_join("c", ""), plots, F.col("n") * 2)
    text = F.when(F.col("request") % 11 == 3, F.substring_index(text, "</Construction>", 1)).otherwise(text)
    folder = scratch_path(spark, "registry")
    rows = 1 + table(spark, sf, "part").count() // FILE_PARTS
    spread(files.select("request", text.alias("value")), "request", rows=rows, per_task=FILES_PER_TASK).write.partitionBy("request").text(folder)
    return folder


def registry_records(spark: SparkSession, sf: str) -> DataFrame:
    """Sheet rows of suppliers as header -> cell, with changing header names."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    number = F.concat_ws(":", F.lit("07"), key.cast("string"))
    pairs = [
        ("КАД №", F.when(key % 2 == 0, number)),
        ("КАДАСТРОВЫЙ № ОКС", number),
        ("АДРЕС 1", F.col("s_name")),
        ("КОД КАТЕГОРИИ", (key % 30).cast("string")),
        ("НАЗНАЧЕНИЕ ТЕКСТ", nation.cast("string")),
        ("ВИД ОБЪЕКТА", F.lit("building")),
        ("ПЛОЩАДЬ ОКС", key.cast("string")),
        ("МАТЕРИАЛ СТЕН", F.when(key % 3 == 0, F.concat(F.lit(" "), nation.cast("string")))),
        ("КОД МАТЕРИАЛА СТЕН ОКС", (key % 30).cast("string")),
        ("ОБЪЕМ ОКС", F.when(key % 2 == 0, "7")),
        ("ОБЪЕМ", F.lit("8")),
    ]
    record = F.create_map(*[x for name, value in pairs for x in (F.lit(name), value)])
    return table(spark, sf, "supplier").select(
        (-1 - key).alias("request_file_id"), F.lit('{"@DateForm":"2023-07-08"}').alias("options"), record.alias("record")
    )


def document_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of every document."""
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


SQL |= {
    "code_sheets": """
        SELECT *, 'codes_' || s_nationkey || '.xlsx' AS file, CASE WHEN s_suppkey % 2 = 0 THEN 'ОКС' ELSE 'ЗУ' END AS sheet,
               cast(s_suppkey + 10 AS integer) AS row_no, CASE WHEN s_acctbal >= 0 THEN '05:' || s_suppkey END AS cad_num
        FROM supplier""",
    "part_lines": """
        SELECT p.*, k.* EXCLUDE (l_partkey) FROM part p LEFT JOIN (
            SELECT l_partkey, """ + ", ".join(
        f"max(cast(l_quantity AS integer)) FILTER (l_linenumber = {n}) AS k{n}" for n in range(1, 8)
    ) + """ FROM lineitem GROUP BY 1) k ON l_partkey = p_partkey""",
    "document_lines": """
        SELECT doc_id, cast(line_no - 1 AS integer) AS line_no, lines[line_no] AS line FROM (
            SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS line_no
            FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""",
}


NOW = "2024-03-10 12:00:00"
# Kinds of listings in turn.
AD_KINDS = ["flat", "house", "zu", "garage", "commercial"]


def ad_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A listing page per part, of changing kind and completeness."""
    key, size = F.col("p_partkey"), F.col("p_size")
    number = key.cast("string")
    kind = F.element_at(F.array(*[F.lit(k) for k in AD_KINDS]), (size % 5 + 1).cast("int"))
    date = (
        F.when(size % 4 == 0, "сегодня в 09:05")
        .when(size % 4 == 1, F.concat(F.lit("№ "), number, F.lit(" · вчера в 18:30")))
        .when(size % 4 == 2, "5 мая в 10:15")
        .when(size > 40, "давно")
        .otherwise("2 февраля в 07:00")
    )
    area = F.concat((size + 10).cast("string"), F.lit(",5 м²"))
    item = lambda label, value: F.concat(F.lit(f"<li><span>{label}</span>: "), value, F.lit("</li>"))
    params = (
        F.when(size % 5 == 0, F.concat(
            item("Количество комнат", (size % 3 + 1).cast("string")), item("Общая площадь", area),
            item("Этаж", F.concat((size % 20 + 1).cast("string"), F.lit(" из 25"))), item("Тип дома", F.lit("кирпичный")),
        ))
        .when(size % 5 == 1, F.concat(
            item("Площадь дома", area), item("Площадь участка", F.lit("6 сот.")), item("Этажей в доме", F.lit("2")),
            item("Материал стен", F.lit("брус")), item("Расстояние до города", F.lit("в черте города")),
        ))
        .when(size % 5 == 2, F.concat(item("Площадь", area), item("Расстояние до города", F.lit("7 км"))))
        .otherwise(item("Площадь", area))
    )
    html = F.concat(
        F.lit('<html><head><title>x</title><script>var a="<div>";</script></head><body><h1><span itemprop="name">'),
        F.col("p_name"), F.lit(" &amp; co</span></h1>"),
        F.when(size % 7 != 0, F.concat(F.lit('<div itemprop="address">\n  '), F.col("p_brand"), F.lit("\n</div>"))).otherwise(""),
        F.lit('<div><span class="js price-value-string">'), size.cast("string"), F.lit(' 000 ₽</span><span itemprop="price" content="'),
        F.col("p_retailprice").cast("string"), F.lit('"></span><span itemprop="priceCurrency" content="RUB"></span></div>'),
        F.when(size % 6 != 0, F.lit('<div class="map" data-map-lat="42.98" data-map-lon="47.5"><br></div>')).otherwise(""),
        F.when(size % 9 != 0, F.lit('<div itemprop="description"><p>One</p><p>two <b>three</b></p></div>')).otherwise(""),
        F.lit('<div data-marker="item-view/item-params"><ul>'), params,
        F.lit('</ul></div><div><span class="breadcrumbs-link">Все · Недвижимость · Продажа · </span></div>'),
        F.lit('<span data-marker="item-view/item-date">'), date, F.lit("</span></body></html>"),
    )
    html = F.when(size == 33, F.concat(html, F.lit("Доступ ограничен"))).otherwise(html)
    return spread(table(spark, sf, "part"), "p_partkey").select(
        F.concat(F.lit("https://ads.example/x/item_"), number).alias("url"), html.alias("html"), kind.alias("kind"),
        F.col("p_type").alias("locality"), F.lit(7).alias("section_id"),
    )
