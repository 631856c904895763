"""Queries over pages, listings and their queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import temporal, text
from tidemark.operators import filters as flt
from tidemark.operators import joins
from tidemark.operators.aggregates import row_counts
from tidemark.operators.sets import union_tagged
from tidemark.plans import ads, state
from tidemark.scale import scratch_path
from tidemark.sinks.write import write_by_kind
from tidemark.sources import pages
from workload import views
from workload.base import Registry
from workload.views import sql, table

QUERIES = Registry()
query = QUERIES.query

def _now():
    return F.lit(views.NOW).cast("timestamp")


_LINKS = """SELECT page_id, regexp_extract(anchor, '\\bhref="([^"]+)"', 1) AS link
    FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*>')) AS anchor FROM pages)
    WHERE regexp_extract(anchor, '\\bhref="([^"]+)"', 1) <> ''"""


@query("page_links", _LINKS)
def page_links(spark, sf):
    return pages.list_links(table(spark, sf, "pages").select("page_id", "html"))


@query("page_language", """SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang FROM pages""")
def page_language(spark, sf):
    lang = pages.attribute_of("html", "html", "lang")
    return table(spark, sf, "pages").select("page_id", F.coalesce(lang, F.lit("")).alias("lang"))


@query(
    "blocked_page_filter",
    """SELECT page_id FROM pages WHERE NOT (contains(url, '#top') OR contains(url, 'ref=x')
       OR contains(html, 'lang="de"') OR contains(html, '"error":'))""",
)
def blocked_page_filter(spark, sf):
    kept = flt.not_blocked(table(spark, sf, "pages"), ["#top", "ref=x"], ['lang="de"', '"error":'])
    return kept.select("page_id")


@query(
    "phrase_flags",
    """SELECT page_id, contains(html, 'https://') OR contains(html, 'nav') AS has_nav,
              contains(html, 'Такой страницы') AS missing FROM pages""",
)
def phrase_flags(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", flt.has_phrase("html", ["https://", "nav"]).alias("has_nav"),
        flt.has_phrase("html", ["Такой страницы"]).alias("missing"),
    )


@query(
    "exclude_category",
    """SELECT doc_id FROM documents WHERE NOT (contains(lower(text), 'the') OR contains(lower(text), 'une'))""",
)
def exclude_category(spark, sf):
    return flt.exclude_category(table(spark, sf, "documents"), "text", ["the", "une"]).select("doc_id")


@query(
    "url_tail_id",
    """SELECT page_id, try_cast(nullif(regexp_extract(replace(url, '/', '_'), '_(\\d+)$', 1), '') AS bigint) AS tail FROM pages""",
)
def url_tail_id(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.url_tail_id(F.translate("url", "/", "_")).alias("tail"))


# Categories of listings, one per part type.
def _category(column):
    names = ["Земельные участки", "Купить квартиру", "Вторичка", "Дома, дачи", "Гаражи", "Коммерческая", "Прочее"]
    return F.element_at(F.array(*[F.lit(n) for n in names]), (F.col(column) % 7 + 1).cast("int"))


@query(
    "category_kind_route",
    """SELECT CASE p_size % 7 WHEN 0 THEN 'zu' WHEN 1 THEN 'flat' WHEN 2 THEN 'flat' WHEN 3 THEN 'house' WHEN 4 THEN 'garage'
              WHEN 5 THEN 'commercial' END AS kind, count(*) AS parts FROM part GROUP BY 1""",
)
def category_kind_route(spark, sf):
    kinds = table(spark, sf, "part").select(ads.kind_of(_category("p_size")).alias("kind"))
    return row_counts(kinds, ["kind"], "parts")


@query(
    "relative_dates",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN TIMESTAMP '2024-03-10 00:00:00' + to_minutes(o_custkey % 1440)
              WHEN 1 THEN TIMESTAMP '2024-03-09 00:00:00' + to_minutes(o_custkey % 1440)
              WHEN 2 THEN make_timestamp(CASE WHEN strftime(o_orderdate, '%m%d') > '0310' THEN 2023 ELSE 2024 END,
                                         month(o_orderdate), day(o_orderdate), 0, 0, 0) + to_minutes(o_custkey % 1440)
              END AS at
       FROM orders""",
)
def relative_dates(spark, sf):
    month_names = [m for m in temporal.MONTHS if m != "майя"]
    minutes = F.col("o_custkey") % 1440
    clock = F.format_string("%02d:%02d", F.floor(minutes / 60), minutes % 60)
    month = F.element_at(F.array(*[F.lit(m) for m in month_names]), F.month("o_orderdate"))
    written = (
        F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("сегодня в "), clock))
        .when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("вчера в "), clock))
        .when(F.col("o_orderkey") % 4 == 2, F.concat(F.dayofmonth("o_orderdate").cast("string"), F.lit(" "), month, F.lit(" в "), clock))
        .otherwise("на днях")
    )
    return table(spark, sf, "orders").select("o_orderkey", temporal.relative_ts(written, _now()).cast("timestamp_ntz").alias("at"))


def _other(spark, sf):
    """Attribute text as it comes from a page: labels and values on lines."""
    size = F.col("p_size").cast("string")
    written = F.concat(
        F.lit("Этаж: "), size, F.lit(" из 52\nТип дома: Панельный;Количество комнат: "), (F.col("p_size") % 6).cast("string"),
        F.lit("\nМатериал стен: Кирпич\nРасстояние до города: "), F.col("p_brand"), F.lit("\nЭтажей в доме: 3\nОбщая площадь: "),
        size, F.when(F.col("p_size") % 2 == 0, ",5").otherwise(""), F.lit(" м²\nПлощадь участка: 6 сот.\nВсе · "), F.col("p_type"), F.lit(" · Купить"),
    )
    return table(spark, sf, "part").select("p_partkey", written.alias("written")).withColumn("other", text.join_segments("written"))


@query(
    "ad_attributes",
    """SELECT p_partkey, cast(p_size AS integer) AS floor, 52 AS house_floors, 'панельный' AS house_type,
              cast(p_size % 6 AS integer) AS rooms, 'кирпич' AS wall, lower(p_brand) AS to_city, 3 AS floors, '6 сот.' AS square_zu
       FROM part""",
)
def ad_attributes(spark, sf):
    columns = ads.ad_attributes("other")
    return _other(spark, sf).select("p_partkey", *[c.alias(n) for n, c in columns.items()])


@query(
    "area_split",
    """SELECT p_partkey, 'площадь: ' || p_size || CASE WHEN p_size % 2 = 0 THEN ',5' ELSE '' END || ' м² ' AS square_original,
              p_size + CASE WHEN p_size % 2 = 0 THEN 0.5::double ELSE 0 END AS square_value, ' м² ' AS square_unit FROM part""",
)
def area_split(spark, sf):
    rows = _other(spark, sf).withColumn("square_original", ads.square_of("other"))
    value, unit = text.split_number_unit("square_original")
    return rows.select("p_partkey", "square_original", value.alias("square_value"), unit.alias("square_unit"))


@query(
    "text_segments",
    """SELECT p_partkey, p_type AS middle, substr(p_name || ' ' || p_brand, 1, 9) AS cut,
              lower(p_name || ' | ' || p_brand || ' | ' || p_type) || ' |' AS joined FROM part""",
)
def text_segments(spark, sf):
    crumbs = F.concat(F.lit("Все·"), "p_type", F.lit("·Купить"))
    return table(spark, sf, "part").select(
        "p_partkey", text.segment(crumbs, "·", -2).alias("middle"), text.truncate(F.concat_ws(" ", "p_name", "p_brand"), 10).alias("cut"),
        text.join_segments(F.concat("p_name", F.lit("\n"), "p_brand", F.lit(";"), "p_type")).alias("joined"),
    )


# --- pages to ads ---------------------------------------------------------------------------


_AD_ROWS = """
    SELECT p_size % 5 AS k, p_partkey AS ad_id, p_size,
           CASE p_size % 4 WHEN 0 THEN TIMESTAMP '2024-03-10 09:05:00' WHEN 1 THEN TIMESTAMP '2024-03-09 18:30:00'
                WHEN 2 THEN TIMESTAMP '2023-05-05 10:15:00'
                ELSE CASE WHEN p_size <= 40 THEN TIMESTAMP '2024-02-02 07:00:00' END END AS time_stamp,
           p_name || ' & co' AS name, CASE WHEN p_size % 7 <> 0 THEN p_brand ELSE 'Без адреса' END AS address,
           p_retailprice AS price_value, 'RUB' AS price_currency, p_size || ' 000 ₽' AS price_original,
           CASE WHEN p_size % 6 <> 0 THEN 42.98 ELSE 0 END::double AS x, CASE WHEN p_size % 6 <> 0 THEN 47.5 ELSE 0 END::double AS y,
           p_size + 10.5::double AS square_value, ' м² ' AS square_currency,
           CASE WHEN p_size % 5 = 1 THEN 'площадь дома: ' ELSE 'площадь: ' END || (p_size + 10) || ',5 м² ' AS square_original,
           CASE WHEN p_size % 9 <> 0 THEN 'One' || chr(10) || 'two three' ELSE 'Нет описаня' END AS description,
           'https://ads.example/x/item_' || p_partkey AS url, '' AS phone, p_partkey || '.png' AS screenshot_file,
           ' Продажа ' AS category, p_type AS locality, 7 AS section_id FROM part"""
_GOOD = "time_stamp IS NOT NULL AND p_size <> 33"
_KIND = "CASE k WHEN 0 THEN 'flat' WHEN 1 THEN 'house' WHEN 2 THEN 'zu' WHEN 3 THEN 'garage' ELSE 'commercial' END"


def _ads(spark, sf):
    return ads.parse_ads(views.ad_pages(spark, sf), _now())


@query(
    "parse_ads",
    sql("", f"""
    SELECT {_KIND} AS kind, * EXCLUDE (k, p_size),
           CASE k WHEN 0 THEN cast(p_size % 20 + 1 AS integer) END AS floor, CASE k WHEN 0 THEN 25 END AS house_floors,
           CASE k WHEN 0 THEN cast(p_size % 3 + 1 AS integer) END AS rooms, CASE k WHEN 0 THEN 'кирпичный' END AS house_type,
           CASE k WHEN 1 THEN 'брус' END AS wall, CASE k WHEN 1 THEN 'в черте города' WHEN 2 THEN '7 км' END AS to_city,
           CASE k WHEN 1 THEN 2 END AS floors, CASE k WHEN 1 THEN '6 сот.' END AS square_zu
    FROM ads WHERE {_GOOD}""", ads=_AD_ROWS),
)
def parse_ads(spark, sf):
    good, _ = _ads(spark, sf)
    return good.drop("other").withColumn("time_stamp", F.col("time_stamp").cast("timestamp_ntz"))


@query(
    "ad_rejects",
    sql("", f"""
    SELECT url, {_KIND} AS kind, CASE WHEN p_size = 33 THEN 'blocked page' ELSE 'no readable date' END AS reason
    FROM ads WHERE NOT ({_GOOD})""", ads=_AD_ROWS),
)
def ad_rejects(spark, sf):
    return _ads(spark, sf)[1]


@query(
    "ads_by_kind",
    sql("", f"""
    SELECT {_KIND} AS kind, count(*) AS ads, cast(sum(square_value) AS double) AS square,
           CASE k WHEN 0 THEN 24 WHEN 1 THEN 24 WHEN 2 THEN 21 ELSE 20 END AS columns
    FROM ads WHERE {_GOOD} GROUP BY k""", ads=_AD_ROWS),
)
def ads_by_kind(spark, sf):
    """The five tables that the ads are routed to."""
    good, _ = _ads(spark, sf)
    path = scratch_path(spark, "ads-by-kind")
    write_by_kind(good, path)
    tables = ads.ad_tables(spark.read.parquet(path))
    summary = {
        kind: rows.agg(F.count("*").alias("ads"), F.sum("square_value").alias("square"), F.lit(len(rows.columns)).alias("columns"))
        for kind, rows in tables.items()
    }
    return union_tagged(summary, "kind")


def _listing_pages(spark, sf):
    """Real pages with two marked links to ads added at the end."""
    key = F.col("page_id")
    link = lambda n: F.concat(
        F.lit('<a class="x" data-marker="item-title" href="/ads/one_'), n.cast("string"), F.lit('">x</a>')
    )
    return table(spark, sf, "pages").select(
        F.concat("html", link(key * 2), link((key * 2 + 1) % 100), F.lit('<a data-marker="item-title" href="/ads/none">y</a>')).alias("html"),
        F.when(key % 5 == 0, "Снять квартиру").otherwise(_category("page_id")).alias("category"),
        F.lit("place").alias("locality"),
        F.lit(3).alias("section_id"),
    )


@query(
    "discover_ads",
    """SELECT DISTINCT ON (ad_id) '/ads/one_' || ad_id AS url, ad_id, 'no' AS status,
              CASE page_id % 7 WHEN 0 THEN 'zu' WHEN 1 THEN 'flat' WHEN 2 THEN 'flat' WHEN 3 THEN 'house' WHEN 4 THEN 'garage'
                   WHEN 5 THEN 'commercial' END AS kind, 'place' AS locality, DATE '2024-03-10' AS time_stamp, 3 AS section_id
       FROM (SELECT page_id, unnest([page_id * 2, (page_id * 2 + 1) % 100]) AS ad_id FROM pages WHERE page_id % 5 <> 0)
       ORDER BY ad_id, kind NULLS FIRST""",
)
def discover_ads(spark, sf):
    return ads.discover_ads(_listing_pages(spark, sf), F.lit("2024-03-10").cast("date"))


@query(
    "known_ads_skipped",
    """SELECT o_orderkey, o_custkey FROM orders WHERE (o_custkey, o_orderdate) NOT IN (
           SELECT (o_custkey, o_orderdate) FROM orders WHERE o_orderstatus = 'F')""",
)
def known_ads_skipped(spark, sf):
    """Rows whose (id, date) is not known yet."""
    orders = table(spark, sf, "orders")
    return joins.only_new(orders, orders, ["o_custkey", "o_orderdate"], F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")


# --- queue --------------------------------------------------------------------------------------


def _queue(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "no").otherwise("proceed")
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), status.alias("status"))


_QUEUE = """SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'no' ELSE 'proceed' END AS status FROM orders"""


@query("status_claim", f"SELECT id, CASE status WHEN 'no' THEN 'proceed' ELSE status END AS status FROM ({_QUEUE})")
def status_claim(spark, sf):
    return state.claim(_queue(spark, sf))


@query(
    "status_advance",
    f"""SELECT id, coalesce(r.status, q.status) AS status FROM ({_QUEUE}) q LEFT JOIN (
            SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 'err' ELSE 'ok' END) AS status
            FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1) r ON l_orderkey = id""",
)
def status_advance(spark, sf):
    lines = table(spark, sf, "lineitem").filter(F.col("l_returnflag") != "N")
    results = lines.select(F.col("l_orderkey").alias("id"), F.when(F.col("l_returnflag") == "R", "err").otherwise("ok").alias("status"))
    return state.advance_status(_queue(spark, sf), results)


@query(
    "session_finish",
    """SELECT r_regionkey, CASE WHEN r_name = 'ASIA' THEN 'exported' ELSE 'execute' END AS status FROM region""",
)
def session_finish(spark, sf):
    sessions = table(spark, sf, "region").withColumn("status", F.lit("execute"))
    return state.finish_session(sessions, "r_name", "ASIA").select("r_regionkey", "status")
