"""Queries over price bars, their star schema and its checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.temporal import local_to_utc
from tidemark.operators import aggregates as agg
from tidemark.operators.filters import align_schema
from tidemark.operators.paging import sorted_by
from tidemark.plans import daily, marts, quality, star
from tidemark.scale import cut_lineage, scratch_path
from tidemark.schemas import PRICE, struct_of
from tidemark.sources.prices import bars_from_json, read_checked_csv, read_price_json, typed_bars
from workload import views
from workload.base import Registry, plain
from workload.views import sql

QUERIES = Registry()
query = QUERIES.query

_CHANGE = """
    SELECT symbol, time::date AS day, cast(sum(volume) AS bigint) AS sum_vol,
           cast(arg_min(open, time) AS double) AS price_open,
           cast(arg_max({last}, time) AS double) AS price_close,
           arg_max(time, {{'v': volume, 't': -epoch_us(time)}}) AS {vol},
           cast(max(high) AS double) AS max_price, cast(min(low) AS double) AS min_price, {times}
           round(cast((arg_max({last}, time) - arg_min(open, time)) AS double)
                 / nullif(cast(arg_min(open, time) AS double), 0) * 100, 6) AS change_per
    FROM prices GROUP BY 1, 2"""


def _change(spark, sf, literal):
    mart = marts.daily_price_change(views.prices(spark, sf), literal)
    return plain(mart.withColumn("change_per", F.round(F.col("change_per").cast("double"), 6)))


@query(
    "price_daily_change",
    sql("prices", _CHANGE.format(last="close", vol="max_vol_time", times="""
           arg_max(time, {'v': high, 't': -epoch_us(time)}) AS max_price_time,
           arg_min(time, {'v': low, 't': epoch_us(time)}) AS min_price_time,""")),
)
def price_daily_change(spark, sf):
    return _change(spark, sf, literal=False)


@query("price_daily_change_literal", sql("prices", _CHANGE.format(last="open", vol="min_vol_time", times="")))
def price_daily_change_literal(spark, sf):
    return _change(spark, sf, literal=True)


# --- single measures ---------------------------------------------------------


def _days(spark, sf):
    return views.prices(spark, sf).withColumn("day", F.to_date("time"))


BY = ["symbol", "day"]


@query(
    "price_open_first_value",
    sql("prices", """
    SELECT DISTINCT symbol, time::date AS day,
           cast(first_value(open) OVER (PARTITION BY symbol, time::date ORDER BY time) AS double) AS price_open
    FROM prices"""),
)
def price_open_first_value(spark, sf):
    return plain(agg.first_in_group(_days(spark, sf), BY, "open", "time", "price_open"))


@query(
    "price_close_last",
    sql("prices", """
    SELECT DISTINCT symbol, time::date AS day,
           cast(first_value(close) OVER (PARTITION BY symbol, time::date ORDER BY time DESC) AS double) AS price_close
    FROM prices"""),
)
def price_close_last(spark, sf):
    return plain(agg.last_in_group(_days(spark, sf), BY, "close", "time", "price_close"))


@query(
    "price_argmax_volume",
    sql("prices", """
    SELECT DISTINCT symbol, time::date AS day,
           first_value(time) OVER (PARTITION BY symbol, time::date ORDER BY volume DESC, time) AS max_vol_time
    FROM prices"""),
)
def price_argmax_volume(spark, sf):
    return _days(spark, sf).groupBy(*BY).agg(agg.earliest_at_max("time", "volume").alias("max_vol_time"))


@query(
    "price_argmax_argmin_price",
    sql("prices", """
    SELECT symbol, time::date AS day, min(time) FILTER (high = top) AS max_price_time,
           min(time) FILTER (low = bottom) AS min_price_time
    FROM (SELECT *, max(high) OVER w AS top, min(low) OVER w AS bottom FROM prices
          WINDOW w AS (PARTITION BY symbol, time::date))
    GROUP BY 1, 2"""),
)
def price_argmax_argmin_price(spark, sf):
    return _days(spark, sf).groupBy(*BY).agg(
        agg.earliest_at_max("time", F.col("high") * 10_000).alias("max_price_time"),
        agg.earliest_at_min("time", F.col("low") * 10_000).alias("min_price_time"),
    )


@query(
    "price_day_totals",
    sql("prices", """
    SELECT symbol, time::date AS day, cast(sum(volume) AS bigint) AS volume, cast(sum(open) AS double) AS open,
           cast(sum(close) AS double) AS close FROM prices GROUP BY 1, 2"""),
)
def price_day_totals(spark, sf):
    return plain(agg.totals(_days(spark, sf), BY, ["volume", "open", "close"]))


@query(
    "price_day_extremes",
    sql("prices", """
    SELECT symbol, time::date AS day, cast(min(low) AS double) AS min_low, cast(max(high) AS double) AS max_high
    FROM prices GROUP BY 1, 2"""),
)
def price_day_extremes(spark, sf):
    return plain(agg.extremes(_days(spark, sf), BY, "low", "high"))


@query(
    "price_latest_close",
    sql("prices", """
    SELECT symbol, cast(close AS double) AS close FROM prices
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY time DESC) = 1"""),
)
def price_latest_close(spark, sf):
    return plain(agg.latest_value(views.prices(spark, sf), "close", "time", ["symbol"]))


# --- file forms ----------------------------------------------------------------

@query(
    "local_to_utc",
    """SELECT event_id, timezone('UTC', timezone('US/Eastern', date_trunc('second', ts))) AS utc FROM events""",
)
def eastern_to_utc(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return views.table(spark, sf, "events").select(
        "event_id", local_to_utc(text).cast("timestamp_ntz").alias("utc")
    )


def _bar_text(spark, sf) -> DataFrame:
    bars = views.prices(spark, sf)
    return bars.select(
        "symbol",
        F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"),
        *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close", "volume")],
    )


_TYPED = """
    SELECT symbol, timezone('UTC', timezone('US/Eastern', time)) AS time, cast(open AS double) AS open,
           cast(high AS double) AS high, cast(low AS double) AS low, cast(close AS double) AS close, volume
    FROM prices"""


@query("price_csv_typed", sql("prices", _TYPED))
def price_csv_typed(spark, sf):
    """Text rows in local time to typed bars in UTC."""
    bars = typed_bars(_bar_text(spark, sf))
    return plain(bars.withColumn("time", F.col("time").cast("timestamp_ntz")))


def _bar_files(spark, sf):
    """The bars as CSV files; volumes of 1 and the times of one symbol hold no value of their kind."""
    path = scratch_path(spark, "bars-csv")
    text = _bar_text(spark, sf)
    text = text.select(
        F.when(F.col("symbol") == "click", F.lit("bad")).otherwise(F.col("time")).alias("time"), "open", "high", "low", "close",
        F.when(F.col("volume") == "1", F.lit("x")).otherwise(F.col("volume")).alias("volume"),
    )
    text.write.csv(path, header=True)
    return read_checked_csv(spark, path)


_GOOD = "symbol <> 'click' AND volume <> 1"


@query(
    "price_csv_files",
    sql("prices", f"SELECT timezone('UTC', timezone('US/Eastern', time)) AS time, cast(open AS double) AS open, cast(volume AS bigint) AS volume FROM prices WHERE {_GOOD}"),
)
def price_csv_files(spark, sf):
    """Bars written out as CSV and read again: what is typed."""
    good = _bar_files(spark, sf)[0].select(F.col("time").cast("timestamp_ntz").alias("time"), "open", "volume")
    return plain(good)


@query(
    "price_csv_rejects",
    sql("prices", f"SELECT volume = 1 AS bad_volume, symbol = 'click' AS bad_time, count(*) AS rows FROM prices WHERE NOT ({_GOOD}) GROUP BY 1, 2"),
)
def price_csv_rejects(spark, sf):
    """The same files: what is refused, with its reason."""
    bad = _bar_files(spark, sf)[1]
    marks = [F.contains("reject_reason", F.lit(c)).alias(f"bad_{c}") for c in ("volume", "time")]
    return bad.groupBy(*marks).agg(F.count("*").alias("rows"))


@query(
    "price_load",
    sql("prices", _CHANGE.format(last="close", vol="max_vol_time", times="""
           arg_max(time, {'v': high, 't': -epoch_us(time)}) AS max_price_time,
           arg_min(time, {'v': low, 't': epoch_us(time)}) AS min_price_time,""")),
)
def price_load(spark, sf):
    """The whole load, in two halves and the first one again, through ledger and star to the mart."""
    root = scratch_path(spark, "price-load")
    bars = views.prices(spark, sf)
    half = F.dayofmonth("time") % 2 == 0
    for part in (bars.filter(half), bars.filter(~half), bars.filter(half)):
        daily.load_prices(spark, part, "5min", root)
    mart = daily.price_mart(spark, root)
    times = [c for c in mart.columns if c.endswith("_time")]
    mart = mart.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})
    return plain(mart.withColumn("change_per", F.round(F.col("change_per").cast("double"), 6)))


@query("price_json_bars", sql("prices", _TYPED))
def price_json_bars(spark, sf):
    """A price document per bar time and symbol, exploded by its time key."""
    text = _bar_text(spark, sf)
    bar = F.struct(
        F.col("open").alias("1. open"),
        F.col("high").alias("2. high"),
        F.col("low").alias("3. low"),
        F.col("close").alias("4. close"),
        F.col("volume").alias("5. volume"),
    )
    doc = F.to_json(F.struct(F.create_map("time", bar).alias("Time Series (5min)")))
    bars = bars_from_json(text.select("symbol", doc.alias("doc")), "doc")
    return plain(bars.withColumn("time", F.col("time").cast("timestamp_ntz")))


@query("price_json_files", sql("prices", _TYPED))
def price_json_files(spark, sf):
    """A price document per symbol and day on disk, every bar of it under its time."""
    folder = scratch_path(spark, "price-json")
    fields = {"open": "1. open", "high": "2. high", "low": "3. low", "close": "4. close", "volume": "5. volume"}
    text = _bar_text(spark, sf)
    bar = F.struct(*[F.col(c).alias(name) for c, name in fields.items()])
    bars = text.groupBy("symbol", F.substring("time", 1, 10).alias("day")).agg(F.map_from_entries(F.collect_list(F.struct("time", bar.alias("bar")))).alias("Time Series (5min)"))
    docs = bars.select("symbol", "day", F.to_json(F.struct("`Time Series (5min)`")).alias("value"))
    docs.repartition("symbol", "day").write.partitionBy("symbol", "day").text(folder)
    found = read_price_json(spark, f"{folder}/*/*")
    symbol = F.regexp_extract("file", "symbol=([^/]+)/", 1).alias("symbol")
    return plain(found.select(symbol, *[c for c in found.columns if c != "file"]).withColumn("time", F.col("time").cast("timestamp_ntz")))


@query(
    "align_schema",
    sql("prices", """
    SELECT time, cast(open AS double) AS open, cast(high AS double) AS high, cast(low AS double) AS low,
           cast(close AS double) AS close, volume FROM prices"""),
)
def aligned_bars(spark, sf):
    aligned = align_schema(_bar_text(spark, sf).withColumn("other", F.lit(1)), PRICE)
    return plain(aligned.withColumn("time", F.col("time").cast("timestamp_ntz")))


# --- ledger, dimensions, fact ------------------------------------------------------

@query("pending_uploads", sql("ledger", "SELECT * FROM ledger WHERE uploaded IS NOT TRUE"))
def pending_uploads(spark, sf):
    return star.pending_uploads(views.ledger(spark, sf)).withColumn("upload_id", F.col("upload_id").cast("bigint"))


@query(
    "mark_uploaded",
    sql("ledger", """
    SELECT * REPLACE (CASE WHEN date = (SELECT max(date) FROM ledger) THEN true ELSE uploaded END AS uploaded)
    FROM ledger"""),
)
def mark_uploaded(spark, sf):
    loads = views.ledger(spark, sf)
    return star.mark_uploaded(loads, loads.agg(F.max("date")).scalar())


def _known_loads(spark, sf):
    """The finished loads, as the ledger before new ones are opened."""
    return views.ledger(spark, sf).filter(F.col("uploaded"))


@query(
    "open_upload",
    sql("ledger", """
    SELECT row_number() OVER (ORDER BY symbol_name, interval_name, date) + (SELECT max(upload_id) FROM ledger WHERE uploaded) AS upload_id,
           date, symbol_name, interval_name, cast(NULL AS boolean) AS uploaded
    FROM ledger l WHERE NOT EXISTS (
        SELECT 1 FROM ledger k WHERE k.uploaded AND k.symbol_name = l.symbol_name AND k.interval_name = l.interval_name
        AND k.date = l.date)"""),
)
def open_upload(spark, sf):
    wanted = views.ledger(spark, sf).select("symbol_name", "interval_name", "date")
    return star.open_uploads(_known_loads(spark, sf), wanted)


@query(
    "open_upload_intervals",
    sql("ledger", """
    SELECT symbol_name, date, interval_name FROM (
        SELECT symbol_name, date, unnest(['5min', '15min']) AS interval_name FROM ledger WHERE uploaded) l
    WHERE NOT EXISTS (SELECT 1 FROM ledger k WHERE k.uploaded AND k.symbol_name = l.symbol_name
        AND k.interval_name = l.interval_name AND k.date = l.date)"""),
)
def open_upload_intervals(spark, sf):
    """Other intervals of a loaded symbol and day are loads of their own."""
    known = _known_loads(spark, sf)
    names = F.explode(F.array(F.lit("5min"), F.lit("15min"))).alias("interval_name")
    return star.open_uploads(known, known.select("symbol_name", "date", names)).select("symbol_name", "date", "interval_name")


@query(
    "stamp_uploads",
    sql("prices ledger", """
    SELECT p.symbol, p.time, p.volume, l.upload_id FROM prices p
    JOIN ledger l ON l.symbol_name = p.symbol AND l.date = p.time::date"""),
)
def stamp_uploads(spark, sf):
    bars = views.prices(spark, sf).select("symbol", "time", "volume")
    return star.stamp_uploads(bars, views.ledger(spark, sf))


def _dim(spark, ddl):
    return spark.createDataFrame([], struct_of(ddl))


@query(
    "dim_interval",
    sql("ledger", """
    SELECT row_number() OVER (ORDER BY interval_name) AS interval_id, interval_name
    FROM (SELECT DISTINCT interval_name FROM ledger WHERE uploaded IS NOT TRUE)"""),
)
def dim_interval(spark, sf):
    return _intervals(spark, sf)


def _intervals(spark, sf):
    pending = star.pending_uploads(views.ledger(spark, sf))
    return star.load_dimension(_dim(spark, "interval_id bigint, interval_name string"), pending, ["interval_name"], "interval_id")


_SYMBOLS = """
    SELECT symbol_id, symbol_name FROM (
        SELECT symbol_name, row_number() OVER (ORDER BY old DESC, symbol_name) AS symbol_id FROM (
            SELECT symbol_name, max(CASE WHEN symbol_name < 'm' THEN 1 ELSE 0 END) AS old FROM ledger GROUP BY 1))"""


def _symbols(spark, sf):
    """Symbols loaded in two rounds, the second only adding what is new."""
    loads = views.ledger(spark, sf)
    empty = _dim(spark, "symbol_id bigint, symbol_name string")
    first = star.load_dimension(empty, loads.filter(F.col("symbol_name") < "m"), ["symbol_name"], "symbol_id")
    return first.unionByName(star.load_dimension(first, loads, ["symbol_name"], "symbol_id"))


@query("dim_symbol", sql("ledger", _SYMBOLS))
def dim_symbol(spark, sf):
    return _symbols(spark, sf)


_INTERVALS = """SELECT interval_name, row_number() OVER (ORDER BY interval_name) AS interval_id
    FROM (SELECT DISTINCT interval_name FROM ledger WHERE uploaded IS NOT TRUE)"""
_TIMES = """
    SELECT row_number() OVER (ORDER BY time, interval_id) AS time_serial_id, time AS time_serial_time,
           interval_id AS time_serial_interval_id
    FROM (SELECT DISTINCT s.time, i.interval_id FROM stocks s JOIN ledger l USING (upload_id)
          JOIN intervals i USING (interval_name) WHERE l.uploaded IS NOT TRUE)"""
TIME_KEYS = ["time_serial_time", "time_serial_interval_id"]


def _stocks(spark, sf):
    """The staged bars as a stored table."""
    return cut_lineage(views.stocks(spark, sf), "stocks")


def _times(spark, stocks, loads, intervals):
    values = star.time_serial_values(stocks, loads, intervals)
    empty = _dim(spark, "time_serial_id bigint, time_serial_time timestamp_ntz, time_serial_interval_id bigint")
    return star.load_dimension(empty, values, TIME_KEYS, "time_serial_id")


@query("dim_time_serial", sql("prices ledger stocks", "SELECT * FROM times", intervals=_INTERVALS, times=_TIMES))
def dim_time_serial(spark, sf):
    return _times(spark, views.stocks(spark, sf), views.ledger(spark, sf), _intervals(spark, sf))


def _fact(spark, sf):
    intervals, symbols = _intervals(spark, sf), _symbols(spark, sf)
    stocks, loads = _stocks(spark, sf), views.ledger(spark, sf)
    # Each bar is delivered twice by its load.
    twice = stocks.unionByName(stocks)
    return star.load_fact_price(None, twice, loads, intervals, symbols, _times(spark, stocks, loads, intervals))


_FACT = """
    SELECT cast(s.open AS double) AS price_open, cast(s.high AS double) AS price_high,
           cast(s.low AS double) AS price_low, cast(s.close AS double) AS price_close, s.volume AS price_volume,
           y.symbol_id AS price_symbol_id, t.time_serial_id AS price_time_id
    FROM stocks s JOIN ledger l USING (upload_id) JOIN intervals i USING (interval_name)
    JOIN symbols y USING (symbol_name)
    JOIN times t ON t.time_serial_time = s.time AND t.time_serial_interval_id = i.interval_id
    WHERE l.uploaded IS NOT TRUE"""


@query(
    "fact_price_load",
    sql("prices ledger stocks", _FACT, intervals=_INTERVALS, times=_TIMES, symbols=_SYMBOLS),
)
def fact_price_load(spark, sf):
    return plain(_fact(spark, sf))


_HIST = """
    SELECT symbol_id, symbol_name, cast(min(date) AS timestamp) AS symbol_valid_from,
           cast(NULL AS timestamp) AS symbol_valid_to
    FROM ledger JOIN symbols USING (symbol_name) WHERE uploaded IS NOT TRUE GROUP BY 1, 2"""


def _history(spark, sf, symbols):
    empty = _dim(
        spark,
        "symbol_id bigint, symbol_name string, symbol_valid_from timestamp_ntz, symbol_valid_to timestamp_ntz",
    )
    loads = views.ledger(spark, sf).withColumn("date", F.col("date").cast("timestamp_ntz"))
    return star.open_symbol_history(empty, symbols, loads)


@query("symbol_history_open", sql("ledger", "SELECT * FROM hist", symbols=_SYMBOLS, hist=_HIST))
def symbol_history_open(spark, sf):
    return _history(spark, sf, _symbols(spark, sf))


_RENAMED = """
    SELECT symbol_id, symbol_name, symbol_valid_from,
           CASE WHEN symbol_name < 'm' THEN TIMESTAMP '2024-06-01 00:00:00' END AS symbol_valid_to FROM hist
    UNION ALL
    SELECT symbol_id, symbol_name || '_new', TIMESTAMP '2024-06-01 00:00:00', NULL FROM symbols WHERE symbol_name < 'm'"""


@query("scd4_rename", sql("ledger", _RENAMED, symbols=_SYMBOLS, hist=_HIST))
def scd4_rename(spark, sf):
    symbols = _symbols(spark, sf)
    renames = symbols.filter(F.col("symbol_name") < "m").select(
        F.col("symbol_name").alias("old_name"),
        F.concat("symbol_name", F.lit("_new")).alias("new_name"),
        F.lit("2024-06-01 00:00:00").cast("timestamp_ntz").alias("at"),
    )
    return star.scd4_rename(symbols, _history(spark, sf, symbols), renames)[1]


_TWICE = """
    SELECT symbol_id, symbol_name, symbol_valid_from,
           CASE WHEN symbol_name < 'm' THEN TIMESTAMP '2024-06-01 00:00:00' END AS symbol_valid_to FROM hist
    UNION ALL
    SELECT symbol_id, symbol_name || '_b', TIMESTAMP '2024-06-01 00:00:00', TIMESTAMP '2024-07-01 00:00:00'
    FROM symbols WHERE symbol_name < 'm'
    UNION ALL
    SELECT symbol_id, symbol_name || '_c', TIMESTAMP '2024-07-01 00:00:00', NULL FROM symbols WHERE symbol_name < 'm'"""


def _renamed_twice(spark, sf):
    symbols = _symbols(spark, sf)
    old = symbols.filter(F.col("symbol_name") < "m").select(F.col("symbol_name").alias("old_name"))
    steps = F.array(*[
        F.struct(F.concat("old_name", F.lit(tail)).alias("new_name"), F.lit(at).cast("timestamp_ntz").alias("at"))
        for tail, at in (("_c", "2024-07-01 00:00:00"), ("_b", "2024-06-01 00:00:00"))
    ])
    renames = old.select("old_name", F.explode(steps).alias("step")).select("old_name", "step.*")
    return star.scd4_rename(symbols, _history(spark, sf, symbols), renames)


@query("scd4_two_renames", sql("ledger", _TWICE, symbols=_SYMBOLS, hist=_HIST))
def scd4_two_renames(spark, sf):
    """Two renames of a symbol in a batch: the history follows their order."""
    return _renamed_twice(spark, sf)[1]


@query(
    "scd4_two_renames_current",
    sql("ledger", """
    SELECT symbol_id, CASE WHEN symbol_name < 'm' THEN symbol_name || '_c' ELSE symbol_name END AS symbol_name
    FROM symbols""", symbols=_SYMBOLS),
)
def scd4_two_renames_current(spark, sf):
    return _renamed_twice(spark, sf)[0]


@query(
    "scd4_current",
    sql("ledger", """
    SELECT symbol_id, CASE WHEN symbol_name < 'm' THEN symbol_name || '_new' ELSE symbol_name END AS symbol_name
    FROM symbols""", symbols=_SYMBOLS),
)
def scd4_current(spark, sf):
    symbols = _symbols(spark, sf)
    renames = symbols.filter(F.col("symbol_name") < "m").select(
        F.col("symbol_name").alias("old_name"),
        F.concat("symbol_name", F.lit("_new")).alias("new_name"),
        F.lit("2024-06-01 00:00:00").cast("timestamp_ntz").alias("at"),
    )
    return star.scd4_rename(symbols, _history(spark, sf, symbols), renames)[0]


# --- checks -------------------------------------------------------------------------


def _layers(spark, sf):
    """All bars, and those of the loads not refused, as staging and core."""
    staging = views.prices(spark, sf).withColumn("date", F.to_date("time"))
    loads = views.ledger(spark, sf).filter(F.coalesce("uploaded", F.lit(True)))
    core = staging.join(loads.select(F.col("symbol_name").alias("symbol"), "date"), ["symbol", "date"], "left_semi")
    return staging.drop("date"), core.drop("date")


_CORE = """SELECT p.* FROM prices p JOIN ledger l ON l.symbol_name = p.symbol AND l.date = p.time::date
    WHERE coalesce(l.uploaded, true)"""


@query(
    "check_symbols",
    sql("prices ledger", """
    SELECT symbol, bool_or(l = 's') AS in_staging, bool_or(l = 'c') AS in_core FROM (
        SELECT DISTINCT upper(symbol) AS symbol, 's' AS l FROM prices UNION ALL
        SELECT DISTINCT symbol, 'c' FROM core)
    GROUP BY 1 HAVING NOT (bool_or(l = 's') AND bool_or(l = 'c'))""", core=_CORE),
)
def check_symbols(spark, sf):
    staging, core = _layers(spark, sf)
    return quality.check_symbols(staging.withColumn("symbol", F.upper("symbol")), core)


@query(
    "check_counts",
    sql("prices ledger", """
    SELECT symbol, count(*) AS rows, 'staging' AS layer FROM prices GROUP BY 1 UNION ALL
    SELECT symbol, count(*), 'core' FROM core GROUP BY 1""", core=_CORE),
)
def check_counts(spark, sf):
    return quality.check_counts(*_layers(spark, sf))


@query(
    "check_ohlcv",
    sql("prices ledger", """
    SELECT symbol, date, layer, cast(open AS double) AS open, cast(high AS double) AS high, cast(low AS double) AS low,
           cast(close AS double) AS close, cast(volume AS bigint) AS volume,
           count(*) OVER (PARTITION BY symbol, date) = 2 AS matches
    FROM (SELECT symbol, time::date AS date, 'staging' AS layer, sum(open) AS open, sum(high) AS high, sum(low) AS low,
                 sum(close) AS close, sum(volume) AS volume FROM prices GROUP BY ALL
          UNION ALL
          SELECT symbol, time::date, 'core', sum(open), sum(high), sum(low), sum(close), sum(volume) FROM core GROUP BY ALL)""",
        core=_CORE),
)
def check_ohlcv(spark, sf):
    return plain(sorted_by(quality.check_ohlcv(*_layers(spark, sf)), "symbol", "date"))


@query(
    "star_to_mart",
    sql("prices ledger stocks", """
    SELECT symbol_name AS symbol, time::date AS day, cast(sum(volume) AS bigint) AS sum_vol,
           cast(arg_min(open, time) AS double) AS price_open, cast(arg_max(close, time) AS double) AS price_close
    FROM stocks JOIN ledger USING (upload_id) WHERE uploaded IS NOT TRUE GROUP BY 1, 2"""),
)
def star_to_mart(spark, sf):
    """The mart over the fact joined with its dimensions."""
    intervals = _intervals(spark, sf)
    stocks, loads = _stocks(spark, sf), views.ledger(spark, sf)
    symbols, times = _symbols(spark, sf), _times(spark, stocks, loads, intervals)
    fact = star.load_fact_price(None, stocks, loads, intervals, symbols, times)
    mart = marts.daily_price_change(star.fact_bars(fact, symbols, times))
    return plain(mart.select("symbol", "day", "sum_vol", "price_open", "price_close"))
