"""Listing pages to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.temporal import relative_ts
from tidemark.functions.text import (
    attribute,
    classify,
    extract_or_null,
    first_match,
    join_segments,
    segment,
    split_number_unit,
    truncate,
    url_tail_id,
)
from tidemark.operators.filters import MISSING_PAGE_PHRASES, blocked, exclude_category, has_phrase
from tidemark.scale import cut_lineage
from tidemark.schemas import AD_BASE, AD_EXTRAS
from tidemark.sinks.write import insert_ignore
from tidemark.sources.pages import Field, fields_of, list_links

# Elements of a listing page.
PAGE_FIELDS = {
    "name": Field("span", "itemprop", "name"),
    "address": Field("div", "itemprop", "address"),
    "price_value": Field("span", "itemprop", "price", take="content"),
    "price_currency": Field("span", "itemprop", "priceCurrency", take="content"),
    "price_original": Field("span", "class", "price-value-string", part=True, many=True),
    "x": Field(None, "data-map-lat", take="data-map-lat"),
    "y": Field(None, "data-map-lat", take="data-map-lon"),
    "description": Field("div", "itemprop", "description"),
    "params": Field("div", "data-marker", "item-params", part=True, many=True),
    "crumbs": Field("span", "class", "breadcrumbs-link", part=True, many=True),
    "date": Field("span", "data-marker", "item-view/item-date", part=True),
}

# Words of a category and the kind they stand for, first match wins.
KIND_RULES = [
    (["Земельные участки"], "zu"),
    (["квартир", "Вторичка", "Новостройки", "Комнаты"], "flat"),
    (["Дома"], "house"),
    (["Гаражи"], "garage"),
    (["Коммерческая"], "commercial"),
]

# Texts that hold the area, first match wins.
AREA_PATTERNS = [(r".*(площадь:.*?)\|", 1), (r"(площадь дома:.*?)\|", 1), (r"площадь.*:.*\|", 0)]

# Defaults for what a page may lack.
DEFAULT_ADDRESS = "Без адреса"
DEFAULT_DESCRIPTION = "Нет описаня"

# Widths of the text columns.
WIDTHS = {
    "name": 200, "address": 200, "price_currency": 50, "price_original": 200, "square_currency": 50,
    "square_original": 50, "url": 500, "screenshot_file": 200, "phone": 100, "category": 100, "locality": 100,
    "house_type": 100, "wall": 100, "to_city": 100, "square_zu": 100,
}
NAME_WIDTH_OF_HOUSES = 50
KEYS = ["ad_id", "time_stamp"]


def ad_attributes(other: str) -> dict[str, Column]:
    """Attributes out of the lower-cased ``label: value |`` text."""
    return {
        "to_city": attribute(other, "расстояние до города", ".*?"),
        "wall": attribute(other, "материал стен", r"\w+?"),
        "floors": attribute(other, "этажей в доме", r"\d+?").try_cast("int"),
        "square_zu": attribute(other, "площадь участка", ".*?"),
        "floor": attribute(other, "этаж", r"\d+", r"\s*из\s*\d+\s*\|").try_cast("int"),
        "house_floors": extract_or_null(other, r"(?U)этаж:\s*\d+\s*из\s*(\d+)\s*\|", 1).try_cast("int"),
        "house_type": attribute(other, "тип дома", r"\w+", ""),
        "rooms": attribute(other, "количество комнат", r"\d+?").try_cast("int"),
    }


def square_of(other: str) -> Column:
    """Text of the area."""
    return first_match(other, AREA_PATTERNS)


def kind_of(category: str | Column) -> Column:
    return classify(category, KIND_RULES)


def discover_ads(
    listing_pages: DataFrame, run_date: Column, known: DataFrame | None = None, marker: str | None = "item-title"
) -> DataFrame:
    """Queue entries of the links on listing pages.

    ``listing_pages`` holds ``html, category, locality, section_id``. Rentals
    and new buildings are left out, as are links without an id. Unique on
    (ad, date); of several pages the smallest row is kept.
    """
    links = list_links(exclude_category(listing_pages, "category"), marker=marker, out="url")
    found = links.select(
        "url",
        url_tail_id("url").alias("ad_id"),
        F.lit("no").alias("status"),
        kind_of("category").alias("kind"),
        "locality",
        run_date.alias("time_stamp"),
        "section_id",
    ).filter(F.col("ad_id").isNotNull())
    order = ["url", "kind", "locality", "section_id"]
    empty = found.limit(0) if known is None else known
    return insert_ignore(empty, found, KEYS, order)


def parse_ads(pages: DataFrame, run_ts: Column, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Pages (``url, html, kind, locality, section_id``) to ads, and the pages that gave none.

    The ads hold the base columns, those of every kind, and ``kind``; they are
    unique on (ad, time) and new against ``known``. Pages are read once: what
    was found on them is written to the shared folder before it is split.
    """
    fields = pages.select("url", "kind", "locality", "section_id", "html", fields_of("html", PAGE_FIELDS).alias("f"))
    texts = fields.select(
        "url", "kind", "locality", "section_id",
        blocked("url", "html").alias("_blocked"),
        has_phrase("html", MISSING_PAGE_PHRASES).alias("_gone"),
        "f.*",
    )
    texts = texts.withColumn(
        "other",
        # The two lists are separate pieces of the joined text.
        join_segments(F.concat(F.coalesce("params", F.lit("")), F.lit("\n"), F.coalesce("crumbs", F.lit("")))),
    ).withColumn("square_original", square_of("other"))
    square_value, square_unit = split_number_unit("square_original")
    ads = texts.select(
        "kind",
        url_tail_id("url").alias("ad_id"),
        relative_ts("date", run_ts).alias("time_stamp"),
        "name",
        F.coalesce("address", F.lit(DEFAULT_ADDRESS)).alias("address"),
        F.col("price_value").try_cast("double").alias("price_value"),
        "price_currency",
        F.coalesce("price_original", F.lit("")).alias("price_original"),
        F.coalesce(F.col("x").try_cast("double"), F.lit(0.0)).alias("x"),
        F.coalesce(F.col("y").try_cast("double"), F.lit(0.0)).alias("y"),
        square_value.alias("square_value"),
        F.replace(square_unit, F.lit(";"), F.lit("")).alias("square_currency"),
        "square_original",
        F.coalesce("description", F.lit(DEFAULT_DESCRIPTION)).alias("description"),
        "other",
        "url",
        F.lit("").alias("phone"),
        F.concat(url_tail_id("url").cast("string"), F.lit(".png")).alias("screenshot_file"),
        F.coalesce(segment("crumbs", "·", -2), F.lit("")).alias("category"),
        "locality",
        F.col("section_id").cast("int").alias("section_id"),
        "_blocked",
        "_gone",
        *[column.alias(name) for name, column in ad_attributes("other").items()],
    )
    reason = (
        F.when(F.col("_blocked"), "blocked page")
        .when(F.col("_gone"), "no such page")
        .when(F.col("ad_id").isNull(), "no ad id in the address")
        .when(F.col("time_stamp").isNull(), "no readable date")
        .when(F.col("name").isNull(), "no name")
        .when(F.col("price_value").isNull() | F.col("price_currency").isNull(), "no price")
        .when(F.col("square_value").isNull(), "no area")
    )
    checked = cut_lineage(ads.withColumn("reason", reason), "ads")
    columns = list(dict.fromkeys(["kind", *AD_BASE.names, *[n for s in AD_EXTRAS.values() for n in s.names]]))
    good = checked.filter(F.col("reason").isNull()).select(*_limited(columns))
    bad = checked.filter(F.col("reason").isNotNull()).select("url", "kind", "reason")
    empty = good.limit(0) if known is None else known
    order = [c for c in columns if c not in KEYS]
    return insert_ignore(empty, good, KEYS, order), bad


def _limited(columns: list[str]) -> list[Column]:
    """Columns cut to the width of their target and emptied where a kind has no such column."""
    result = []
    for name in columns:
        column = truncate(name, WIDTHS[name]) if name in WIDTHS else F.col(name)
        if name == "name":
            column = F.when(F.col("kind") == "house", truncate(name, NAME_WIDTH_OF_HOUSES)).otherwise(column)
        owners = [kind for kind, extra in AD_EXTRAS.items() if name in extra.names]
        if owners:
            missing = F.lit(0) if name in ("floor", "house_floors", "floors", "rooms") else F.lit("")
            column = F.when(F.col("kind").isin(owners), F.coalesce(column, missing))
        result.append(column.alias(name))
    return result


def ad_columns(kind: str) -> list[str]:
    """Columns of a kind's own table."""
    return [*AD_BASE.names, *AD_EXTRAS[kind].names]


def ad_tables(ads: DataFrame) -> dict[str, DataFrame]:
    """Each kind's rows with the columns of its own table."""
    return {kind: ads.filter(F.col("kind") == kind).select(*ad_columns(kind)) for kind in AD_EXTRAS}
