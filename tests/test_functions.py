"""Column functions on the cases that matter."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import documents, keys, lookup, temporal, text
from tidemark.plans import ads, registry
from tidemark.schemas import REGISTRY_OBJECT


def one(spark, column, **values):
    row = {k: (v if v is not None else None) for k, v in values.items()}
    names = ", ".join(f"{k} string" for k in row) or "x string"
    return spark.createDataFrame([tuple(row.values()) or ("",)], names).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "written, utc",
    [
        ("2023-01-05 09:30:00", dt.datetime(2023, 1, 5, 14, 30)),
        ("2023-07-05 09:30:00", dt.datetime(2023, 7, 5, 13, 30)),
        ("2023-03-12 02:30:00", dt.datetime(2023, 3, 12, 7, 30)),  # in the gap
        ("2023-11-05 01:30:00", dt.datetime(2023, 11, 5, 5, 30)),  # twice that night
        ("soon", None),
    ],
)
def test_local_to_utc(spark, written, utc):
    assert one(spark, temporal.local_to_utc("t").cast("timestamp_ntz"), t=written) == utc


@pytest.mark.parametrize(
    "written, at",
    [
        ("сегодня в 9:05", dt.datetime(2024, 3, 10, 9, 5)),
        ("№ 12 · вчера в 23:59", dt.datetime(2024, 3, 9, 23, 59)),
        ("10 марта в 00:00", dt.datetime(2024, 3, 10)),
        ("11 марта в 10:00", dt.datetime(2023, 3, 11, 10)),
        ("5 мая в 10:15", dt.datetime(2023, 5, 5, 10, 15)),
        ("5 майя в 10:15", dt.datetime(2023, 5, 5, 10, 15)),
        ("31 декабря в 12:00", dt.datetime(2023, 12, 31, 12)),
        ("31 февраля в 12:00", None),
        ("давно", None),
        (None, None),
    ],
)
def test_relative_ts(spark, written, at):
    now = F.lit("2024-03-10 12:00:00").cast("timestamp")
    assert one(spark, temporal.relative_ts("t", now).cast("timestamp_ntz"), t=written) == at


@pytest.mark.parametrize("month, number", list(temporal.MONTHS.items()))
def test_every_month(spark, month, number):
    now = F.lit("2024-12-31 12:00:00").cast("timestamp")
    got = one(spark, temporal.relative_ts("t", now).cast("timestamp_ntz"), t=f"1 {month} в 01:02")
    assert got == dt.datetime(2024, number, 1, 1, 2)


@pytest.mark.parametrize(
    "name, date",
    [("№ 1 от 05.02", dt.date(2023, 2, 5)), ("без даты", None), ("от 31.02", None), ("1.2", None)],
)
def test_date_from_name(spark, name, date):
    assert one(spark, temporal.date_from_name("n", F.lit("2023-07-01").cast("date")), n=name) == date


def test_dates_in_text(spark):
    default = F.lit("2024-01-01").cast("date")
    assert one(spark, temporal.iso_date_in("t", default), t="a 2023-05-06 2023-07-08") == dt.date(2023, 5, 6)
    assert one(spark, temporal.iso_date_in("t", default), t="nothing") == dt.date(2024, 1, 1)
    assert one(spark, temporal.form_date("t"), t='{"@DateForm": "2023-02-03", "x": 1}') == dt.date(2023, 2, 3)
    assert one(spark, temporal.form_date("t"), t="{}") is None
    assert one(spark, temporal.dated_name(F.lit("2023-02-03").cast("date"), "n"), n="IBM") == "20230203_IBM"


@pytest.mark.parametrize(
    "written, number", [("12,50 руб", 12.5), ("7", 7.0), ("нет", None), ("1.2.3", None), (None, None)]
)
def test_repair_decimal(spark, written, number):
    got = one(spark, text.repair_decimal("t"), t=written)
    assert (None if got is None else float(got)) == number


def test_control_characters_are_searched_as_bytes(spark):
    """As by translate, without taking a text apart character by character, which cost more than parsing a short document."""
    rows = spark.createDataFrame([(x,) for x in (None, "", "\t", "\r\n\t\n", "р-н\tул\r\nд", "\u2028a\v\0b")], "t string")
    bare = rows.select(text.strip_control("t").alias("got"), F.translate("t", "\t\r\n", "").alias("want"))
    assert all(r.got == r.want for r in bare.collect())
    assert "translate" not in rows.select(text.strip_control("t"))._jdf.queryExecution().analyzed().toString()


def test_cleaning(spark):
    assert one(spark, text.squeeze_blanks("t"), t="a \t\n b") == "a b"
    assert one(spark, text.strip_control("t"), t="a\tb\r\nc") == "abc"
    assert one(spark, text.strip_bom("t"), t="\ufeffa\ufeff") == "a\ufeff"
    assert one(spark, text.trim_chars("t", '"'), t='"a"') == "a"
    assert one(spark, text.truncate("t", 4), t="abcdef") == "abc"
    assert one(spark, text.segment("t", "·", -2), t="a·b·c") == "b"
    assert one(spark, text.segment("t", "·", -2), t="a") is None
    assert one(spark, text.join_segments("t"), t="А\nБ;В") == "а | б | в |"


@pytest.mark.parametrize(
    "path, name, stem, tail",
    [
        ("D:\\a\\b.png", "b.png", "b", "b.png"),
        ("/a/b.v1.zip", "b.v1.zip", "b", None),
        ("b.png", "b.png", "b", None),
    ],
)
def test_paths(spark, path, name, stem, tail):
    assert one(spark, text.file_name("p"), p=path) == name
    assert one(spark, text.file_stem("p"), p=path) == stem
    assert one(spark, text.file_tail("p", "png"), p=path) == tail


def test_link(spark):
    page = '{"weblink_get":{"stock":{"count":2,"url":"https://h/"}},"dwl_token":"tok","folders":{"list":[{"name":"a b"}]}}'
    link, name = text.assemble_link("t")
    # The stock's closing brace ends the address.
    assert one(spark, link, t=page) == "https://h/get/tok/a b"
    assert one(spark, name, t=page) == "a b"


@pytest.mark.parametrize(
    "written, floor, total, rooms, house",
    [
        ("этаж: 12 из 16 | тип дома: кирпичный | количество комнат: 3 |", 12, 16, 3, "кирпичный"),
        ("этаж: 1 из 9 |", 1, 9, None, None),
        ("без этажей |", None, None, None, None),
    ],
)
def test_ad_attributes(spark, written, floor, total, rooms, house):
    columns = ads.ad_attributes("t")
    assert one(spark, columns["floor"], t=written) == floor
    assert one(spark, columns["house_floors"], t=written) == total
    assert one(spark, columns["rooms"], t=written) == rooms
    assert one(spark, columns["house_type"], t=written) == house


@pytest.mark.parametrize(
    "written, value, unit",
    [
        ("общая площадь: 54,3 м² | этаж: 1 из 2 |", 54.3, " м² "),
        ("площадь дома: 120 м² | площадь участка: 6 сот. |", 120.0, " м² "),
        ("площадь кухни: 9 м² |", 9.0, " м² |"),
        ("ничего |", None, None),
    ],
)
def test_area(spark, written, value, unit):
    square, rest = text.split_number_unit(ads.square_of("t"))
    assert one(spark, square, t=written) == value
    assert one(spark, rest, t=written) == unit


@pytest.mark.parametrize(
    "category, kind",
    [
        ("Земельные участки, квартиры", "zu"),
        ("Купить квартиру", "flat"),
        ("Дома, дачи", "house"),
        ("Гаражи", "garage"),
        ("Коммерческая недвижимость", "commercial"),
        ("Прочее", None),
    ],
)
def test_kinds(spark, category, kind):
    assert one(spark, ads.kind_of("c"), c=category) == kind


def test_hash_key_ignores_type(spark):
    same = F.struct(keys.hash_key(F.lit(430)).alias("a"), keys.hash_key(F.lit("430")).alias("b"))
    got = one(spark, same)
    assert got["a"] == got["b"]


@pytest.fixture(scope="module")
def classifier(spark):
    return spark.createDataFrame([("1", "one"), ("2", "two"), ("3", None)], "code string, value string")


def test_map_class(spark, classifier):
    df = spark.createDataFrame([(" 1 ",), (" 9 ",), ("3",), (None,)], "c string")
    got = {r["c"]: r["v"] for r in lookup.map_class(df, "c", classifier, out="v").collect()}
    assert got == {" 1 ": "one", " 9 ": " 9 ", "3": None, None: None}


def test_map_class_array(spark, classifier):
    rows = [(1, [" 2 ", "9 ", None, "1"]), (2, []), (3, None), (4, ["3"]), (5, ["1", "1"])]
    df = spark.createDataFrame(rows, "id int, c array<string>")
    got = lookup.map_class_array(df, "c", classifier, ["id"], out="v").collect()
    assert {r["id"]: r["v"] for r in got} == {1: "two,9,one", 2: None, 3: None, 4: None, 5: "one,one"}


def test_several_arrays_without_a_key(spark, classifier):
    rows = [(["1"], ["2", "x"]), (["1"], ["2", "x"]), (None, [" 1"])]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    got = lookup.map_class_arrays(df, {"a": "a", "b": "b"}, classifier).collect()
    assert sorted((r["a"] or "", r["b"]) for r in got) == [("", "one"), ("one", "two,x"), ("one", "two,x")]


def test_json_paths(spark):
    doc = '{"O":{"A":{"X":[{"n":1},{"n":2}]},"B":{"Y":{"n":3,"deep":{"n":4}}}}}'
    df = spark.createDataFrame([(doc,), ("not json",)], "t string").select(documents.parse_document("t").alias("d"))
    found = documents.json_path_all(df, "d", ["O", "*", "*", "[*]"])
    assert sorted(r[0] for r in found.select(documents.json_text("obj", "$.n")).collect()) == ["1", "2", "3"]
    every = df.select(F.explode(documents.json_find("d", "n")).alias("n")).select(F.try_variant_get("n", "$", "int"))
    assert sorted(r[0] for r in every.collect()) == [1, 2, 3, 4]


def test_json_building(spark):
    assert one(spark, documents.json_object(b=F.lit("я"), a=F.lit(None).cast("string"))) == '{"b":"я"}'
    assert one(spark, documents.json_array(F.lit(None).cast("string"), F.lit("x"))) == ["x"]


def test_address_line(spark):
    location = REGISTRY_OBJECT["Location"].dataType
    values = {f.name: None for f in location}
    values["District"] = ("р-н", "Южный")
    values["Level2"] = ("корп", "3", None)
    schema = T.StructType([T.StructField("l", location)])
    df = spark.createDataFrame([(tuple(values.values()),)], schema)
    assert df.select(registry.address_line("l")).first()[0] == "р-н Южный корп3"
    assert df.select(registry.address_line("l", trim=False)).first()[0] == "р-н Южный корп3 "


@pytest.mark.parametrize(("text", "depth"), [("1", 0), ("{}", 1), ('{"a":"[[{\\"["}', 1), ('[{"a":[]},[[1]]]', 3), ('{"a":{"b":1},"c":[2]}', 2), (None, None)])
def test_json_depth(spark, text, depth):
    row = spark.createDataFrame([(text,)], "t string").select(documents.json_depth("t")).first()
    assert row[0] == depth


def test_json_find_in_a_wide_document(spark):
    """A hundred thousand members, with brackets in their texts, in few levels."""
    text = json.dumps({"rows": [{"@Number": i, "note": "[{" * 3} for i in range(100_000)]})
    docs = spark.createDataFrame([(text,)], "t string").select(documents.parse_document("t").alias("doc"))
    start = time.perf_counter()
    found = docs.select(F.size(documents.json_find("doc", "@Number")).alias("n")).first()["n"]
    assert found == 100_000 and time.perf_counter() - start < 20
