"""Readers over small files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.temporal import form_date
from tidemark.plans import registry as reg
from tidemark.schemas import SHEET_ROWS
from tidemark.sources import events, files, listing, pages, prices, registry, sheets


def bars(n):
    start = dt.datetime(2023, 1, 5, 9, 30)
    return [(start + dt.timedelta(minutes=5 * i), f"{10 + i}.1234") for i in range(n)]


@pytest.mark.parametrize("n", [1, 99, 100, 250])
def test_price_json_keeps_every_bar(spark, tmp_path, n):
    series = {
        str(t): {"1. open": p, "2. high": p, "3. low": p, "4. close": p, "5. volume": "7"} for t, p in bars(n)
    }
    (tmp_path / "a.json").write_text(json.dumps({"Meta": 1, "Time Series (5min)": series}, indent=1))
    got = prices.read_price_json(spark, str(tmp_path)).orderBy("time").collect()
    assert len(got) == n
    assert got[0]["time"].hour == 14 and str(got[-1]["open"]) == f"{9 + n}.1234" and got[0]["volume"] == 7


def test_price_csv(spark, tmp_path):
    lines = ["time,open,high,low,close,volume", *[f"{t},{p},{p},{p},{p},3" for t, p in bars(3)], "2023-01-05 10:00:00,x,1,1,1,1"]
    (tmp_path / "IBM.csv").write_text("\n".join(lines))
    got = prices.read_price_csv(spark, str(tmp_path)).orderBy("time").collect()
    assert [r["open"] is None for r in got] == [False, False, False, True]
    assert got[0]["time"].replace(tzinfo=None) == dt.datetime(2023, 1, 5, 14, 30)
    assert got[0]["file"].endswith("IBM.csv")


XML = """<?xml version="1.0" encoding="UTF-8"?>
<ListForRating><ListInfo DateForm="2023-02-01" Quantity="3"/>
<Objects>
 <Buildings>
  <Building CadastralNumber="05:01:1" DateCreated="2020-01-02">
   <Area>05.50</Area><Name>дом\tодин</Name>
   <ExploitationChar YearBuilt="1990"/>
   <Location><Level1 Type="д" Value="4"/></Location>
   <ParentOKS><ExploitationChar YearBuilt="1950" YearUsed="1951"/>
    <ElementsConstruct><Material Wall="063"/></ElementsConstruct></ParentOKS>
   <ElementsConstruct><Material Wall="061"/></ElementsConstruct>
  </Building>
  <Building CadastralNumber="05:01:2"><ElementsConstruct><Material Wall="061"/><Material Wall="062"/></ElementsConstruct></Building>
 </Buildings>
 <Parcels><Parcel CadastralNumber="05:01:3"><Area><Area>7</Area></Area>
  <Location><Address><FIAS>f</FIAS><OKATO>o</OKATO><KLADR>k</KLADR><Note>note</Note><Street Type="ул" Name="Новая"/>
  <Level3 Type="стр" Value="7"/><Other>край</Other></Address></Location></Parcel></Parcels>
</Objects></ListForRating>"""


@pytest.fixture()
def registry_folder(tmp_path):
    deep = tmp_path / "in" / "deep"
    deep.mkdir(parents=True)
    (deep / "a.xml").write_bytes(b"\xef\xbb\xbf" + XML.replace("\n", "\r\n").encode())
    (tmp_path / "in" / "empty.xml").write_text("<ListForRating><ListInfo DateForm='2023-03-01'/><Objects/></ListForRating>")
    (tmp_path / "in" / "broken.xml").write_text("<ListForRating><Obj")
    (tmp_path / "in" / "a.txt").write_text("no")
    return str(tmp_path / "in")


def test_registry_documents(spark, registry_folder):
    docs = registry.read_registry_xml(spark, registry_folder)
    dates = {r["name"]: r["d"] for r in docs.select("name", form_date("options").alias("d")).collect()}
    assert dates == {"a.xml": dt.date(2023, 2, 1), "empty.xml": dt.date(2023, 3, 1), "broken.xml": None}
    objects = registry.registry_objects(docs).select("kind", "object.*").collect()
    assert [(r["kind"], r["@CadastralNumber"]) for r in objects] == [
        ("Building", "05:01:1"), ("Building", "05:01:2"), ("Parcel", "05:01:3")
    ]
    assert objects[0]["Name"] == "домодин" and len(objects[1]["ElementsConstruct"]["Material"]) == 2
    assert {r["name"]: r["options"] for r in docs.collect()}["a.xml"] == '{"@DateForm":"2023-02-01","@Quantity":3}'


def test_registry_objects_one_by_one(spark, registry_folder):
    whole = registry.registry_objects(registry.read_registry_xml(spark, registry_folder))
    parts = registry.read_registry_objects(spark, registry_folder)
    numbers = lambda df: sorted(r[0] for r in df.select("object.`@CadastralNumber`").collect())
    assert numbers(whole) == numbers(parts) == ["05:01:1", "05:01:2", "05:01:3"]


def big_document(n):
    building = lambda i: (
        f'<Building CadastralNumber="05:{i}" DateCreated="2020-01-02"><Name>a &gt; b "{i}"</Name>'
        f"<Location><Note>{'x' * (i * 37 % 400)}</Note></Location></Building>"
    )
    plots = "".join(f"<Parcel CadastralNumber='06:{i}' DateCreated='a>b'/>" for i in range(n))
    return (
        "<?xml version='1.0'?>\n<ListForRating>\n<ListInfo DateForm='2023-02-01'/><Objects><Buildings>"
        + "\n".join(building(i) for i in range(n)) + f"</Buildings><Flats/><Parcels>{plots}</Parcels></Objects></ListForRating>\n"
    )


@pytest.fixture()
def mixed_folder(tmp_path):
    whole = big_document(16)
    at = whole.index("</Building>", 1500)
    texts = {
        "good.xml": whole,
        "other.xml": big_document(3),
        "cut.xml": whole[: at - 20],
        "between.xml": whole[: at + 11],
        "crossed.xml": whole.replace("</Location></Building>", "</Building></Location>", 1),
        "twice.xml": whole.replace("</Building>", "</Building></Building>", 1),
        "open.xml": whole.replace("</Buildings>", ""),
        "none.xml": "",
        "page.xml": "<html></html>",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


BROKEN = {
    "cut.xml": "no end of <Building>",
    "between.xml": "no end of <Buildings>",
    "crossed.xml": "<Building> not well-formed",
    "twice.xml": "unexpected </Building>",
    "open.xml": "no end of <Buildings>",
    "page.xml": "no registry document",
}


@pytest.mark.parametrize("split", ["128m", "450"])
def test_elements_of_files_that_tasks_share(spark, mixed_folder, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        objects, problems = registry.read_registry_elements(spark, mixed_folder)
        rows = [(r["name"], r["kind"], r["n"], r["note"], r["options"]) for r in objects.select(
            "name", "kind", F.col("object.`@CadastralNumber`").alias("n"), F.col("object.Location.Note").alias("note"), "options").collect()]
        log = {r["file_name"]: r["description"] for r in registry.file_rejects(problems, "request_file", F.current_timestamp()).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # Nothing of a broken file, everything of a sound one, whatever the splits.
    assert log == BROKEN
    want = [("good.xml", "Building", f"05:{i}", "x" * (i * 37 % 400)) for i in range(16)] + [("good.xml", "Parcel", f"06:{i}", None) for i in range(16)]
    want += [("other.xml", "Building", f"05:{i}", "x" * (i * 37 % 400)) for i in range(3)] + [("other.xml", "Parcel", f"06:{i}", None) for i in range(3)]
    assert sorted(map(str, (r[:4] for r in rows))) == sorted(map(str, want))
    assert {r[4] for r in rows} == {'{"@DateForm":"2023-02-01"}'}


def test_broken_documents_are_logged_whole(spark, mixed_folder):
    docs = registry.read_registry_xml(spark, mixed_folder)
    objects = registry.registry_objects(docs)
    assert {r["name"] for r in objects.select("name").distinct().collect()} == {"good.xml", "other.xml"}
    log = registry.file_rejects(docs, "request_file", F.current_timestamp()).collect()
    assert {r["file_name"] for r in log} == {"cut.xml", "between.xml", "crossed.xml", "twice.xml", "open.xml", "page.xml"}
    assert {r["src"] for r in log} == {"request_file"}


def test_parcels_by_element(spark, mixed_folder):
    objects = registry.read_registry_objects(spark, mixed_folder).withColumn("request_file_id", F.lit(1))
    parcels = reg.parse_objects(objects, spark.createDataFrame([], "code string, value string"))
    assert parcels.count() == 38 and {str(r[0]) for r in parcels.select("date_rosreestr_out").collect()} == {"2023-02-01"}


def test_parse_objects(spark, registry_folder):
    objects = registry.registry_objects(registry.read_registry_xml(spark, registry_folder)).withColumn("request_file_id", F.lit(1))
    classifier = spark.createDataFrame([("061", "stone")], "code string, value string")
    got = {r["cad_num"]: r for r in reg.parse_objects(objects, classifier).collect()}
    first, second, third = got["05:01:1"], got["05:01:2"], got["05:01:3"]
    # Own years are not mixed up with those of the parent.
    assert (first["year_built"], first["year_used"]) == ("1990", None)
    assert (first["parent_year_built"], first["parent_year_used"]) == ("1950", "1951")
    assert (first["area"], third["area"]) == ("05.50", "7")
    assert (first["wall"], second["wall"], third["wall"]) == ("stone,063", "stone,062", None)
    assert (first["address2"], third["address1"], third["address2"]) == ("д 4", "note", "ул Новая стр 7 край")
    assert (third["fias"], third["okato"], third["kladr"]) == ("f", "o", "k")


def test_result_files(spark, tmp_path):
    cost = (
        "<R><Package><Federal><Cadastral_Regions><Cadastral_Region><Cadastral_Districts><Cadastral_District>"
        "<Cadastral_Blocks><Cadastral_Block><Parcels><Parcel CadastralNumber='05:1'><Ground_Payments>"
        "<CadastralCost Value='12,5'/><Specific_CadastralCost Value='3'/></Ground_Payments></Parcel>"
        "<Parcel CadastralNumber='05:2'/></Parcels></Cadastral_Block></Cadastral_Blocks></Cadastral_District>"
        "</Cadastral_Districts></Cadastral_Region></Cadastral_Regions></Federal></Package></R>"
    )
    groups = (
        "<R><Groups_Real_Estate><Group_Real_Estate><ID_Group>1</ID_Group><Name_Group>houses</Name_Group></Group_Real_Estate>"
        "</Groups_Real_Estate><Real_Estates><Real_Estate ID_Group='1'><CadastralNumber>05:1</CadastralNumber></Real_Estate>"
        "<Real_Estate ID_Group='9'><CadastralNumber>05:2</CadastralNumber></Real_Estate></Real_Estates></R>"
    )
    (tmp_path / "COST_1.xml").write_text(cost)
    (tmp_path / "FD_1.xml").write_text(groups)
    (tmp_path / "OTHER.xml").write_text("<R/>")
    known, unknown = registry.read_result_xml(spark, str(tmp_path))
    assert sorted((r["name"], r["kind"]) for r in known.collect()) == [("COST_1.xml", "cost"), ("FD_1.xml", "fd")]
    assert [r["name"] for r in unknown.collect()] == ["OTHER.xml"]

    texts = known.withColumn("response_id", F.lit(5)).withColumn("response_file_id", F.lit(8))
    in_text = registry.cost_records(texts.filter("kind = 'cost'").select("response_id", "response_file_id", "text"))
    found_groups, members = registry.group_records(texts.filter("kind = 'fd'").select("response_id", "text"))
    got = {r["cad_num"]: r for r in reg.result_parcels(in_text, found_groups, members).collect()}
    assert float(got["05:1"]["cost"]) == 12.5 and got["05:1"]["group"] == "houses"
    assert got["05:2"]["cost"] is None and got["05:2"]["group"] is None

    by_row = registry.read_cost_xml(spark, str(tmp_path)).drop("path")
    assert sorted(map(str, by_row.collect())) == sorted(map(str, in_text.drop("response_id", "response_file_id").collect()))
    row_groups, row_members = registry.read_group_xml(spark, str(tmp_path))
    assert row_groups.count() == 1 and row_members.count() == 2


def test_sheets(spark):
    def sheet(file, preamble, header, data):
        rows = [["Title", None, None]] * preamble + [header] + data
        return [(file, "S", i, r) for i, r in enumerate(rows)]

    rows = [
        *sheet("three.xlsx", 3, ["a", "key", None, "Key", None], [["1", "x", "y"], [None, "z", None, "4", "5", "6"]]),
        *sheet("none.xlsx", 0, ["a", "key"], [["1", "x"]]),
        *sheet("blank.xlsx", 1, ["only", " "], [["1", None]]),
    ]
    df = spark.createDataFrame(rows, SHEET_ROWS)
    headers = {r["file"]: r for r in sheets.sheet_headers(df).collect()}
    assert headers["three.xlsx"]["names"] == ["A", "KEY", "NAN0", "KEY1", "NAN2"]
    assert headers["three.xlsx"]["found"] and not headers["none.xlsx"]["found"]
    # The data row counts as header there, as nothing above has a second cell.
    assert "blank.xlsx" not in headers
    data = sheets.read_sheet_rows(df).orderBy("file", "row_no").collect()
    assert [r["record"] for r in data] == [
        {"A": "1", "KEY": "x", "NAN0": "y", "KEY1": None, "NAN2": None},
        {"A": None, "KEY": "z", "NAN0": None, "KEY1": "4", "NAN2": "5"},
    ]
    assert sheets.read_sheet_rows(df, need_preamble=False).count() == 3


def test_codes_without_key_column(spark):
    rows = [
        ("a.xlsx", "ОКС", 0, ["x", None]), ("a.xlsx", "ОКС", 1, ["Код", "Кадастровый № ОКС"]), ("a.xlsx", "ОКС", 2, ["7", "05:1"]),
        ("a.xlsx", "ОКС", 3, ["8", None]), ("a.xlsx", "ЗУ", 0, ["x", None]), ("a.xlsx", "ЗУ", 1, ["код", "другое"]),
        ("a.xlsx", "ЗУ", 2, ["9", "05:2"]), ("a.xlsx", "Лист3", 1, ["код", "КАД №"]),
    ]
    got = reg.load_codes(spark.createDataFrame(rows, SHEET_ROWS)).collect()
    assert [tuple(r) for r in got] == [("a.xlsx", "7", "05:1")]


def test_binary_files(spark, tmp_path):
    for path, content in {
        "2023-05-06 x/b.png": b"png", "2023-05-06 x/in/a.pdf": b"pdf", "y/only.PNG": b"png", "z/none.txt": b"x", "top.pdf": b"top",
    }.items():
        target = tmp_path / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)
    root = str(tmp_path)
    got = {r["folder"]: bytes(r["content"]) for r in files.read_binary_files(spark, f"file:{root}").collect()}
    assert {k.replace("%20", " "): v for k, v in got.items()} == {"2023-05-06 x": b"pdf", "y": b"png"}
    listing = files.list_files(spark, root)
    assert {r["name"] for r in listing.collect()} == {"b.png", "a.pdf", "only.PNG", "none.txt", "top.pdf"}


def test_lines(spark, tmp_path):
    (tmp_path / "terms.txt").write_text("один \n\nдва")
    assert [r["term"] for r in files.read_line_list(spark, str(tmp_path / "terms.txt")).collect()] == ["один", "два"]
    (tmp_path / "a.mid").write_text("5,x\n6,y\n")
    got = files.read_lines(spark, str(tmp_path), "*.mid").collect()
    assert [(r["line_no"], r["line"]) for r in got] == [(1, "5,x"), (2, "6,y")]


def test_classifier(spark, tmp_path):
    (tmp_path / "c.csv").write_text("code,value\n 1 ,one\n2,two\n")
    got = files.load_classifier(spark, str(tmp_path / "c.csv")).collect()
    assert {tuple(r) for r in got} == {("1", "one"), ("2", "two")}


@pytest.mark.parametrize(
    "message, complete",
    [
        ('{"object_id":"1","object_type":"T","sent_dttm":"2023-01-01 00:00:00","payload":{"a":1}}', True),
        ('{"object_id":"1","object_type":"T","sent_dttm":"2023-01-01 00:00:00"}', False),
        ("{broken", False),
        ("", False),
    ],
)
def test_envelope(spark, message, complete):
    df = spark.createDataFrame([(bytearray(message, "utf-8"),)], "value binary")
    row = events.decode_envelope(df).na.drop("any").collect()
    assert bool(row) == complete
    if complete:
        assert row[0]["payload"] == '{"a":"1"}'


PAGE = """<html><body><div itemprop="address">
 улица
 Мира, 5</div><ul data-marker="item-params"><li>A: 1<li>B: 2</li></ul>
<br><p data-marker="x/item-params">C &amp; D</p><span itemprop="price" content="12"/>
<script>var x = '<div itemprop="name">no</div>';</script></body>"""


def test_page_fields():
    fields = {
        "address": pages.Field("div", "itemprop", "address"),
        "params": pages.Field(None, "data-marker", "item-params", part=True, many=True),
        "price": pages.Field("span", "itemprop", "price", take="content"),
        "name": pages.Field("div", "itemprop", "name"),
    }
    got = pages.read_fields(PAGE, fields)
    assert got == {"address": "улица Мира, 5", "params": "A: 1\nB: 2C & D", "price": "12", "name": None}
    assert pages.read_fields(None, fields) == dict.fromkeys(fields)
    assert pages.read_fields("</div></p><", fields)["address"] is None


def test_links(spark):
    html = '<a data-marker="item-title" href="/a_1">x</a><a href="/b_2">y</a><area href="/c"><a class="z">n</a>'
    df = spark.createDataFrame([(html,)], "html string")
    assert [r[0] for r in pages.list_links(df).collect()] == ["/a_1", "/b_2"]
    assert [r[0] for r in pages.list_links(df, marker="item-title").collect()] == ["/a_1"]


def test_listing_shows_hidden_and_empty_files(spark, tmp_path):
    for name in ("a/x.txt", "a/deep/.success", "b/.success", "c/empty.txt", "top.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("" if "empty" in name or "success" in name else "text")
    got = {(r["path"].removeprefix(f"{tmp_path}/"), r["name"], r["length"]) for r in listing.list_all_files(spark, str(tmp_path), tasks=2).collect()}
    assert got == {("a/x.txt", "x.txt", 4), ("a/deep/.success", ".success", 0), ("b/.success", ".success", 0), ("c/empty.txt", "empty.txt", 0), ("top.txt", "top.txt", 4)}
    folders = listing.list_all_files(spark, str(tmp_path)).withColumn("folder", files.folder_below("path", str(tmp_path))).where("folder IS NOT NULL")
    assert [r["folder"] for r in files.unmarked_folders(folders).collect()] == ["c"]
    listing.mark_folders(files.unmarked_folders(folders), str(tmp_path))
    assert (tmp_path / "c" / ".success").exists() and files.unmarked_folders(folders).count() == 0
    assert listing.list_all_files(spark, str(tmp_path / "none")).count() == 0


def test_folder_headers(spark, tmp_path):
    for name in ("list 2024-02-03/a.png", "list 2024-02-03/b.pdf", "other/c.xml", "hidden/.success"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    run = F.lit("2024-05-06").cast("date")
    rows = {r["request_name"]: r for r in files.folder_headers(listing.list_all_files(spark, str(tmp_path)), str(tmp_path), run, 16, "7").collect()}
    first = rows["list 2024-02-03"]
    assert (str(first["request_date"]), first["request_reg_num"], first["files"]) == ("2024-02-03", "7", 2)
    assert first["request_pdf"].endswith("b.pdf") and first["request_description"] == f"{tmp_path}/list 2024-02-03"
    assert (rows["other"]["request_pdf"], str(rows["other"]["request_date"]), rows["hidden"]["files"]) == ("", "2024-05-06", 0)


def test_small_files_share_tasks_and_what_is_cut_from_them_few_files(spark, tmp_path):
    """400 folders of a file each; by Spark's settings 40 tasks would list them and about 100 cut them."""
    from tidemark.sources import elements

    kept = []
    keys = ["spark.sql.files.openCostInBytes", "spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.maxPartitionBytes"]
    before = {k: spark.conf.get(k) for k in keys}
    for i in range(400):
        folder = tmp_path / "in" / f"request={i}"
        folder.mkdir(parents=True)
        (folder / "part.xml").write_text(f"<Parcels><Parcel>{i}</Parcel></Parcels>")
    cut = elements.cut_lineage
    elements.cut_lineage = lambda df, name: kept.append(cut(df, name)) or kept[-1]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    try:
        found = elements.xml_elements(spark, str(tmp_path / "in"), ["Parcel"], ["Parcels"])
    finally:
        elements.cut_lineage = cut
        spark.conf.set("spark.sql.files.maxPartitionBytes", before["spark.sql.files.maxPartitionBytes"])
    texts = sorted(r.text for r in found.where("text IS NOT NULL").collect())
    assert texts == sorted(f"<Parcel>{i}</Parcel>" for i in range(400))
    assert found.where("problem IS NOT NULL").isEmpty()
    assert len(kept[0].inputFiles()) < 40
    assert {k: spark.conf.get(k) for k in keys} == before


def test_settings_of_small_files_are_put_back_and_never_raised(spark):
    from tidemark.scale import _SMALL_FILES, many_small_files

    before = {k: spark.conf.get(k) for k in _SMALL_FILES}
    try:
        for cost, parallel, wanted in (("4194304", "10000", ["65536", "256"]), ("1k", "7", ["1024", "7"]), ("2mb", "300", ["65536", "256"])):
            for key, value in zip(_SMALL_FILES, (cost, parallel), strict=True):
                spark.conf.set(key, value)
            with many_small_files(spark):
                assert [spark.conf.get(k) for k in _SMALL_FILES] == wanted
            assert [spark.conf.get(k) for k in _SMALL_FILES] == [cost, parallel]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
