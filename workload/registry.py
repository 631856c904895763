"""Queries over registry documents, sheets, lookups and files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import documents as doc
from tidemark.functions import lookup, temporal, text
from tidemark.operators import aggregates as agg
from tidemark.operators import filters as flt
from tidemark.operators import joins, lines, sets
from tidemark.operators.paging import renumber
from tidemark.plans import registry as reg
from tidemark.schemas import KEY_PARAMETERS, PARCEL_COLUMNS
from tidemark.scale import scratch_path, spread
from tidemark.sinks import write
from tidemark.sources import files, listing, sheets
from tidemark.sources import registry as src
from workload import views
from workload.base import Registry, plain
from workload.views import sql, table

QUERIES = Registry()
query = QUERIES.query

# --- sheets -------------------------------------------------------------------------


@query(
    "sheet_header_rows",
    sql("code_sheets", """
    SELECT DISTINCT file, sheet, 2 AS header_row, s_nationkey % 5 <> 0 AS found,
           CASE WHEN sheet = 'ОКС' THEN '№,КАДАСТРОВЫЙ № ОКС,КОД,NAN0,КОД1' ELSE '№,КАД №,КОД,NAN0,КОД1' END AS names
    FROM code_sheets"""),
)
def sheet_header_rows(spark, sf):
    headers = sheets.sheet_headers(views.code_sheets(spark, sf))
    return headers.withColumn("names", F.array_join("names", ","))


@query(
    "sheet_rows",
    sql("code_sheets", """
    SELECT file, sheet, row_no, cast(s_suppkey AS varchar) AS first, s_name AS blank_name, 'again' AS repeated
    FROM code_sheets WHERE s_nationkey % 5 <> 0"""),
)
def sheet_rows(spark, sf):
    rows = sheets.read_sheet_rows(views.code_sheets(spark, sf))
    cell = lambda name: F.try_element_at("record", F.lit(name))
    return rows.select(
        "file", "sheet", "row_no", cell("№").alias("first"), cell("NAN0").alias("blank_name"), cell("КОД1").alias("repeated")
    )


@query(
    "sheet_codes_union",
    sql("code_sheets", """
    SELECT file, cast(s_nationkey AS varchar) AS code, cad_num FROM code_sheets
    WHERE cad_num IS NOT NULL AND s_nationkey <> 7"""),
)
def sheet_codes_union(spark, sf):
    """Codes of both sheets, of workbooks not in the ledger."""
    name = F.concat(F.lit("codes_"), F.col("n_nationkey").cast("string"), F.lit(".xlsx"))
    known = table(spark, sf, "nation").filter(F.col("n_name") == "NATION_7").select(name.alias("file"))
    return reg.load_codes(views.code_sheets(spark, sf), known)


@query(
    "sheets_union_renamed",
    sql("code_sheets", """
    SELECT cad_num, cast(s_nationkey AS varchar) AS code, sheet FROM code_sheets"""),
)
def sheets_union_renamed(spark, sf):
    rows = sheets.read_sheet_rows(views.code_sheets(spark, sf), need_preamble=False)

    def of(sheet, header):
        wide = rows.filter(F.col("sheet") == sheet)
        return wide.select("sheet", F.try_element_at("record", F.lit(header)).alias(header), F.try_element_at("record", F.lit("КОД")).alias("КОД"))

    return sets.union_renamed(
        [
            (of(sheet, header), {header: "cad_num", "КОД": "code", "sheet": "sheet"})
            for sheet, header in reg.CODE_SHEETS.items()
        ]
    )


@query(
    "act_counts",
    """SELECT 'act_' || c_nationkey || '.ods' AS file,
              count(*) FILTER (c_acctbal >= 0 AND c_mktsegment <> 'BUILDING') AS count_ok,
              count(*) FILTER (c_acctbal < 0 AND c_mktsegment <> 'BUILDING' AND c_nationkey % 7 <> 1) AS count_bad
       FROM customer WHERE c_nationkey % 5 <> 0 GROUP BY c_nationkey""",
)
def act_counts(spark, sf):
    return reg.load_act_counts(views.act_sheets(spark, sf))


@query(
    "sheet_non_null_counts",
    """SELECT c_nationkey, count(*) FILTER (c_mktsegment <> 'BUILDING') AS filled FROM customer GROUP BY 1""",
)
def sheet_non_null_counts(spark, sf):
    people = table(spark, sf, "customer")
    filled = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey"))
    return agg.non_null_count(people, ["c_nationkey"], filled, "filled")


# --- lookups ---------------------------------------------------------------------------


@query(
    "map_class",
    sql("classifier", """
    SELECT p_partkey, CASE WHEN c.code IS NULL THEN ' ' || p_size || ' ' ELSE c.value END AS kind
    FROM part LEFT JOIN classifier c ON c.code = trim(' ' || p_size || ' ')"""),
)
def map_class(spark, sf):
    """Codes with blanks around them; unknown ones stay as they were."""
    parts = table(spark, sf, "part").select("p_partkey", F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" ")).alias("kind"))
    return lookup.map_class(parts, "kind", views.classifier(spark, sf))


def _code_lists(spark, sf):
    codes = F.array(
        F.col("p_size").cast("string"),
        F.lit(None).cast("string"),
        F.concat(F.lit(" "), (F.col("p_partkey") % 40).cast("string")),
    )
    return table(spark, sf, "part").select("p_partkey", codes.alias("codes"))


_CLASS_LIST = sql("classifier", """
    SELECT p_partkey, concat_ws(',', coalesce(a.value, cast(p_size AS varchar)),
                                coalesce(b.value, cast(p_partkey % 40 AS varchar))) AS codes
    FROM part LEFT JOIN classifier a ON a.code = cast(p_size AS varchar)
    LEFT JOIN classifier b ON b.code = cast(p_partkey % 40 AS varchar)""")


@query("map_class_array", _CLASS_LIST)
def map_class_array(spark, sf):
    return lookup.map_class_array(_code_lists(spark, sf), "codes", views.classifier(spark, sf), ["p_partkey"])


@query("map_class_array_joined", _CLASS_LIST)
def map_class_array_joined(spark, sf):
    """The same over rows without a key of their own."""
    return lookup.map_class_arrays(_code_lists(spark, sf), {"codes": "codes"}, views.classifier(spark, sf))


@query(
    "map_class_array_null_code",
    "SELECT p_partkey, 'null,' || CASE WHEN p_size % 2 = 0 THEN 'even' ELSE 'odd' END AS codes FROM part",
)
def map_class_array_null_code(spark, sf):
    """A classifier row without code matches nothing, not the text "null"."""
    sizes = table(spark, sf, "part").select((F.col("p_size") % 2).cast("string").alias("code")).distinct()
    names = sizes.select("code", F.when(F.col("code") == "0", "even").otherwise("odd").alias("value"))
    names = names.unionByName(names.limit(1).select(F.lit(None).cast("string").alias("code"), F.lit("ZZ").alias("value")))
    codes = F.array(F.lit("null"), (F.col("p_size") % 2).cast("string")).alias("codes")
    return lookup.map_class_array(table(spark, sf, "part").select("p_partkey", codes), "codes", names, ["p_partkey"])


@query(
    "coalesce_alternatives",
    """SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN '07:' || s_suppkey ELSE '07:' || s_suppkey END AS cad_num,
              cast(s_suppkey % 30 AS varchar) AS category, CASE WHEN s_suppkey % 2 = 0 THEN '7' ELSE '8' END AS volume
       FROM supplier""",
)
def coalesce_alternatives(spark, sf):
    rows = views.registry_records(spark, sf)
    columns = {n: reg.SHEET_ALTERNATIVES[n] for n in ("cad_num", "category", "volume")}
    return rows.select(
        (-1 - F.col("request_file_id")).alias("s_suppkey"),
        *[doc.alternatives("record", names).alias(target) for target, names in columns.items()],
    )


# --- documents ------------------------------------------------------------------------------


def _objects(spark, sf):
    texts = views.registry_texts(spark, sf).withColumn("text", text.strip_control(text.strip_bom("text")))
    return src.registry_objects(src.parse_registry(texts))


@query(
    "registry_objects",
    """SELECT p_partkey AS request_file_id, kind, '05:' || p_partkey || ':' || n AS cad_num, DATE '2023-05-06' AS form_date
       FROM part, (VALUES ('Construction', 1), ('Parcel', 2)) k(kind, n)""",
)
def registry_objects(spark, sf):
    return _objects(spark, sf).select(
        "request_file_id", "kind", F.col("object.`@CadastralNumber`").alias("cad_num"), temporal.form_date("options").alias("form_date")
    )


@query(
    "key_parameter_pivot",
    sql("part_lines", "SELECT p_partkey AS request_file_id, " + ", ".join(
        f"cast(k{int(code)} AS varchar) AS {name}" for code, name in KEY_PARAMETERS.items()) + " FROM part_lines"),
)
def key_parameter_pivot(spark, sf):
    objects = _objects(spark, sf).filter(F.col("kind") == "Construction")
    pairs = F.flatten(F.transform("object.KeyParameters", lambda k: k["KeyParameter"]))
    return objects.select("request_file_id", *doc.pivot_codes(pairs, KEY_PARAMETERS))


@query(
    "key_value_rows_pivot",
    """SELECT l_orderkey, min(l_quantity) FILTER (l_returnflag = 'A') AS returned_a,
              min(l_quantity) FILTER (l_returnflag = 'R') AS returned_r FROM lineitem GROUP BY 1""",
)
def key_value_rows_pivot(spark, sf):
    return agg.pivot_rows(
        table(spark, sf, "lineitem"), ["l_orderkey"], "l_returnflag", "l_quantity", {"A": "returned_a", "R": "returned_r"}
    )


_TEXT = "cast(NULL AS varchar) AS {}"
_CODED = "coalesce({0}.value, cast({1} AS varchar))"
_XML_PARCELS = """
    SELECT '05:' || p_partkey || ':1' AS cad_num, 'near' || p_name AS address1,
           concat_ws(' ', 'р-н', p_brand, 'ул', p_type, 'д', p_size, CASE WHEN p_size > 25 THEN 'корп' || p_size END) AS address2,
           NULL AS category, '05:' || p_size AS cad_num_quarter,
           CASE WHEN p_size = 13 THEN '2020-02-31' ELSE '2020-02-03' END AS date_created, NULL AS inner_cadastral_numbers,
           NULL AS cost_old, NULL AS utilization_cod_old, NULL AS utilization, NULL AS utilization_doc,
           coalesce(c.value, cast(p_size AS varchar)) AS purpose, coalesce(c.value, cast(p_size AS varchar)) AS vid,
           p_name AS name, cast(p_retailprice AS varchar) AS area,
           concat_ws(',', coalesce(c.value, cast(p_size AS varchar)),
                     CASE WHEN p_size % 2 = 0 THEN coalesce(k.value, cast(p_partkey % 30 AS varchar)) END) AS wall,
           'f-' || p_partkey AS fias, cast(NULL AS varchar) AS okato, cast(1950 + p_size AS varchar) AS year_built,
           cast(1951 + p_size AS varchar) AS year_used,
           {params}, DATE '2023-05-06' AS date_rosreestr_out, p_partkey AS request_file_id
    FROM part_lines p LEFT JOIN classifier c ON c.code = cast(p_size AS varchar)
    LEFT JOIN classifier k ON k.code = cast(p_partkey % 30 AS varchar)
    UNION ALL
    SELECT '05:' || p_partkey || ':2', 'by ' || p_brand, concat_ws(' ', 'ул', p_type, 'стр', p_size, 'край'),
           coalesce(c.value, cast(p_size AS varchar)), NULL, NULL,
           '05:' || p_partkey || ':1', cast(p_retailprice AS varchar), coalesce(k.value, cast(p_partkey % 30 AS varchar)),
           '["' || p_type || '", "' || p_brand || '"]', p_type, NULL, NULL, NULL, cast(p_size AS varchar), NULL, 'g-' || p_partkey,
           cast(p_size AS varchar), NULL, NULL, {nulls}, DATE '2023-05-06', p_partkey
    FROM part p LEFT JOIN classifier c ON c.code = cast(p_size AS varchar)
    LEFT JOIN classifier k ON k.code = cast(p_partkey % 30 AS varchar)""".format(
    params=", ".join(f"cast(k{int(code)} AS varchar) AS {name}" for code, name in KEY_PARAMETERS.items()),
    nulls=", ".join("NULL" for _ in KEY_PARAMETERS),
)
_SHEET_PARCELS = """
    SELECT '07:' || s_suppkey AS cad_num, s_name AS address1, coalesce(c.value, cast(s_suppkey % 30 AS varchar)) AS category,
           coalesce(n.value, cast(s_nationkey AS varchar)) AS purpose, 'building' AS vid, cast(s_suppkey AS varchar) AS area,
           concat_ws(',', CASE WHEN s_suppkey % 3 = 0 THEN coalesce(n.value, cast(s_nationkey AS varchar)) END,
                     coalesce(c.value, cast(s_suppkey % 30 AS varchar))) AS wall,
           CASE WHEN s_suppkey % 2 = 0 THEN '7' ELSE '8' END AS volume,
           DATE '2023-07-08' AS date_rosreestr_out, -1 - s_suppkey AS request_file_id
    FROM supplier LEFT JOIN classifier c ON c.code = cast(s_suppkey % 30 AS varchar)
    LEFT JOIN classifier n ON n.code = cast(s_nationkey AS varchar)"""
_EMPTY_PARCELS = "SELECT " + ", ".join(
    f"cast(NULL AS {kind}) AS {name}"
    for name in PARCEL_COLUMNS
    for kind in ["date" if name == "date_rosreestr_out" else "bigint" if name == "request_file_id" else "varchar"]
) + " WHERE false"


def _parcels(spark, sf):
    return reg.parse_parcels(_objects(spark, sf), views.registry_records(spark, sf), views.classifier(spark, sf))


_PARCELS = "SELECT * FROM empty UNION ALL BY NAME SELECT * FROM xml UNION ALL BY NAME SELECT * FROM sheet"


@query(
    "parcel_documents",
    sql("classifier part_lines", "SELECT * FROM empty UNION ALL BY NAME SELECT * FROM xml", empty=_EMPTY_PARCELS, xml=_XML_PARCELS),
)
def parcel_documents(spark, sf):
    return reg.parse_objects(_objects(spark, sf), views.classifier(spark, sf))


@query(
    "parcel_sheets",
    sql("classifier", """SELECT cad_num, address1, category, purpose, vid, area, wall, volume, date_rosreestr_out, request_file_id
    FROM sheet""", sheet=_SHEET_PARCELS),
)
def parcel_sheets(spark, sf):
    parsed = reg.parse_sheet_records(views.registry_records(spark, sf), views.classifier(spark, sf))
    return parsed.select(
        "cad_num", "address1", "category", "purpose", "vid", "area", "wall", "volume", "date_rosreestr_out", "request_file_id"
    )


@query(
    "parcel_union",
    sql("classifier part_lines", _PARCELS, empty=_EMPTY_PARCELS, xml=_XML_PARCELS, sheet=_SHEET_PARCELS),
)
def parcel_union(spark, sf):
    return _parcels(spark, sf)


@query(
    "parcel_load",
    sql("classifier part_lines", f"""
    SELECT * REPLACE (cast(date_created AS timestamp) AS date_created, cast(foundation_date AS timestamp) AS foundation_date)
    FROM ({_PARCELS}) WHERE request_file_id NOT IN (SELECT p_partkey FROM part WHERE p_size = 13)""",
        empty=_EMPTY_PARCELS, xml=_XML_PARCELS, sheet=_SHEET_PARCELS),
)
def parcel_load(spark, sf):
    """Files with an impossible date are kept out whole."""
    good, _ = reg.load_parcels(_parcels(spark, sf), F.lit("2024-01-01").cast("timestamp_ntz"))
    return good.withColumns({c: F.col(c).cast("timestamp_ntz") for c in reg.PARCEL_DATES})


@query(
    "parcel_rejects",
    """SELECT 'parcel' AS table_name, 'date_created: 2020-02-31' AS description, 'request_file' AS src,
              cast(NULL AS varchar) AS file_name, cast(p_partkey AS varchar) AS row, TIMESTAMP '2024-01-01' AS date
       FROM part WHERE p_size = 13""",
)
def parcel_rejects(spark, sf):
    return reg.load_parcels(_parcels(spark, sf), F.lit("2024-01-01").cast("timestamp_ntz"))[1]


# Files of parts that are read whole; of those that end too soon or hold an unclosed location nothing is.
_SOUND = f"p_partkey // {views.FILE_PARTS} % 11 NOT IN (3, 5)"


def _file_number(path: str):
    return F.regexp_extract(path, "request=([0-9]+)", 1).cast("bigint")


@query(
    "registry_files",
    f"""SELECT p_partkey // {views.FILE_PARTS} AS request, kind, '05:' || p_partkey || ':' || n AS cad_num, DATE '2023-05-06' AS form_date
        FROM part, (VALUES ('Construction', 1), ('Parcel', 2)) k(kind, n) WHERE {_SOUND}""",
)
def registry_files(spark, sf):
    """Objects of a folder of files, some of them broken."""
    objects = src.registry_objects(src.read_registry_xml(spark, views.registry_folder(spark, sf), glob="*.txt"))
    return objects.select(
        _file_number("path").alias("request"), "kind", F.col("object.`@CadastralNumber`").alias("cad_num"),
        temporal.form_date("options").alias("form_date"),
    )


_FILE_REJECTS = f"""
    SELECT 'request_file' AS src, request, {{}} AS description
    FROM (SELECT DISTINCT p_partkey // {views.FILE_PARTS} AS request FROM part) WHERE request % 11 IN (3, 5)"""


@query("registry_file_rejects", _FILE_REJECTS.format("'not well-formed'"))
def registry_file_rejects(spark, sf):
    """One log entry per broken file."""
    docs = src.read_registry_xml(spark, views.registry_folder(spark, sf), glob="*.txt")
    # Their folder tells the files of this query apart.
    log = src.file_rejects(docs.withColumn("path", F.element_at(F.split("path", "/"), -2)), "request_file", F.current_timestamp())
    return log.select("src", _file_number("file_name").alias("request"), "description")


@query(
    "registry_element_rejects",
    _FILE_REJECTS.format("CASE request % 11 WHEN 3 THEN 'no end of <Construction>' ELSE '<Parcel> not well-formed' END"),
)
def registry_element_rejects(spark, sf):
    """The same files, told by their elements."""
    _, problems = src.read_registry_elements(spark, views.registry_folder(spark, sf), glob="*.txt")
    log = src.file_rejects(problems.withColumn("path", F.element_at(F.split("path", "/"), -2)), "request_file", F.current_timestamp())
    return log.select("src", _file_number("file_name").alias("request"), "description")


@query(
    "parcel_by_element",
    sql("classifier part_lines", f"""
    SELECT * REPLACE (request_file_id // {views.FILE_PARTS} AS request_file_id)
    FROM (SELECT * FROM empty UNION ALL BY NAME SELECT * FROM xml)
    WHERE request_file_id // {views.FILE_PARTS} % 11 NOT IN (3, 5)""", empty=_EMPTY_PARCELS, xml=_XML_PARCELS),
)
def parcel_by_element(spark, sf):
    """Parcels of the sound files, cut out of them element by element."""
    objects = src.read_registry_objects(spark, views.registry_folder(spark, sf), glob="*.txt")
    return reg.parse_objects(objects.withColumn("request_file_id", _file_number("path")), views.classifier(spark, sf))


@query(
    "address_concat",
    """SELECT s_suppkey, trim(regexp_replace(concat(coalesce(CASE WHEN s_acctbal > 0 THEN n_name END, ''), ' ', 'r-n', '   ',
              coalesce(r_name, ''), ' ', coalesce(CASE WHEN s_suppkey % 2 = 0 THEN s_name END, '')), '\\s+', ' ', 'g')) AS address
       FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
def address_concat(spark, sf):
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    parts = [
        F.when(F.col("s_acctbal") > 0, F.col("n_name")), " ", "r-n", "   ", F.col("r_name"), " ",
        F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")),
    ]
    return rows.select("s_suppkey", text.spaced_line(parts).alias("address"))


def _json_docs(spark, sf):
    """A document per part: two buildings in a list, and a plot that stands alone."""
    box = lambda n: F.struct((F.col("p_partkey") * 10 + n).alias("@Number"), F.col("p_type").alias("Type"))
    shape = F.struct(
        F.struct(F.array(box(1), box(2)).alias("Building")).alias("Buildings"),
        F.struct(box(3).alias("Parcel")).alias("Parcels"),
    )
    text_ = F.to_json(F.struct(shape.alias("Objects"), F.col("p_name").alias("Title")))
    return table(spark, sf, "part").select("p_partkey", text_.alias("text"))


@query(
    "json_path_wildcard",
    "SELECT p_partkey, cast(p_partkey * 10 + n AS varchar) AS number, p_type AS type FROM part, (VALUES (1), (2), (3)) k(n)",
)
def json_path_wildcard(spark, sf):
    docs = _json_docs(spark, sf).select("p_partkey", doc.parse_document("text").alias("doc"))
    found = doc.json_path_all(docs, "doc", ["Objects", "*", "*", "[*]"])
    return found.select(
        "p_partkey", doc.json_text("obj", '$["@Number"]').alias("number"), doc.json_path("obj", "$.Type").alias("type")
    )


@query("json_path_recursive", "SELECT p_partkey, cast(p_partkey * 30 + 6 AS bigint) AS total, 3 AS found FROM part")
def json_path_recursive(spark, sf):
    docs = _json_docs(spark, sf).select("p_partkey", doc.parse_document("text").alias("doc"))
    numbers = F.transform(doc.json_find("doc", "@Number"), lambda v: F.try_variant_get(v, "$", "bigint"))
    found = docs.select("p_partkey", numbers.alias("n"))
    total = F.aggregate("n", F.lit(0).cast("bigint"), lambda a, b: a + b)
    return found.select("p_partkey", total.alias("total"), F.size("n").alias("found"))


@query("json_path_recursive_deep", "SELECT p_partkey, cast(p_partkey * 45 AS bigint) AS total, 9 AS found FROM part")
def json_path_recursive_deep(spark, sf):
    """Nine levels, each with the member."""
    text_ = F.lit("null")
    for level in range(9, 0, -1):
        number = (F.col("p_partkey") * level).cast("string")
        text_ = F.concat(F.lit('{"@Number":'), number, F.lit(',"in":[{"x":'), text_, F.lit("}]}"))
    docs = spread(table(spark, sf, "part"), "p_partkey").select("p_partkey", doc.parse_document(text_).alias("doc"))
    numbers = F.transform(doc.json_find("doc", "@Number"), lambda v: F.try_variant_get(v, "$", "bigint"))
    found = docs.select("p_partkey", numbers.alias("n"))
    total = F.aggregate("n", F.lit(0).cast("bigint"), lambda a, b: a + b)
    return found.select("p_partkey", total.alias("total"), F.size("n").alias("found"))


@query(
    "json_explode_objects",
    """SELECT p_partkey, name, value FROM (
           SELECT p_partkey, unnest(['brand', 'type', 'name']) AS name, unnest([p_brand, p_type, p_name]) AS value FROM part)""",
)
def json_explode_objects(spark, sf):
    pair = lambda name: F.struct(F.lit(name).alias("name"), F.col(f"p_{name}").alias("value"))
    texts = table(spark, sf, "part").select(
        "p_partkey", F.to_json(F.array(pair("brand"), pair("type"), pair("name"))).alias("list")
    )
    return doc.explode_json(texts, "list", "struct<name:string,value:string>").select("p_partkey", "obj.name", "obj.value")


@query(
    "json_build",
    """SELECT p_partkey, '{"brand":"' || p_brand || '",' || CASE WHEN p_size > 25 THEN '"size":' || p_size || ',' ELSE '' END
              || '"type":"' || p_type || '"}' AS object,
              len(list_filter([p_brand, CASE WHEN p_size > 25 THEN p_type END, p_name], lambda x: x IS NOT NULL)) AS present
       FROM part""",
)
def json_build(spark, sf):
    large = F.col("p_size") > 25
    return table(spark, sf, "part").select(
        "p_partkey",
        doc.json_object(type="p_type", brand="p_brand", size=F.when(large, F.col("p_size"))).alias("object"),
        F.size(doc.json_array("p_brand", F.when(large, F.col("p_type")), "p_name")).cast("bigint").alias("present"),
    )


# --- results, links, history ----------------------------------------------------------------------


def _cost_texts(spark, sf):
    """Cost documents: one per part, the response is the part's size."""
    pay = views._tag(
        "Ground_Payments",
        F.concat(
            views._tag("CadastralCost", F.lit(""), views._attr("Value", F.translate(F.col("p_retailprice").cast("string"), ".", ","))),
            views._tag("Specific_CadastralCost", F.lit(""), views._attr("Value", F.col("p_size"))),
        ),
    )
    body = views._tag("Parcel", pay, views._attr("CadastralNumber", F.concat(F.lit("05:"), F.col("p_partkey").cast("string"))))
    for box in ["Parcels", "Cadastral_Block", *reversed(src.COST_PATH)]:
        body = views._tag(box, body)
    return spread(table(spark, sf, "part"), "p_partkey").select(
        F.col("p_partkey").alias("response_file_id"),
        F.col("p_size").cast("bigint").alias("response_id"),
        views._tag("Root", body).alias("text"),
    )


def _group_texts(spark, sf):
    """Group documents: one per part of some brands, with its group and its number."""
    group = views._tag("Group_Real_Estate", F.concat(views._tag("ID_Group", F.col("p_brand")), views._tag("Name_Group", F.concat(F.lit("group "), F.col("p_brand")))))
    member = views._tag(
        "Real_Estate", views._tag("CadastralNumber", F.concat(F.lit("05:"), F.col("p_partkey").cast("string"))), views._attr("ID_Group", F.col("p_brand"))
    )
    document = views._tag("Root", F.concat(views._tag("Groups_Real_Estate", group), views._tag("Real_Estates", member)))
    parts = table(spark, sf, "part").filter(F.col("p_type") != "ECONOMY")
    return spread(parts, "p_partkey").select(F.col("p_size").cast("bigint").alias("response_id"), document.alias("text"))


@query(
    "cost_group_join",
    """SELECT p_partkey AS response_file_id, '05:' || p_partkey AS cad_num, p_retailprice AS cost, cast(p_size AS double) AS upks,
              CASE WHEN p_type <> 'ECONOMY' THEN 'group ' || p_brand END AS "group" FROM part""",
)
def cost_group_join(spark, sf):
    groups, members = src.group_records(_group_texts(spark, sf))
    return plain(reg.result_parcels(src.cost_records(_cost_texts(spark, sf)), groups, members), 4)


@query(
    "decimal_repair_forms",
    """SELECT o_orderkey, -cast(o_totalprice AS double) AS negative, round(cast(o_orderkey AS double) / 100000000, 8) AS eighth,
              cast(o_orderkey AS double) * 10000000 AS exponent, cast(12345678901234567.5 AS double) AS wide FROM orders""",
)
def decimal_repair_forms(spark, sf):
    """Signs, exponents, eight places and seventeen whole digits."""
    key = F.col("o_orderkey")
    return plain(
        table(spark, sf, "orders").select(
            "o_orderkey",
            text.repair_decimal(F.concat(F.lit("итого -"), F.translate(F.col("o_totalprice").cast("decimal(15,2)").cast("string"), ".", ","))).alias("negative"),
            text.repair_decimal((key / F.lit(100_000_000).cast("decimal(12,0)")).cast("decimal(20,8)").cast("string")).alias("eighth"),
            text.repair_decimal(F.concat(key.cast("string"), F.lit("E7"))).alias("exponent"),
            text.repair_decimal(F.lit("12345678901234567,5")).alias("wide"),
        ),
        8,
    )


@query(
    "decimal_repair",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS price, cast(NULL AS double) AS none FROM lineitem""",
)
def decimal_repair(spark, sf):
    written = F.concat(F.translate(F.col("l_extendedprice").cast("string"), ".", ","), F.lit(" руб"))
    return plain(
        table(spark, sf, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.repair_decimal(written).alias("price"),
            text.repair_decimal(F.lit("нет")).alias("none"),
        ),
        4,
    )


def _requests(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P").select(
        F.col("o_orderkey").alias("request_id"), F.to_date("o_orderdate").alias("request_date")
    )


def _responses(spark, sf):
    orders = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    named = F.when(F.col("o_orderpriority") == "5-LOW", "без даты").when(
        F.col("o_orderpriority") == "3-MEDIUM", "от 31.02"
    ).otherwise(F.concat(F.lit("№ "), (F.col("o_orderkey") % 9).cast("string"), F.lit(" от "), F.date_format("o_orderdate", "dd.MM")))
    return orders.select(
        F.col("o_orderkey").alias("response_id"),
        F.to_date("o_orderdate").alias("response_date"),
        named.alias("response_name"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey") - 1).alias("response_request_id"),
    )


_RESPONSES = """
    SELECT o.o_orderkey AS response_id, o.o_orderdate::date AS response_date,
           CASE o_orderpriority WHEN '5-LOW' THEN 'без даты' WHEN '3-MEDIUM' THEN 'от 31.02'
                ELSE '№ ' || o_orderkey % 9 || ' от ' || strftime(o_orderdate, '%d.%m') END AS response_name,
           CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey - 1
                WHEN o_orderpriority IN ('2-HIGH', '4-NOT SPECIFIED') AND o_orderdate > DATE '1993-01-24' THEN r.id
           END AS response_request_id
    FROM orders o LEFT JOIN (SELECT o_orderdate AS d, min(o_orderkey) AS id FROM orders
                             WHERE o_orderstatus = 'P' AND o_orderdate > DATE '1993-01-01' GROUP BY 1) r ON r.d = o.o_orderdate
    WHERE o_orderstatus = 'F'"""


def _linked(spark, sf):
    return reg.link_responses(_responses(spark, sf), _requests(spark, sf), "1993-01-01", "1993-01-24")


@query("link_response_by_date", _RESPONSES)
def link_response_by_date(spark, sf):
    return _linked(spark, sf)


@query(
    "link_code_by_response",
    sql("", """
    SELECT o_orderkey AS file_id, CASE WHEN o_orderpriority = '1-URGENT' THEN -1 ELSE r.response_id END AS response_id
    FROM orders LEFT JOIN (
        SELECT q.o_orderdate AS d, min(a.response_id) AS response_id FROM answers a
        JOIN orders q ON q.o_orderkey = a.response_request_id AND q.o_orderstatus = 'P' GROUP BY 1) r ON r.d = o_orderdate
    WHERE o_orderstatus = 'O'""", answers=_RESPONSES),
)
def link_code_by_response(spark, sf):
    code_files = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "O").select(
        F.col("o_orderkey").alias("file_id"),
        F.concat(F.lit("коды "), F.date_format("o_orderdate", "dd.MM"), F.lit(".xlsx")).alias("name"),
        F.to_date("o_orderdate").alias("date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(-1).cast("bigint")).alias("response_id"),
    )
    return reg.link_codes(code_files, _requests(spark, sf), _linked(spark, sf)).select("file_id", "response_id")


@query(
    "join_on_derived_date",
    """SELECT r.response_id, count(o.o_orderkey) AS same_day FROM answers r
       LEFT JOIN orders o ON o.o_orderdate = CASE WHEN response_name LIKE '№%' THEN response_date END AND o.o_orderstatus = 'P'
       GROUP BY 1""".replace("FROM answers", f"FROM ({_RESPONSES})"),
)
def join_on_derived_date(spark, sf):
    wanted = temporal.date_from_name("response_name", "response_date")
    # One row per date before the join: pairs of a date are counted, never made.
    per_day = _requests(spark, sf).groupBy("request_date").agg(F.count("request_id").alias("same_day"))
    found = joins.join_on_derived_date(_responses(spark, sf), per_day, wanted, "request_date")
    return found.select("response_id", F.coalesce("same_day", F.lit(0)).alias("same_day"))


@query(
    "distinct_on_first",
    """SELECT DISTINCT ON (o_custkey, o_orderpriority) o_custkey, o_orderpriority, o_orderkey, o_totalprice, o_orderstatus
       FROM orders ORDER BY o_custkey, o_orderpriority, o_orderdate, o_orderkey""",
)
def distinct_on_first(spark, sf):
    first = agg.first_per_key(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])
    return first.drop("o_orderdate")


def _old_lists(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("description"), F.concat(F.lit("o"), F.col("o_custkey").cast("string")).alias("options"),
    )


@query(
    "backfill_requests",
    """SELECT DISTINCT ON (o_orderdate, o_orderpriority) o_orderdate::date AS request_date, '' AS request_reg_num,
              0 AS request_type_id, o_orderpriority AS request_name, o_orderstatus AS request_description,
              CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d') || o_orderpriority END AS request_pdf
       FROM orders ORDER BY o_orderdate, o_orderpriority, o_orderkey""",
)
def backfill_requests(spark, sf):
    lists = _old_lists(spark, sf)
    scans = lists.filter(F.col("name") != "5-LOW").select(
        "name", "date", F.concat(F.date_format("date", "yyyy-MM-dd"), "name").alias("pdf")
    ).distinct()
    return reg.backfill_requests(lists, scans)


@query(
    "backfill_files",
    """SELECT 'f' || l_linenumber || '.xlsx' AS request_file_name, o.o_orderstatus AS request_file_path, r.request_id,
              cast(l_quantity AS integer) AS request_file_content, '{"value":"o' || o.o_custkey || '"}' AS request_file_options
       FROM lineitem JOIN orders o ON o.o_orderkey = l_orderkey
       JOIN (SELECT o_orderdate, o_orderpriority, min(o_orderkey) AS request_id FROM orders GROUP BY 1, 2) r
            ON r.o_orderdate = o.o_orderdate AND r.o_orderpriority = o.o_orderpriority""",
)
def backfill_files(spark, sf):
    lists = _old_lists(spark, sf)
    requests = lists.groupBy(F.col("date").alias("request_date"), F.col("name").alias("request_name")).agg(
        F.min("id").alias("request_id")
    )
    old = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("list_id"),
        F.concat(F.lit("f"), F.col("l_linenumber").cast("string"), F.lit(".xlsx")).alias("file_name"),
        F.col("l_quantity").cast("int").alias("content"),
    )
    return reg.backfill_files(old, lists, requests, wrap_options=True)


def _old_messages(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), F.to_date("o_orderdate").alias("date_in"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(F.to_date("o_orderdate"), 3)).alias("date_out"),
        F.col("o_orderstatus").alias("pdf"),
    )


@query(
    "backfill_responses",
    """SELECT DISTINCT ON (o_orderpriority, o_orderdate) o_orderpriority AS response_name,
              CASE WHEN o_orderstatus = 'F' THEN (o_orderdate + INTERVAL 3 DAY)::date ELSE o_orderdate::date END AS response_date,
              o_orderdate::date AS response_date_in, 0 AS response_type_id, o_orderstatus AS response_pdf
       FROM orders ORDER BY o_orderpriority, o_orderdate, o_orderkey""",
)
def backfill_responses(spark, sf):
    return reg.backfill_responses(_old_messages(spark, sf))


def _new_responses(spark, sf):
    old = _old_messages(spark, sf)
    return old.groupBy(F.col("name").alias("response_name"), F.col("date_in").alias("response_date_in")).agg(
        F.min("id").alias("response_id")
    )


@query(
    "backfill_acts",
    """SELECT 'act ' || l_linenumber AS response_act_ods_filename, cast(l_quantity AS integer) AS response_act_count_ok,
              l_linenumber AS response_act_count_bad, r.response_id
       FROM lineitem JOIN orders o ON o.o_orderkey = l_orderkey
       JOIN (SELECT o_orderdate, o_orderpriority, min(o_orderkey) AS response_id FROM orders GROUP BY 1, 2) r
            ON r.o_orderdate = o.o_orderdate AND r.o_orderpriority = o.o_orderpriority""",
)
def backfill_acts(spark, sf):
    acts = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("message_id"),
        F.concat(F.lit("act "), F.col("l_linenumber").cast("string")).alias("ods_name"),
        F.col("l_quantity").cast("int").alias("count_ok"),
        F.col("l_linenumber").alias("count_bad"),
    )
    return reg.backfill_acts(acts, _old_messages(spark, sf), _new_responses(spark, sf))


@query(
    "backfill_codes",
    """SELECT cast(l_suppkey AS varchar) AS code, cast(l_partkey AS varchar) AS cad_num, l_shipdate::date AS date, r.response_id
       FROM lineitem LEFT JOIN (SELECT o_orderdate::date AS d, min(o_orderkey) AS response_id FROM orders GROUP BY 1) r
            ON r.d = l_shipdate::date""",
)
def backfill_codes(spark, sf):
    codes = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("code"), F.col("l_partkey").cast("string").alias("cad_num"),
        F.to_date("l_shipdate").alias("date"),
    )
    responses = _new_responses(spark, sf).withColumnRenamed("response_date_in", "response_date")
    return reg.backfill_codes(codes, responses)


@query(
    "combined_history",
    """WITH answer AS (SELECT o_custkey AS request_id, min({'i': o_orderkey, 'd': o_orderdate, 'n': o_orderpriority}) AS r
                       FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
            cost AS (SELECT l_orderkey, l_partkey, min({'c': l_extendedprice, 'u': l_quantity, 'g': l_returnflag}) AS c,
                            min(l_linestatus) AS code FROM lineitem GROUP BY 1, 2)
       SELECT '05:' || l.l_partkey AS cad_num, o.o_orderkey AS request_file_id, 'f' || o.o_orderkey AS request_file_name,
              r.i AS response_id, r.d::date AS response_date, r.n AS response_name, c.c AS cost, c.u AS upks, c.g AS "group", code,
              o_custkey AS request_name
       FROM lineitem l JOIN orders o ON o.o_orderkey = l_orderkey LEFT JOIN answer ON request_id = o_custkey
       LEFT JOIN cost k ON k.l_orderkey = r.i AND k.l_partkey = l.l_partkey""",
)
def combined_history(spark, sf):
    orders, items = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    number = F.concat(F.lit("05:"), F.col("l_partkey").cast("string")).alias("cad_num")
    parcels = items.select(number, F.col("l_orderkey").alias("request_file_id"))
    listing = orders.select(
        F.col("o_orderkey").alias("request_file_id"),
        F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("request_file_name"),
        F.col("o_custkey").alias("request_id"),
    )
    requests = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("request_id"), F.lit(None).cast("date").alias("request_date"), F.col("c_custkey").alias("request_name")
    )
    responses = orders.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("response_id"), F.to_date("o_orderdate").alias("response_date"),
        F.col("o_orderpriority").alias("response_name"), F.col("o_custkey").alias("response_request_id"),
    )
    results = items.select(
        F.col("l_orderkey").alias("response_id"), number, F.col("l_extendedprice").alias("cost"),
        F.col("l_quantity").alias("upks"), F.col("l_returnflag").alias("group"),
    )
    codes = items.select(F.col("l_orderkey").alias("response_id"), number, F.col("l_linestatus").alias("code"))
    return reg.combined_history(parcels, listing, requests, responses, results, codes).drop("request_date")


# --- export ---------------------------------------------------------------------------------------


def _export_input(spark, sf):
    """Parts by type, where some columns are empty for whole types."""
    economy, small = F.col("p_type") == "ECONOMY", F.col("p_size") < 10
    return table(spark, sf, "part").select(
        "p_type", "p_name", F.when(~economy, F.col("p_brand")).alias("brand"),
        F.when(economy & small, F.col("p_size")).alias("size"), F.lit("").alias("blank"), "p_partkey",
    )


@query(
    "export_nonempty_columns",
    """SELECT p_type, true AS p_name, p_type <> 'ECONOMY' AS brand,
              bool_or(p_type = 'ECONOMY' AND p_size < 10) AS size, false AS blank, true AS p_partkey FROM part GROUP BY p_type""",
)
def export_nonempty_columns(spark, sf):
    return agg.non_empty_columns(_export_input(spark, sf), "p_type")


@query(
    "export_frame",
    """SELECT p_type, p_name, CASE WHEN p_type <> 'ECONOMY' THEN p_brand ELSE '' END AS brand,
              CASE WHEN p_type = 'ECONOMY' AND p_size < 10 THEN cast(p_size AS varchar) ELSE '' END AS size, '' AS blank,
              cast(p_partkey AS varchar) AS p_partkey FROM part""",
)
def export_frame(spark, sf):
    return write.export_frame(_export_input(spark, sf), "p_type")


@query(
    "export_files",
    """WITH cells AS (SELECT p_type, p_name, CASE WHEN p_type <> 'ECONOMY' THEN p_brand ELSE '' END AS brand,
              CASE WHEN p_type = 'ECONOMY' AND p_size < 10 THEN cast(p_size AS varchar) ELSE '' END AS size, p_partkey FROM part),
       report AS (SELECT p_type, bool_or(brand <> '') AS brand, bool_or(size <> '') AS size FROM cells GROUP BY ALL)
       SELECT p_type AS category, concat_ws(',', c.p_type, c.p_name, CASE WHEN r.brand THEN c.brand END, CASE WHEN r.size THEN c.size END, c.p_partkey) AS line,
              false AS first FROM cells c JOIN report r USING (p_type)
       UNION ALL SELECT p_type, concat_ws(',', 'p_type', 'p_name', CASE WHEN brand THEN 'brand' END, CASE WHEN size THEN 'size' END, 'p_partkey'), true
       FROM report""",
)
def export_files(spark, sf):
    """Files of all categories as they lie on disk, with the columns that each category has."""
    path = scratch_path(spark, "export")
    write.export_by_category(_export_input(spark, sf), "p_type", path)
    lines = files.read_lines(spark, path)
    category = F.regexp_extract("path", "_category=([^/]+)/", 1).alias("category")
    return lines.select(category, "line", (F.col("line_no") == 1).alias("first"))


@query("export_categories", "SELECT DISTINCT p_type FROM part")
def export_categories(spark, sf):
    return agg.category_values(table(spark, sf, "part"), "p_type")


@query(
    "export_projection",
    sql("classifier part_lines", f"""
    SELECT {", ".join(f'{n} AS "{h}"' for n, h in reg.EXPORT_NAMES.items() if n not in ("request_date", "request_name"))},
           DATE '2024-01-01' + cast(p_size AS integer) AS "Дата поступления реестра", p_brand AS "Наименование реестра"
    FROM (SELECT * FROM empty UNION ALL BY NAME SELECT * FROM xml) x JOIN part ON p_partkey = x.request_file_id""",
        empty=_EMPTY_PARCELS, xml=_XML_PARCELS),
)
def export_projection(spark, sf):
    parcels = reg.parse_objects(_objects(spark, sf), views.classifier(spark, sf))
    parts = table(spark, sf, "part")
    listing = parts.select(F.col("p_partkey").alias("request_file_id"), (F.col("p_partkey") + 1_000_000).alias("request_id"))
    requests = parts.select(
        (F.col("p_partkey") + 1_000_000).alias("request_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).alias("request_date"),
        F.col("p_brand").alias("request_name"),
    )
    return reg.export_view(parcels, listing, requests)


@query("select_as", 'SELECT p_name AS "Название", p_brand AS "Марка" FROM part')
def select_as(spark, sf):
    return flt.select_as(table(spark, sf, "part"), {"p_name": "Название", "p_brand": "Марка"})


# --- exclusion, files, lines ---------------------------------------------------------------------------


def _survivors(spark, sf):
    people = table(spark, sf, "customer").withColumnRenamed("c_custkey", "number")
    listed = table(spark, sf, "customer").filter(F.col("c_acctbal") > -990).select("c_custkey")
    return joins.exclude(people, listed, "number", "c_custkey")


@query("exclusion_antijoin", "SELECT c_custkey AS number, c_name FROM customer WHERE c_acctbal <= -990")
def exclusion_antijoin(spark, sf):
    return _survivors(spark, sf).select("number", "c_name")


@query(
    "prune_empty_parents",
    """WITH n AS (SELECT n_nationkey, n_regionkey FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal <= -990))
       SELECT 'nation' AS level, n_nationkey AS key FROM n UNION ALL
       SELECT 'region', r_regionkey FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM n)""",
)
def prune_empty_parents(spark, sf):
    """Nations, then regions, left without a customer."""
    leaves = _survivors(spark, sf).select(F.col("c_nationkey").alias("parent"))
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), "n_regionkey")
    regions = table(spark, sf, "region").select(F.col("r_regionkey").alias("key"))
    kept = joins.prune_empty([(nations, "n_regionkey"), (regions, None)], leaves, "key")
    return sets.union_tagged({"nation": kept[0].select("key"), "region": kept[1].select("key")}, "level")


@query(
    "file_semijoin",
    """SELECT p_partkey, 'zips/p_' || p_partkey || '.v1.zip' AS path FROM part
       WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)""",
)
def file_semijoin(spark, sf):
    """Archives whose stem names a fixed file."""
    archives = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("zips/p_"), F.col("p_partkey").cast("string"), F.lit(".v1.zip")).alias("path"))
    fixed = table(spark, sf, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45))
    fixed = fixed.select(F.concat(F.lit("p_"), F.col("l_partkey").cast("string"), F.lit(".mif")).alias("name"))
    return joins.matching_files(archives, fixed, F.concat(text.file_stem("path"), F.lit(".mif")), F.col("name"))


def _listing(spark, sf):
    """A folder per order with a scan, a picture or a lock file per line."""
    kind = F.when(F.col("l_linenumber") % 3 == 0, "pdf").when(F.col("l_linenumber") % 3 == 1, "png").otherwise("xml")
    name = F.concat(F.when(F.col("l_tax") == 0, "~$").otherwise(""), F.lit("scan_"), F.col("l_linenumber").cast("string"), F.lit("."), kind)
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("folder"), name.alias("name"),
        F.concat_ws("/", F.lit("in"), F.col("l_orderkey").cast("string"), name).alias("path"),
    )


_LISTING = """
    SELECT l_orderkey AS folder, name, 'in/' || l_orderkey || '/' || name AS path FROM (
        SELECT l_orderkey, CASE WHEN l_tax = 0 THEN '~$' ELSE '' END || 'scan_' || l_linenumber || '.'
               || CASE l_linenumber % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'png' ELSE 'xml' END AS name FROM lineitem)"""


@query(
    "first_scan_per_folder",
    f"""SELECT folder, arg_min(path, {{'r': CASE WHEN path LIKE '%.pdf' THEN 0 ELSE 1 END, 'p': path}}) AS path
        FROM ({_LISTING}) WHERE path NOT LIKE '%.xml' GROUP BY 1""",
)
def first_scan_per_folder(spark, sf):
    return files.first_by_extension(_listing(spark, sf), "folder", [".pdf", ".png"])


@query("temp_file_filter", f"SELECT folder, name FROM ({_LISTING}) WHERE name NOT LIKE '%~%'")
def temp_file_filter(spark, sf):
    return files.temp_file_filter(_listing(spark, sf)).select("folder", "name")


@query("by_extension", f"SELECT folder, name FROM ({_LISTING}) WHERE name LIKE '%.xml%'")
def by_extension(spark, sf):
    return flt.by_extension(_listing(spark, sf), "name", "xml").select("folder", "name")


@query(
    "new_files_only",
    f"""SELECT path FROM ({_LISTING}) WHERE folder NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def new_files_only(spark, sf):
    found = _listing(spark, sf)
    done = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("folder"))
    return files.new_files_only(found, done, "folder").select("path")


@query(
    "unmarked_folders",
    """SELECT l_orderkey AS folder FROM lineitem GROUP BY 1 HAVING NOT bool_or(l_returnflag = 'R')""",
)
def unmarked_folders(spark, sf):
    name = F.when(F.col("l_returnflag") == "R", ".success").otherwise("scan.pdf")
    return files.unmarked_folders(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("folder"), name.alias("name")))


def _scan_folders(spark, sf):
    """Real folders: a file per supplier in the folder of its nation; the folders of every third nation are marked as done."""
    root = scratch_path(spark, "scans")
    suppliers = table(spark, sf, "supplier")
    suppliers.select(F.col("s_name").alias("value"), F.col("s_nationkey").alias("nation")).repartition("nation").write.partitionBy("nation").text(root)
    folder = F.concat(F.lit("nation="), F.col("s_nationkey").cast("string")).alias("folder")
    listing.mark_folders(suppliers.where("s_nationkey % 3 = 0").select(folder).distinct(), root)
    return root


@query(
    "folder_marks",
    """SELECT 'nation=' || s_nationkey AS folder, s_nationkey % 3 = 0 AS marked, count(DISTINCT s_nationkey) AS texts
       FROM supplier GROUP BY s_nationkey""",
)
def folder_marks(spark, sf):
    """Markers are empty hidden files; a listing of real folders shows them."""
    root = _scan_folders(spark, sf)
    shown = listing.list_all_files(spark, root).withColumn("folder", files.folder_below("path", root)).where("folder IS NOT NULL")
    open_folders = files.unmarked_folders(shown).withColumn("open", F.lit(True))
    texts = shown.where(F.col("name").endswith(".txt")).groupBy("folder").agg(F.count("*").alias("texts"))
    return texts.join(open_folders, "folder", "left").select("folder", F.col("open").isNull().alias("marked"), "texts")


@query(
    "request_headers",
    """SELECT DATE '2024-01-01' AS request_date, '77' AS request_reg_num, 16 AS request_type_id, 'nation=' || s_nationkey AS request_name,
              'nation=' || s_nationkey AS request_description, 'nation=' || s_nationkey AS request_pdf, 1 AS files
       FROM supplier GROUP BY s_nationkey""",
)
def request_headers(spark, sf):
    """Headers of real folders; of paths only the folder is compared."""
    root = _scan_folders(spark, sf)
    found = files.folder_headers(listing.list_all_files(spark, root), root, F.lit("2024-01-01").cast("date"), 16, "77", extensions=[".txt"])
    folder = lambda c, n: F.element_at(F.split(c, "/"), n).alias(c)
    return found.withColumns({"request_description": folder("request_description", -1), "request_pdf": folder("request_pdf", -2)})


@query(
    "folder_header",
    """SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderdate::date ELSE DATE '2024-01-01' END AS request_date,
              16 AS request_type_id, 'list ' || CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'of ' || o_orderpriority END AS request_name,
              count(*) AS files FROM orders GROUP BY 1, 2, 3""",
)
def folder_header(spark, sf):
    part = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.concat(F.lit("of "), "o_orderpriority")
    )
    listing = table(spark, sf, "orders").select(F.concat(F.lit("list "), part).alias("folder"))
    return files.request_header(listing, F.lit("2024-01-01").cast("date"), 16)


@query(
    "line_rewrite",
    sql("document_lines", """
    SELECT doc_id, line_no, CASE WHEN contains(line, 'the') THEN 'Delimiter ","'
           WHEN contains(line, 'is') THEN substr(line, 2) ELSE line END AS line FROM document_lines"""),
)
def line_rewrite(spark, sf):
    replaced = lines.replace_marked(F.col("line"), "the", 'Delimiter ","')
    both = F.when(F.contains("line", F.lit("the")), replaced).otherwise(lines.drop_lead(F.col("line"), "is"))
    return views.document_lines(spark, sf).withColumn("line", both)


@query(
    "map_file_lines",
    """SELECT p_partkey, n AS line_no, CASE n WHEN 2 THEN 'Delimiter ","' WHEN 3 THEN 'CoordSys Earth ' || p_size
              WHEN 1 THEN 'Version 300' ELSE row_number() OVER (PARTITION BY n ORDER BY p_partkey) || ' ' || p_brand END AS line
       FROM part, (VALUES (1), (2), (3), (4)) k(n)""",
)
def map_file_lines(spark, sf):
    """Map files on disk with their three repairs: delimiter, coordinate system and running number."""
    folder = scratch_path(spark, "maps")
    size = F.col("p_size").cast("string")
    body = F.concat(F.lit('Version 300\nDelimiter ";"\n CoordSys Earth '), size, F.lit("\n0 "), "p_brand")
    table(spark, sf, "part").select(body.alias("text"), "p_partkey").write.json(folder)
    # One document a line, its lines numbered as in a file.
    docs = spark.read.schema("text string, p_partkey bigint").json(folder)
    rows = docs.select("p_partkey", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    rows = rows.withColumn("line", lines.map_coordinates(lines.map_delimiter(F.col("line"))))
    counted = F.col("line").rlike("^[0-9]")
    numbered = lines.renumber_leading(rows.where(counted), ["p_partkey", "pos"])
    return numbered.unionByName(rows.where(~counted)).select("p_partkey", (F.col("pos") + 1).alias("line_no"), "line")


@query(
    "classifier_file",
    "SELECT cast(n_nationkey AS varchar) AS code, n_name AS value FROM nation",
)
def classifier_file(spark, sf):
    """Codes with blanks around them and one of them twice, from a file."""
    folder = scratch_path(spark, "classifier")
    nations = table(spark, sf, "nation")
    padded = nations.select(F.concat(F.lit(" "), F.col("n_nationkey").cast("string"), F.lit(" ")).alias("code"), F.col("n_name").alias("value"))
    again = padded.where("trim(code) = '3'").withColumn("value", F.lit("ZZZ"))
    padded.unionByName(again).write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(folder)
    return files.load_classifier(spark, folder)


@query(
    "result_files",
    """SELECT p_partkey // 50 AS response, '05:' || p_partkey AS cad_num, p_retailprice AS cost, cast(p_size AS double) AS upks,
              CASE WHEN p_type <> 'ECONOMY' THEN 'group ' || p_brand END AS "group" FROM part""",
)
def result_files(spark, sf):
    """Result documents on disk to result parcels: a cost and a group file of fifty parts per response."""
    folder = scratch_path(spark, "results")
    parts = spread(table(spark, sf, "part"), "p_partkey")
    response = F.floor(F.col("p_partkey") / 50).alias("response")
    number = F.concat(F.lit("05:"), F.col("p_partkey").cast("string"))
    pay = views._tag("Ground_Payments", F.concat(
        views._tag("CadastralCost", F.lit(""), views._attr("Value", F.translate(F.col("p_retailprice").cast("string"), ".", ","))),
        views._tag("Specific_CadastralCost", F.lit(""), views._attr("Value", F.col("p_size"))),
    ))
    plot = views._tag("Parcel", pay, views._attr("CadastralNumber", number))
    member = views._tag("Real_Estate", views._tag("CadastralNumber", number), views._attr("ID_Group", F.col("p_brand")))
    group = views._tag("Group_Real_Estate", F.concat(views._tag("ID_Group", F.col("p_brand")), views._tag("Name_Group", F.concat(F.lit("group "), F.col("p_brand")))))
    grouped = F.when(F.col("p_type") != "ECONOMY", member), F.when(F.col("p_type") != "ECONOMY", group)
    one = parts.groupBy(response).agg(
        F.array_join(F.collect_list(plot), "").alias("plots"), F.array_join(F.collect_list(grouped[0]), "").alias("members"),
        F.array_join(F.collect_set(grouped[1]), "").alias("groups"),
    )
    costs = F.col("plots")
    for box in ["Parcels", "Cadastral_Block", *reversed(src.COST_PATH)]:
        costs = views._tag(box, costs)
    named = views._tag("Root", F.concat(views._tag("Groups_Real_Estate", F.col("groups")), views._tag("Real_Estates", F.col("members"))))
    docs = one.select("response", F.explode(F.create_map(F.lit("COST"), views._tag("Root", costs), F.lit("FD"), named)).alias("kind", "value"))
    rows = 2 + 2 * table(spark, sf, "part").count() // 50
    spread(docs, "response", rows=rows, per_task=views.FILES_PER_TASK).write.partitionBy("response", "kind").text(folder)
    # Here the folder tells the kind; file names are Spark's own.
    texts = src.read_xml_texts(spark, folder, glob="*.txt").withColumns({
        "response_id": F.regexp_extract("path", "response=([0-9]+)", 1).cast("bigint"), "kind": F.regexp_extract("path", "kind=([A-Z]+)", 1),
    }).withColumn("response_file_id", F.col("response_id"))
    cost_rows = src.cost_records(texts.where("kind = 'COST'").select("response_file_id", "response_id", "text"))
    groups, members = src.group_records(texts.where("kind = 'FD'").select("response_id", "text"))
    found = reg.result_parcels(cost_rows, groups, members)
    return plain(found.withColumnRenamed("response_file_id", "response"), 4)


@query(
    "renumber_lines",
    sql("document_lines", """
    SELECT doc_id, line_no, regexp_replace(line, '^(\\d+)', cast(row_number() OVER (ORDER BY doc_id, line_no) AS varchar)) AS line,
           row_number() OVER (ORDER BY doc_id, line_no) AS ordinal
    FROM (SELECT doc_id, line_no, length(line) || ' ' || line AS line FROM document_lines)"""),
)
def renumber_lines(spark, sf):
    """Every line starts with a number, which becomes its position over all documents."""
    rows = views.document_lines(spark, sf).withColumn("line", F.concat(F.length("line").cast("string"), F.lit(" "), "line"))
    numbered = renumber(rows, ["doc_id", "line_no"])
    return numbered.withColumn("line", F.regexp_replace("line", F.lit(r"^(\d+)"), F.col("ordinal").cast("string")))


# --- text functions -------------------------------------------------------------------------------------


@query(
    "text_cleaning",
    """SELECT doc_id, md5(regexp_replace(text, '\\s+', ' ', 'g')) AS squeezed,
              length(regexp_replace(text, '[\\t\\r\\n]', '', 'g')) AS stripped, trim(lang || '""', '"') AS unquoted,
              md5(text) AS without_mark FROM documents""",
)
def text_cleaning(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text.squeeze_blanks("text")).alias("squeezed"),
        F.length(text.strip_control("text")).cast("bigint").alias("stripped"),
        text.trim_chars(F.concat(F.lit('"'), "lang", F.lit('""')), '"').alias("unquoted"),
        F.md5(text.strip_bom(F.concat(F.lit("﻿"), "text"))).alias("without_mark"),
    )


@query(
    "text_dates",
    """SELECT o_orderkey, o_orderdate::date AS iso, cast(o_orderkey % 12 + 2000 AS integer) AS year_of,
              CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate::date END AS parsed,
              strftime(o_orderdate, '%Y%m%d') || '_' || o_orderstatus AS named FROM orders""",
)
def text_dates(spark, sf):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    dotted = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy.dd.MM")).otherwise("2001.31.02")
    year = F.make_date(F.col("o_orderkey") % 12 + 2000, F.lit(1), F.lit(1))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        temporal.iso_date_in(F.concat(F.lit("list "), day, F.lit(" v2")), F.lit(None).cast("date")).alias("iso"),
        temporal.year_of(year).alias("year_of"),
        temporal.parse_date(dotted, "yyyy.dd.MM").alias("parsed"),
        temporal.dated_name("o_orderdate", "o_orderstatus").alias("named"),
    )


@query(
    "file_names",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'shot_' || l_partkey AS stem, 'shot_' || l_partkey || '.png' AS tail
       FROM lineitem""",
)
def file_names(spark, sf):
    path = F.concat(F.lit("D:\\scans/"), F.col("l_suppkey").cast("string"), F.lit("\\shot_"), F.col("l_partkey").cast("string"), F.lit(".png"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.file_stem(path).alias("stem"), text.file_tail(path, "png").alias("tail")
    )


@query(
    "safe_casts",
    """SELECT page_id, try_cast(regexp_extract(url, '([^/]+)$', 1) AS bigint) AS number FROM pages""",
)
def safe_casts(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", text.safe_cast(text.extract_or_null("url", r"([^/]+)$", 1), "bigint").alias("number")
    )


@query(
    "assemble_link",
    """SELECT page_id, 'https://x.example/' || page_id || '/get/t' || page_id || '/list ' || page_id AS link,
              'list ' || page_id AS name FROM pages""",
)
def assemble_link(spark, sf):
    """Sharing-page scripts behind every page, from which the link is put together."""
    key = F.col("page_id").cast("string")
    script = F.concat(
        F.lit('{"weblink_get":{"stock":{"count":1,"url":"https://x.example/'), key, F.lit('/"}},"dwl_token":"t'), key,
        F.lit('"},"folders":{"list":[{"name":"list '), key, F.lit('"}]}'),
    )
    link, name = text.assemble_link(F.concat(F.col("html"), script))
    return table(spark, sf, "pages").select("page_id", link.alias("link"), name.alias("name"))


@query(
    "line_list",
    """SELECT rtrim(term) AS term FROM (SELECT unnest(string_split(text, chr(10))) AS term FROM benchmark) WHERE rtrim(term) <> ''""",
)
def line_list(spark, sf):
    """The texts written out as files of lines first."""
    path = scratch_path(spark, "line-list")
    table(spark, sf, "benchmark").select("text").write.text(path)
    return files.read_line_list(spark, path)


@query(
    "with_defaults",
    """SELECT d.doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def with_defaults(spark, sf):
    joined = joins.left_join(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id")
    return flt.with_defaults(joined, {"quality": -1, "toxic": 0})
