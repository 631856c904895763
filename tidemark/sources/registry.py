"""Registry and result documents from XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import file_name, strip_bom, strip_control
from tidemark.scale import cut_lineage
from tidemark.schemas import REGISTRY_DOCUMENT, REGISTRY_KINDS, REGISTRY_OBJECT, REGISTRY_ROOT, struct_of, texts
from tidemark.sources.elements import xml_elements

XML_OPTIONS = {"attributePrefix": "@", "valueTag": "_VALUE", "mode": "PERMISSIVE"}
# Column for the text of a record that does not parse.
BROKEN = "_broken"

# Result documents: only the parts that are read further on.
COST_PARCEL = struct_of(
    {
        "@CadastralNumber": "string",
        "Ground_Payments": T.ArrayType(
            struct_of({"CadastralCost": texts("@Value"), "Specific_CadastralCost": texts("@Value")})
        ),
    }
)
GROUP = texts("ID_Group", "Name_Group")
MEMBER = texts("@ID_Group", "CadastralNumber")

# Containers above the cadastral blocks of a cost document, and
# the lists of a group document.
COST_PATH = ["Package", "Federal", "Cadastral_Regions", "Cadastral_Region", "Cadastral_Districts",
             "Cadastral_District", "Cadastral_Blocks"]
GROUP_LISTS = struct_of(
    {
        "Groups_Real_Estate": T.ArrayType(struct_of({"Group_Real_Estate": T.ArrayType(GROUP)})),
        "Real_Estates": T.ArrayType(struct_of({"Real_Estate": T.ArrayType(MEMBER)})),
    }
)


def read_xml_texts(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """``(path, name, text)`` of every XML file below a folder, cleaned for parsing."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("name"),
        strip_control(strip_bom("value")).alias("text"),
    )


def _with_broken(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])


def parse_registry(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``document`` (typed, NULL leaves where absent), ``options`` (its header) and ``problem``.

    ``problem`` says why a text is no registry document; such a row has
    neither document nor options, so nothing half read goes further.
    """
    parsed = docs.withColumn("_parsed", F.from_xml(text, _with_broken(REGISTRY_DOCUMENT), XML_OPTIONS | {"columnNameOfCorruptRecord": BROKEN}))
    closed = F.rtrim(F.col(text)).endswith(f"</{REGISTRY_ROOT}>") | F.col(text).rlike(rf"<{REGISTRY_ROOT}[^<>]*/>\s*$")
    problem = (
        F.when(F.trim(F.coalesce(text, F.lit(""))) == "", F.lit("empty file"))
        .when(F.col("_parsed").isNull() | F.col(f"_parsed.{BROKEN}").isNotNull(), F.lit("not well-formed"))
        .when(~closed, F.lit(f"no end of <{REGISTRY_ROOT}>"))
    )
    fields = F.struct(*[F.col(f"_parsed.{n}").alias(n) for n in REGISTRY_DOCUMENT.names])
    checked = parsed.withColumn("problem", problem).withColumn("document", F.when(F.col("problem").isNull(), fields))
    return checked.drop(text, "_parsed").withColumn("options", F.to_json("document.ListInfo"))


def registry_objects(docs: DataFrame, document: str = "document") -> DataFrame:
    """One row per object of any kind: the other columns, ``kind`` and ``object``."""
    rest = [c for c in docs.columns if c not in (document, "problem")]
    none = F.array().cast(T.ArrayType(REGISTRY_OBJECT))

    def objects_of(box: str, item: str) -> Column:
        found = F.coalesce(F.col(f"{document}.Objects.{box}.{item}"), none)
        return F.transform(found, lambda o: F.struct(F.lit(item).alias("kind"), o.alias("object")))

    lists = [objects_of(box, item) for box, item in REGISTRY_KINDS.items()]
    return docs.select(*rest, F.explode(F.concat(*lists)).alias("_o")).select(*rest, "_o.kind", "_o.object")


def read_registry_xml(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """Registry documents below a folder, one row per file; broken ones only have a ``problem``."""
    return parse_registry(read_xml_texts(spark, path, glob))


def file_rejects(problems: DataFrame, table: str, run_ts: Column) -> DataFrame:
    """Log entries of ``(path, problem)`` rows, one per broken file."""
    # Tested behind the aggregate: as a filter before it, the parse that finds the problem would run again for each test.
    log = problems.groupBy("path").agg(F.min("problem").alias("description")).where("description IS NOT NULL")
    return log.select(
        F.lit(table).alias("table_name"), "description", F.lit("request_file").alias("src"),
        file_name("path").alias("file_name"), F.lit(None).cast("string").alias("row"), run_ts.alias("date"),
    )


def read_registry_elements(spark: SparkSession, path: str, glob: str = "*.xml") -> tuple[DataFrame, DataFrame]:
    """(objects, problems) of documents too large to hold as one text, from one scan of the files.

    Objects of all kinds and the header are cut out of the files together,
    parsed one by one and joined on the file: ``path``, ``name``, ``kind``,
    ``object`` and ``options``. A file is taken whole or not at all: the
    objects of a file with any problem stay out, and ``problems`` holds
    ``(path, problem)`` rows of it.
    """
    containers = [REGISTRY_ROOT, "Objects", *REGISTRY_KINDS]
    cut = xml_elements(spark, path, [*REGISTRY_KINDS.values(), "ListInfo"], containers, glob)
    kinds = F.col("kind").isin(*REGISTRY_KINDS.values())
    options = XML_OPTIONS | {"columnNameOfCorruptRecord": BROKEN}
    parsed = cut.withColumn("object", F.when(kinds, F.from_xml("text", _with_broken(REGISTRY_OBJECT), options)))
    broken = F.col("text").isNotNull() & kinds & (F.col("object").isNull() | F.col(f"object.{BROKEN}").isNotNull())
    parsed = parsed.withColumn("problem", F.coalesce("problem", F.when(broken, F.concat(F.lit("<"), "kind", F.lit("> not well-formed")))))
    # Parsed once; objects, headers and problems are read from the copy.
    fields = F.struct(*[F.col(f"object.`{n}`").alias(n) for n in REGISTRY_OBJECT.names])
    parsed = cut_lineage(parsed.withColumn("object", F.when(F.col("object").isNotNull(), fields)), "objects")
    unread = parsed.groupBy("path").agg(F.count_if(F.col("kind") != "").alias("n")).where("n = 0")
    problems = parsed.where("problem IS NOT NULL").select("path", "problem").unionByName(
        unread.select("path", F.lit("no registry document").alias("problem"))
    )
    header = F.from_xml("text", "variant", XML_OPTIONS)
    headers = parsed.where("kind = 'ListInfo' AND text IS NOT NULL").groupBy("path").agg(F.min("text").alias("text"))
    headers = headers.select(F.col("path").alias("of"), F.to_json(header).alias("options"))
    good = parsed.where("object IS NOT NULL").join(problems.select("path").distinct(), "path", "left_anti")
    objects = good.join(headers, good["path"] == headers["of"], "left")
    return objects.select("path", file_name("path").alias("name"), "kind", "object", "options"), problems


def read_registry_objects(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """One row per object of the sound files, read element by element."""
    return read_registry_elements(spark, path, glob)[0]


def result_kind(name: str):
    """Kind of a result file by its name's prefix; NULL for any other."""
    base = file_name(name)
    return F.when(base.startswith("COST"), "cost").when(base.startswith("FD"), "fd")


def read_result_xml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Result files with their ``kind``, and apart from them those of no known kind."""
    files = read_xml_texts(spark, path).withColumn("kind", result_kind("name"))
    return files.filter(F.col("kind").isNotNull()), files.filter(F.col("kind").isNull()).drop("kind")


def _rows_of(spark: SparkSession, path: str, glob: str, tag: str, schema: T.StructType) -> DataFrame:
    """One row per element of a tag, at any depth of any matching file."""
    rows = (
        spark.read.format("xml")
        .options(**XML_OPTIONS)
        .option("rowTag", tag)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .schema(schema)
        .load(path)
    )
    return rows.select(F.col("_metadata.file_path").alias("path"), F.struct(*[f"`{n}`" for n in schema.names]).alias("e"))


def _cost_columns(parcel: str) -> list[Column]:
    first = F.try_element_at(F.col(f"{parcel}.Ground_Payments"), F.lit(1))
    return [
        F.col(f"{parcel}.`@CadastralNumber`").alias("cad_num"),
        first["CadastralCost"]["@Value"].alias("cost"),
        first["Specific_CadastralCost"]["@Value"].alias("upks"),
    ]


def read_cost_xml(spark: SparkSession, path: str) -> DataFrame:
    """``(path, cad_num, cost, upks)`` per parcel of the cost files; no file is held whole."""
    return _rows_of(spark, path, "COST*.xml", "Parcel", COST_PARCEL).select("path", *_cost_columns("e"))


def read_group_xml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Groups and members of the group files, each with its file's path."""
    groups = _rows_of(
        spark, path, "FD*.xml", "Group_Real_Estate", GROUP
    ).select("path", F.col("e.ID_Group").alias("id_group"), F.col("e.Name_Group").alias("name_group"))
    members = _rows_of(
        spark, path, "FD*.xml", "Real_Estate", MEMBER
    ).select("path", F.col("e.CadastralNumber").alias("cad_num"), F.col("e.`@ID_Group`").alias("id_group"))
    return groups, members


def _nested(path: list[str]) -> T.StructType:
    name, inside = "Cadastral_Block", struct_of({"Parcels": struct_of({"Parcel": T.ArrayType(COST_PARCEL)})})
    for box in reversed(path):
        name, inside = box, struct_of({name: T.ArrayType(inside)})
    return struct_of({name: T.ArrayType(inside)})


def cost_records(files: DataFrame, path: list[str] = COST_PATH, text: str = "text") -> DataFrame:
    """One row per parcel of cost documents held in a text column."""
    rest = [c for c in files.columns if c != text]
    # Parsed once; from the copy only boxes are unpacked and tested.
    rows = cut_lineage(files.select(*rest, F.from_xml(text, _nested(path), XML_OPTIONS).alias("_d")), "costs")
    for box in [*path, "Cadastral_Block"]:
        rows = rows.withColumn("_d", F.explode(F.col("_d")[box]))
    rows = rows.select(*rest, F.explode("_d.Parcels.Parcel").alias("_p"))
    return rows.select(*rest, *_cost_columns("_p"))


def group_records(files: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Groups and members of group documents held in a text column."""
    rest = [c for c in files.columns if c != text]
    # Parsed once for both lists.
    docs = cut_lineage(files.select(*rest, F.from_xml(text, GROUP_LISTS, XML_OPTIONS).alias("_d")), "groups")

    def entries(box: str, item: str) -> DataFrame:
        boxes = docs.select(*rest, F.explode(f"_d.{box}").alias("_b"))
        return boxes.select(*rest, F.explode(f"_b.{item}").alias("_e"))

    groups = entries("Groups_Real_Estate", "Group_Real_Estate").select(
        *rest, F.col("_e.ID_Group").alias("id_group"), F.col("_e.Name_Group").alias("name_group")
    )
    members = entries("Real_Estates", "Real_Estate").select(
        *rest, F.col("_e.CadastralNumber").alias("cad_num"), F.col("_e.`@ID_Group`").alias("id_group")
    )
    return groups, members
