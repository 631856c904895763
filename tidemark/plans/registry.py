"""Registry documents to wide parcels, and what happens to them afterwards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.documents import alternatives, first_present, pivot_codes
from tidemark.functions.lookup import map_classes
from tidemark.functions.temporal import date_from_name, form_date
from tidemark.functions.text import repair_decimal, spaced_line, trim_chars
from tidemark.operators.aggregates import first_per_key
from tidemark.operators.joins import matching, only_new
from tidemark.operators.sets import union_padded
from tidemark.schemas import KEY_PARAMETERS, PARCEL_COLUMNS
from tidemark.sinks.quarantine import quarantine
from tidemark.sources.sheets import read_sheet_rows, sheet_headers

# Parts of an address and the member that holds each part's text.
ADDRESS_PARTS = [
    ("District", "@Name"), ("City", "@Name"), ("UrbanDistrict", "@Name"), ("SovietVillage", "@Name"),
    ("Locality", "@Name"), ("Street", "@Name"), ("Level1", "@Value"), ("Level2", "@Value"),
    ("Level3", "@Value"), ("Apartment", "@Value"),
]
# Fixed value: parts whose type and text are written without a blank between.
JOINED_PARTS = {"Level2"}

# Sheet headers per parcel column; the first that holds a value wins.
SHEET_ALTERNATIVES = {
    "cad_num": ["КАД №", "КАД. №", "КАДАСТРОВЫЙ № ОКС", "КАДАСТРОВЫЙ НОМЕР ОКС"],
    "address1": ["АДРЕС 1"],
    "address2": ["АДРЕС 2"],
    "category": ["КАТЕГОРИЯ", "КОД КАТЕГОРИИ", "КАТЕГОРИЯ НЕЗАСВИД."],
    "cad_num_quarter": ["№ КАД. КВАРТАЛА", "КАД. КВАРТАЛ", "НОМЕР КАД. КВАРТАЛА", "КАД. КВАРТАЛ ОКС"],
    "cost_old": ["КРАЙНЯЯ КАДАСТРОВАЯ СТОИМОСТЬ"],
    "utilization_cod_old": ["КОД ВРИ ПО П/389", "КОД ВРИ КЛ. РР", "КОД ВРИ РР", "КОД ВРИ РР НЕЗАСВИД."],
    "utilization_cod_new": ["КОД ВРИ МЭР", "КОД ВРИ МЭР НЕЗАСВИД."],
    "utilization": ["ВРИ КЛ. РР"],
    "utilization_doc": ["ВРИ ПО ДОКУМ"],
    "purpose": [
        "КОД НАЗНАЧЕНИЯ", "НАЗНАЧЕНИЕ", "НАЗНАЧЕНИЕ ОКС", "НАЗНАЧЕНИЕ ТЕКСТ", "НАЗНАЧЕНИЕ ТЕКСТ ОКС", "НАЗНАЧЕНИЕ ЕНК",
    ],
    "vid": ["ВИД ОН", "ВИД ОКС", "ВИД ОБЪЕКТА", "КОД ВИДА ОКС", "КОД ВИДА ОБЪЕКТА"],
    "name": [
        "НАИМЕНОВАНИЕ ОКС", "НАИМЕНОВАНИЕ ОКН", "НАИМЕНОВАНИЕ ОБЪЕКТА", "НАИМЕНОВАНИЕ", "НАИМЕНОВАНИЕ ЕНК", "ВИД ЗУ",
        "ТИП ПОМЕЩЕНИЯ",
    ],
    "area": ["ПЛОЩАДЬ", "ПЛОЩАДЬ ЗУ", "ПЛОЩАДЬ ОКС"],
    "kladr": ["КЛАДР"],
    "percent": ["СТЕПЕНЬ ГОТОВНОСТИ ОКС", "СТЕПЕНЬ ГОТОВНОСТИ"],
    "year_built": ["ГОД ЗАВЕРШЕНИЯ СТРОИТЕЛЬСТВА", "ГОД ЗАВЕРШЕНИЯ СТРОИТЕЛЬСТВА ОКС"],
    "year_used": ["ГОД ВВОДА В ЭКСПЛУАТАЦИЮ", "ГОД ВВОДА В ЭКСПЛУАТАЦИЮ ОКС"],
    # Headers are upper-cased when read, so this name is too.
    "floors": ["ЭТАЖ", "ОБЩАЯ ЭТАЖНОСТЬ ОКС"],
    "length": ["ПРОТЯЖЕННОСТЬ ОКС", "ПРОТЯЖЕННОСТЬ"],
    "depth": ["ГЛУБИНА ОКС", "ГЛУБИНА"],
    "volume": ["ОБЪЕМ ОКС", "ОБЪЕМ"],
    "height": ["ВЫСОТА ОКС", "ВЫСОТА"],
    "builtsquare": ["ПЛ.ЗАСТРОЙКИ", "ПЛ.ЗАСТРОЙКИ ОКС"],
    "depthoo": ["ГЛУБИНА ЗАЛЕГАНИЯ ОКС", "ГЛУБИНА ЗАЛЕГАНИЯ"],
}
# Headers whose values are all kept, in order.
WALL_HEADERS = ["МАТЕРИАЛ СТЕН", "МАТЕРИАЛ СТЕН ОКС", "КОД МАТЕРИАЛА СТЕН ОКС"]

# Parcel columns that hold classifier codes, single and several.
XML_CODED = [
    "category", "parent_object_type", "parent_assignation_building", "utilization_cod_old", "utilization_cod_new",
    "purpose", "vid", "name",
]
XML_CODED_LISTS = ["parent_cadastral_numbers", "inner_cadastral_numbers", "wall"]
SHEET_CODED = ["category", "utilization_cod_old", "utilization_cod_new", "purpose", "vid", "name"]

# Export headings.
EXPORT_NAMES = {
    "cad_num": "Кадастровый номер",
    "cad_num_quarter": "Кадастровый номер квартала",
    "date_created": "Дата присвоения кадастрового номера",
    "foundation_date": "Дата возникновения оснований",
    "parent_cad_num": "Родит. КН",
    "parent_year_built": "Родит. дата заверш. строит.",
    "parent_year_used": "Родит. дата ввода в эксплуат.",
    "parent_object_type": "Родит. вид объекта",
    "parent_assignation_building": "Родит. назначение здания",
    "parent_cadastral_numbers": "КН в пределах кот. распол.",
    "inner_cadastral_numbers": "Кадастровые номера расположенных в пределах земельного участка",
    "cost_old": "Текущая КС",
    "utilization_cod_old": "ВРИ ранее использ. класс.",
    "utilization_cod_new": "ВРИ по класс.",
    "utilization": "ВРИ текст",
    "utilization_doc": "ВРИ по документу",
    "purpose": "Разрешенное использование",
    "category": "Категория",
    "vid": "Вид",
    "name": "Наименование",
    "area": "Площадь",
    "wall": "Материал стен",
    "okato": "ОКАТО",
    "fias": "ФИАС",
    "kladr": "КЛАДР",
    "address1": "Адрес1",
    "address2": "Адрес2",
    "percent": "% заверш.",
    "year_built": "Дата заверш. строит.",
    "year_used": "Дата ввода в эксплуат.",
    "floors": "Этажей",
    "length": "Протяженность",
    "depth": "Глубина",
    "volume": "Объем",
    "height": "Высота",
    "square": "Площадь_",
    "builtsquare": "Площадь застройки",
    "depthoo": "Глубина залегания",
    "date_rosreestr_out": "Дата выгрузки рееста",
    "request_date": "Дата поступления реестра",
    "request_name": "Наименование реестра",
}


def _of_address(location: str, part: str) -> Column:
    """Part of an address, which stands in the location or in an address inside it."""
    return first_present(F.col(f"{location}.{part}"), F.col(f"{location}.Address.{part}"))


def address_line(location: str, trim: bool = True) -> Column:
    """Types and names of all address parts on one line."""
    pieces: list[Column | str] = []
    for part, member in ADDRESS_PARTS:
        box = _of_address(location, part)
        gap = [] if part in JOINED_PARTS else [" "]
        pieces += [box["@Type"], *gap, box[member], " "]
    return spaced_line([*pieces, first_present(_of_address(location, "Other"), _of_address(location, "`@Other`"))], trim)


def _walls(*lists: Column) -> Column:
    """Wall codes of several lists of materials, in order; NULL where no list is present."""
    none = F.array().cast("array<string>")
    codes = [F.coalesce(F.transform(materials, lambda m: m["@Wall"]), none) for materials in lists]
    return F.when(F.coalesce(*lists).isNotNull(), F.concat(*codes))


def _quoted_list(values: Column) -> Column:
    """Texts as a JSON array with blanks after the commas, NULL for NULL."""
    quoted = F.transform(values, lambda v: F.regexp_replace(F.to_json(F.array(v)), r"^\[|\]$", ""))
    return F.when(values.isNotNull(), F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")))


def _with_classes(df: DataFrame, cols: Sequence[str], lists: Sequence[str], classifier: DataFrame) -> DataFrame:
    return map_classes(df, cols, {c: c for c in lists}, classifier)


def parse_objects(objects: DataFrame, classifier: DataFrame, obj: str = "object") -> DataFrame:
    """Registry objects (columns ``object``, ``options``, ``request_file_id``) to parcels.

    One row per object. Dates stay text here, so that a bad one can be told
    from a missing one.
    """

    def at(path: str) -> Column:
        return F.col(f"{obj}.{path}")

    pairs = F.flatten(F.transform(at("KeyParameters"), lambda k: k["KeyParameter"]))
    parcels = objects.select(
        at("`@CadastralNumber`").alias("cad_num"),
        _of_address(f"{obj}.Location", "Note").alias("address1"),
        address_line(f"{obj}.Location").alias("address2"),
        at("Category").alias("category"),
        at("CadastralBlock").alias("cad_num_quarter"),
        at("`@DateCreated`").alias("date_created"),
        at("`@FoundationDate`").alias("foundation_date"),
        at("ParentOKS.CadastralNumberOKS").alias("parent_cad_num"),
        at("ParentOKS.ExploitationChar.`@YearBuilt`").alias("parent_year_built"),
        at("ParentOKS.ExploitationChar.`@YearUsed`").alias("parent_year_used"),
        at("ParentOKS.ObjectType").alias("parent_object_type"),
        at("ParentOKS.AssignationBuilding").alias("parent_assignation_building"),
        at("ParentCadastralNumbers.CadastralNumber").alias("parent_cadastral_numbers"),
        at("InnerCadastralNumbers.CadastralNumber").alias("inner_cadastral_numbers"),
        at("CadastralCost.`@Value`").alias("cost_old"),
        at("Utilization.`@Utilization`").alias("utilization_cod_old"),
        at("Utilization.`@LandUse`").alias("utilization_cod_new"),
        first_present(
            at("Utilization.`@PermittedUseText`"),
            _quoted_list(at("ObjectPermittedUses.ObjectPermittedUse")),
            at("PositionInObject.`@Number`"),
        ).alias("utilization"),
        at("Utilization.`@ByDoc`").alias("utilization_doc"),
        first_present(at("AssignationBuilding"), at("AssignationName"), at("Assignation.AssignationCode")).alias(
            "purpose"
        ),
        at("ObjectType").alias("vid"),
        at("Name").alias("name"),
        first_present(at("Area.Area"), at("Area._VALUE")).alias("area"),
        _walls(at("Material"), at("ElementsConstruct.Material"), at("ParentOKS.ElementsConstruct.Material")).alias("wall"),
        *[_of_address(f"{obj}.Location", c.upper()).alias(c) for c in ("okato", "fias", "kladr")],
        at("DegreeReadiness").alias("percent"),
        at("ExploitationChar.`@YearBuilt`").alias("year_built"),
        at("ExploitationChar.`@YearUsed`").alias("year_used"),
        at("Floors.`@Floors`").alias("floors"),
        *pivot_codes(pairs, KEY_PARAMETERS),
        form_date("options").alias("date_rosreestr_out"),
        "request_file_id",
    )
    return _with_classes(parcels, XML_CODED, XML_CODED_LISTS, classifier).select(*PARCEL_COLUMNS)


def parse_sheet_records(records: DataFrame, classifier: DataFrame, record: str = "record") -> DataFrame:
    """Sheet rows (columns ``record``, ``options``, ``request_file_id``) to parcels.

    Columns no sheet carries are absent; the union with the documents pads them.
    """
    parcels = records.select(
        *[alternatives(record, names).alias(target) for target, names in SHEET_ALTERNATIVES.items()],
        F.array(*[F.try_element_at(F.col(record), F.lit(h)) for h in WALL_HEADERS]).alias("wall"),
        form_date("options").alias("date_rosreestr_out"),
        "request_file_id",
    )
    return _with_classes(parcels, SHEET_CODED, ["wall"], classifier)


def parse_parcels(objects: DataFrame, records: DataFrame, classifier: DataFrame) -> DataFrame:
    """Objects of documents and rows of sheets as one set of parcels."""
    return union_padded(parse_objects(objects, classifier), parse_sheet_records(records, classifier)).select(
        *PARCEL_COLUMNS
    )


PARCEL_DATES = ["date_created", "foundation_date"]


def load_parcels(parcels: DataFrame, run_ts: Column, table: str = "parcel") -> tuple[DataFrame, DataFrame]:
    """Parcels with typed dates; a file with a bad date is kept out and logged."""
    problem = None
    for col in PARCEL_DATES:
        bad = F.col(col).isNotNull() & F.col(col).try_cast("timestamp").isNull()
        text = F.concat(F.lit(f"{col}: "), F.col(col))
        problem = F.when(bad, text) if problem is None else problem.when(bad, text)
    good, log = quarantine(
        parcels, problem, table, "request_file", run_ts, row=F.col("request_file_id"), unit=["request_file_id"]
    )
    return good.withColumns({c: F.col(c).try_cast("timestamp") for c in PARCEL_DATES}), log


def export_view(parcels: DataFrame, files: DataFrame, requests: DataFrame) -> DataFrame:
    """Parcels under their export headings, with the request they came by."""
    joined = parcels.join(files.select("request_file_id", "request_id"), "request_file_id").join(
        requests.select("request_id", "request_date", "request_name"), "request_id"
    )
    return joined.select(*[F.col(src).alias(heading) for src, heading in EXPORT_NAMES.items()])


def result_parcels(
    costs: DataFrame, groups: DataFrame, members: DataFrame, number_type: str = "decimal(38,18)"
) -> DataFrame:
    """Costs with the group of each number in the same response.

    ``costs`` holds ``response_file_id, response_id, cad_num, cost, upks``;
    ``groups`` and ``members`` hold ``response_id`` beside their own columns.
    """
    named = (
        members.select("response_id", trim_chars("cad_num", '"').alias("cad_num"), "id_group")
        .distinct()
        .join(groups.select("response_id", "id_group", "name_group").distinct(), ["response_id", "id_group"], "left")
        .select("response_id", "cad_num", "name_group")
    )
    return costs.select(
        "response_file_id",
        "response_id",
        trim_chars("cad_num", '"').alias("cad_num"),
        repair_decimal("cost", number_type).alias("cost"),
        repair_decimal("upks", number_type).alias("upks"),
    ).join(named, ["response_id", "cad_num"], "left").select(
        "response_file_id", "cad_num", "cost", "upks", F.col("name_group").alias("group")
    )


def _one_per_date(rows: DataFrame, date: str, id_col: str) -> DataFrame:
    """The smallest id of each date, so that a date links to one row only."""
    return rows.filter(F.col(date).isNotNull()).groupBy(F.to_date(date).alias("_date")).agg(F.min(id_col).alias("_found"))


def link_responses(
    responses: DataFrame, requests: DataFrame, request_floor: str | None = None, response_floor: str | None = None
) -> DataFrame:
    """Fill in the request of responses whose name holds the request's date.

    Linked responses and those not after the floor stay as they are.
    """
    candidates = requests if request_floor is None else requests.filter(F.col("request_date") > F.lit(request_floor).cast("date"))
    wanted = date_from_name("response_name", "response_date")
    if response_floor is not None:
        wanted = F.when(F.col("response_date") > F.lit(response_floor).cast("date"), wanted)
    wanted = F.when(F.col("response_request_id").isNull(), wanted)
    return (
        responses.withColumn("_date", wanted)
        .join(_one_per_date(candidates, "request_date", "request_id"), "_date", "left")
        .withColumn("response_request_id", F.coalesce("response_request_id", "_found"))
        .select(*responses.columns)
    )


def link_codes(code_files: DataFrame, requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Fill in the response of code files through the request of the date in their name."""
    answered = responses.filter(F.col("response_request_id").isNotNull()).select(
        F.col("response_request_id").alias("request_id"), "response_id"
    )
    by_date = _one_per_date(requests.join(answered, "request_id"), "request_date", "response_id")
    wanted = F.when(F.col("response_id").isNull(), date_from_name("name", "date"))
    return (
        code_files.withColumn("_date", wanted)
        .join(by_date, "_date", "left")
        .withColumn("response_id", F.coalesce("response_id", "_found"))
        .select(*code_files.columns)
    )


# Sheets of accepted and refused records in an act.
ACT_SHEETS = {"II": "count_ok", "III": "count_bad"}


def load_act_counts(rows: DataFrame, sheets: Mapping[str, str] = ACT_SHEETS) -> DataFrame:
    """Accepted and refused records per act file; files with an unfound header are left out.

    A sheet with a header and no rows counts 0.
    """
    wanted = rows.filter(F.col("sheet").isin(list(sheets)))
    complete = sheet_headers(wanted).filter("found").groupBy("file").agg(F.count_distinct("sheet").alias("_sheets"))
    complete = complete.filter(F.col("_sheets") == len(sheets)).select("file")
    data = read_sheet_rows(wanted).withColumn("_first", F.try_element_at("record", F.get("names", F.lit(0))))
    counts = data.groupBy("file").agg(
        *[F.count(F.when(F.col("sheet") == sheet, F.col("_first"))).alias(out) for sheet, out in sheets.items()]
    )
    return complete.join(counts, "file", "left").na.fill(0, list(sheets.values()))


# Key column of each code sheet, and the code's column.
CODE_SHEETS = {"ОКС": "КАДАСТРОВЫЙ № ОКС", "ЗУ": "КАД №"}
CODE_COLUMN = "КОД"


def load_codes(rows: DataFrame, known: DataFrame | None = None, sheets: Mapping[str, str] = CODE_SHEETS) -> DataFrame:
    """``(file, code, cad_num)`` of both sheets, for files not yet known."""
    if known is not None:
        rows = only_new(rows, known, "file")
    data = read_sheet_rows(rows.filter(F.col("sheet").isin(list(sheets))), need_preamble=False)
    number = None
    for sheet, header in sheets.items():
        cell = F.try_element_at("record", F.lit(header))
        number = F.when(F.col("sheet") == sheet, cell) if number is None else number.when(F.col("sheet") == sheet, cell)
    codes = data.select("file", F.try_element_at("record", F.lit(CODE_COLUMN)).alias("code"), number.alias("cad_num"))
    return codes.filter(F.col("cad_num").isNotNull())


# --- old layout to new -----------------------------------------------------------


def backfill_requests(lists: DataFrame, scans: DataFrame) -> DataFrame:
    """One request per (date, name) of the old lists, with its scan."""
    joined = lists.join(scans.select("name", "date", "pdf"), ["name", "date"], "left")
    one = first_per_key(joined, ["date", "name"], ["id", "pdf"])
    return one.select(
        F.col("date").alias("request_date"),
        F.lit("").alias("request_reg_num"),
        F.lit(0).alias("request_type_id"),
        F.col("name").alias("request_name"),
        F.col("description").alias("request_description"),
        F.col("pdf").alias("request_pdf"),
    )


def backfill_files(files: DataFrame, lists: DataFrame, requests: DataFrame, wrap_options: bool) -> DataFrame:
    """Old files under their new request; sheet options are wrapped in a JSON object."""
    old = files.join(
        lists.select(F.col("id").alias("list_id"), "date", "name", "description", "options"), "list_id", "left"
    )
    options = F.to_json(F.struct(F.col("options").alias("value"))) if wrap_options else F.col("options")
    return old.join(
        requests.select("request_id", F.col("request_date").alias("date"), F.col("request_name").alias("name")),
        ["date", "name"],
    ).select(
        F.col("file_name").alias("request_file_name"),
        F.col("description").alias("request_file_path"),
        "request_id",
        F.col("content").alias("request_file_content"),
        options.alias("request_file_options"),
    )


def backfill_responses(messages: DataFrame) -> DataFrame:
    """One response per (name, date) of the old messages."""
    one = first_per_key(messages, ["name", "date_in"], ["id"])
    return one.select(
        F.col("name").alias("response_name"),
        F.coalesce("date_out", "date_in").alias("response_date"),
        F.col("date_in").alias("response_date_in"),
        F.lit(0).alias("response_type_id"),
        F.col("pdf").alias("response_pdf"),
    )


def backfill_acts(acts: DataFrame, messages: DataFrame, responses: DataFrame) -> DataFrame:
    """Old acts under their new response."""
    return (
        acts.join(messages.select(F.col("id").alias("message_id"), "name", "date_in"), "message_id")
        .join(
            responses.select("response_id", F.col("response_name").alias("name"), F.col("response_date_in").alias("date_in")),
            ["name", "date_in"],
        )
        .select(
            F.col("ods_name").alias("response_act_ods_filename"),
            F.col("count_ok").alias("response_act_count_ok"),
            F.col("count_bad").alias("response_act_count_bad"),
            "response_id",
        )
    )


def backfill_codes(codes: DataFrame, responses: DataFrame) -> DataFrame:
    """Old codes with the response of their date."""
    by_date = responses.groupBy(F.to_date("response_date").alias("_date")).agg(F.min("response_id").alias("response_id"))
    return codes.withColumn("_date", F.to_date("date")).join(by_date, "_date", "left").select(
        "code", "cad_num", "date", "response_id"
    )


def combined_history(
    parcels: DataFrame, files: DataFrame, requests: DataFrame, responses: DataFrame, results: DataFrame, codes: DataFrame
) -> DataFrame:
    """Every parcel with its request, its response's cost and group, and its code.

    ``results`` holds ``response_id, cad_num, cost, upks, group``; ``codes``
    holds ``response_id, code, cad_num``. Several results or codes of a number
    in one response are reduced to the smallest, so no parcel is repeated.
    """
    answer = responses.filter(F.col("response_request_id").isNotNull()).groupBy(
        F.col("response_request_id").alias("request_id")
    ).agg(F.min(F.struct("response_id", "response_date", "response_name")).alias("_r"))
    keys = ["response_id", "cad_num"]
    cost = results.groupBy(*keys).agg(F.min(F.struct("cost", "upks", "group")).alias("_c"))
    code = codes.groupBy(*keys).agg(F.min("code").alias("code"))
    return (
        parcels.join(files.select("request_file_id", "request_file_name", "request_id"), "request_file_id")
        .join(requests.select("request_id", "request_date", "request_name"), "request_id")
        .join(answer, "request_id", "left")
        .withColumn("response_id", F.col("_r.response_id"))
        .join(cost, keys, "left")
        .join(code, keys, "left")
        .select(
            *parcels.columns,
            "request_file_name",
            "request_date",
            "request_name",
            "response_id",
            F.col("_r.response_date").alias("response_date"),
            F.col("_r.response_name").alias("response_name"),
            F.col("_c.cost").alias("cost"),
            F.col("_c.upks").alias("upks"),
            F.col("_c.group").alias("group"),
            "code",
        )
    )


def export_day(parcels: DataFrame, files: DataFrame, requests: DataFrame, day: str) -> DataFrame:
    """Export rows of the requests received on a day."""
    wanted = requests.filter(F.col("request_date") == F.lit(day).cast("date"))
    return export_view(matching(parcels, matching(files, wanted, "request_id"), "request_file_id"), files, wanted)
