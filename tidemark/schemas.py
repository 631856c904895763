"""Column contracts of the supported inputs and tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "binary": T.BinaryType(),
    "price": T.DecimalType(10, 4),
    "rate": T.DecimalType(18, 6),
}


def struct_of(fields: str | dict[str, str | T.DataType]) -> T.StructType:
    """Struct of ``"name type, name type"`` or of a mapping; made without a session."""
    if isinstance(fields, str):
        fields = dict(part.split() for part in fields.split(","))
    return T.StructType(
        [T.StructField(name, _TYPES[kind] if isinstance(kind, str) else kind) for name, kind in fields.items()]
    )


def texts(*names: str) -> T.StructType:
    return struct_of(dict.fromkeys(names, "string"))


_TEXT_LIST = T.ArrayType(T.StringType())

# --- event envelope and its two payload kinds -------------------------------

ENVELOPE = struct_of(
    {
        "object_id": "string",
        "object_type": "string",
        "sent_dttm": "timestamp",
        "payload": T.MapType(T.StringType(), T.StringType()),
    }
)
MESSAGE_COLUMNS = ["object_id", "object_type", "sent_dttm", "payload"]

TRANSACTION = struct_of(
    "operation_id string, account_number_from bigint, account_number_to bigint,"
    " currency_code string, country string, status string, transaction_type string,"
    " amount bigint, transaction_dt timestamp"
)
CURRENCY = struct_of(
    "date_update timestamp, currency_code string, currency_code_with string, currency_with_div rate"
)
PAYLOADS = {"TRANSACTION": TRANSACTION, "CURRENCY": CURRENCY}

# --- price bars --------------------------------------------------------------

PRICE_TEXT = texts("time", "open", "high", "low", "close", "volume")
PRICE = struct_of("time timestamp, open price, high price, low price, close price, volume bigint")
# Field names of the JSON price form.
PRICE_JSON_FIELDS = {
    "open": "1. open",
    "high": "2. high",
    "low": "3. low",
    "close": "4. close",
    "volume": "5. volume",
}

# --- registry documents ------------------------------------------------------
# One superset of all object kinds and versions; every leaf is text and is cast
# later, because versions disagree on types.

_YEARS = texts("@YearBuilt", "@YearUsed")
_NUMBERS = struct_of({"CadastralNumber": _TEXT_LIST})
_ADDRESS = (
    dict.fromkeys(("FIAS", "OKATO", "KLADR", "Note", "Other", "@Other"), "string")
    | dict.fromkeys(
        ("District", "City", "UrbanDistrict", "SovietVillage", "Locality", "Street"), texts("@Type", "@Name")
    )
    | dict.fromkeys(("Level1", "Level2", "Level3", "Apartment"), texts("@Type", "@Value", "@Name"))
)
# Buildings hold their address in the location itself, plots one level deeper.
_LOCATION = struct_of(_ADDRESS | {"Address": struct_of(_ADDRESS)})
_MATERIALS = struct_of({"Material": T.ArrayType(texts("@Wall"))})

# Element and attribute names of registry objects.
REGISTRY_OBJECT = struct_of(
    {
        "@CadastralNumber": "string",
        "@DateCreated": "string",
        "@FoundationDate": "string",
        "CadastralBlock": "string",
        "Category": "string",
        "ObjectType": "string",
        "Name": "string",
        "DegreeReadiness": "string",
        "Location": _LOCATION,
        "ParentOKS": struct_of(
            {
                "CadastralNumberOKS": "string",
                "ObjectType": "string",
                "AssignationBuilding": "string",
                "ExploitationChar": _YEARS,
                "ElementsConstruct": _MATERIALS,
            }
        ),
        "ParentCadastralNumbers": _NUMBERS,
        "InnerCadastralNumbers": _NUMBERS,
        "Utilization": texts("@Utilization", "@LandUse", "@ByDoc", "@PermittedUseText"),
        "ObjectPermittedUses": struct_of({"ObjectPermittedUse": _TEXT_LIST}),
        "PositionInObject": texts("@Number"),
        "AssignationBuilding": "string",
        "AssignationName": "string",
        "Assignation": texts("AssignationCode"),
        "Area": texts("Area", "_VALUE"),
        "Material": T.ArrayType(texts("@Wall")),
        "ElementsConstruct": _MATERIALS,
        "KeyParameters": T.ArrayType(struct_of({"KeyParameter": T.ArrayType(texts("@Type", "@Value"))})),
        "Floors": texts("@Floors"),
        "ExploitationChar": _YEARS,
        "CadastralCost": texts("@Value"),
    }
)

# Fixed value: the outermost element of a registry document.
REGISTRY_ROOT = "ListForRating"
# Containers of a registry document and the element inside each.
REGISTRY_KINDS = {
    "Buildings": "Building",
    "Constructions": "Construction",
    "Uncompleteds": "Uncompleted",
    "Flats": "Flat",
    "CarParkingSpaces": "CarParkingSpace",
    "Parcels": "Parcel",
    "UnifiedRealEstateComplex": "UnifiedComplex",
}

REGISTRY_DOCUMENT = T.StructType(
    [
        # The header is kept whole, whatever it holds.
        T.StructField("ListInfo", T.VariantType()),
        T.StructField(
            "Objects",
            T.StructType(
                [
                    T.StructField(
                        box, T.StructType([T.StructField(item, T.ArrayType(REGISTRY_OBJECT))])
                    )
                    for box, item in REGISTRY_KINDS.items()
                ]
            ),
        ),
    ]
)

# Key-parameter code -> column.
KEY_PARAMETERS = {
    "01": "length",
    "02": "depth",
    "03": "volume",
    "04": "height",
    "05": "square",
    "06": "builtsquare",
    "07": "depthoo",
}

# Columns of the wide parcel table.
PARCEL_COLUMNS = [
    "cad_num", "address1", "address2", "category", "cad_num_quarter", "date_created",
    "foundation_date", "parent_cad_num", "parent_year_built", "parent_year_used",
    "parent_object_type", "parent_assignation_building", "parent_cadastral_numbers",
    "inner_cadastral_numbers", "cost_old", "utilization_cod_old", "utilization_cod_new",
    "utilization", "utilization_doc", "purpose", "vid", "name", "area", "wall", "okato", "fias",
    "kladr", "percent", "year_built", "year_used", "floors", "length", "depth", "volume", "height",
    "square", "builtsquare", "depthoo", "date_rosreestr_out", "request_file_id",
]

# --- request / response documents ---------------------------------------------

REQUEST = struct_of(
    "request_id bigint, request_date date, request_reg_num string, request_type_id int,"
    " request_name string, request_description string, request_pdf binary"
)
RESPONSE = struct_of(
    "response_id bigint, response_date date, response_name string, response_request_id bigint"
)
REJECTED = struct_of(
    "table_name string, description string, src string, file_name string, row string, date timestamp"
)
SHEET_ROWS = struct_of({"file": "string", "sheet": "string", "row_no": "int", "cells": _TEXT_LIST})

# --- listings -------------------------------------------------------------------

# Columns of listings, and those that each kind adds.
AD_BASE = struct_of(
    "ad_id bigint, time_stamp timestamp, name string, address string, price_value double,"
    " price_currency string, price_original string, x double, y double, square_value double,"
    " square_currency string, square_original string, description string, other string, url string,"
    " phone string, screenshot_file string, category string, locality string, section_id int"
)
AD_EXTRAS = {
    "flat": struct_of("floor int, house_floors int, rooms int, house_type string"),
    "house": struct_of("wall string, to_city string, floors int, square_zu string"),
    "zu": struct_of("to_city string"),
    "garage": T.StructType([]),
    "commercial": T.StructType([]),
}
AD_QUEUE = struct_of(
    "id bigint, url string, ad_id bigint, status string, kind string, locality string,"
    " time_stamp timestamp, section_id int"
)

# --- vault, mart and star tables ---------------------------------------------------

_AUDIT = ", load_dt timestamp, load_src string"
# Columns of the vault tables.
VAULT = {
    "h_transactions": struct_of(
        "hk binary, operation_id string, amount bigint, transaction_type string, transaction_dt timestamp" + _AUDIT
    ),
    "h_accounts": struct_of("hk binary, account_number bigint" + _AUDIT),
    "h_countries": struct_of("hk binary, country_name string" + _AUDIT),
    "h_currencies": struct_of("hk binary, currency_code string" + _AUDIT),
    "l_transaction_account": struct_of(
        "hk binary, hk_transaction binary, hk_account_from binary, hk_account_to binary" + _AUDIT
    ),
    "l_transaction_country": struct_of("hk binary, hk_transaction binary, hk_country binary" + _AUDIT),
    "l_transaction_currency": struct_of("hk binary, hk_transaction binary, hk_currency binary" + _AUDIT),
    "s_transaction_status": struct_of("hk_transaction binary, status string, status_dt timestamp" + _AUDIT),
    "s_currency_div": struct_of(
        "hk_currency binary, hk_currency_with binary, div rate, date_update timestamp" + _AUDIT
    ),
}
# What is unique in each vault table; the tables are bucketed by it.
VAULT_KEYS = {
    "h_transactions": ["operation_id"],
    "h_accounts": ["account_number"],
    "h_countries": ["country_name"],
    "h_currencies": ["currency_code"],
    "l_transaction_account": ["hk_transaction", "hk_account_from", "hk_account_to"],
    "l_transaction_country": ["hk_transaction", "hk_country"],
    "l_transaction_currency": ["hk_transaction", "hk_currency"],
    "s_transaction_status": ["hk_transaction", "status_dt", "status"],
    "s_currency_div": ["hk_currency", "hk_currency_with", "date_update"],
}
LEDGER = struct_of("upload_id bigint, date date, symbol_name string, interval_name string, uploaded boolean")
# Columns of the star schema.
STAR = {
    "d_interval": struct_of("interval_id bigint, interval_name string"),
    "d_symbol_act": struct_of("symbol_id bigint, symbol_name string"),
    "d_symbol_hist": struct_of(
        "symbol_id bigint, symbol_name string, symbol_valid_from timestamp, symbol_valid_to timestamp"
    ),
    "d_time_serial": struct_of(
        "time_serial_id bigint, time_serial_time timestamp, time_serial_interval_id bigint"
    ),
    "f_price": struct_of(
        "price_open price, price_high price, price_low price, price_close price, price_volume bigint,"
        " price_symbol_id bigint, price_time_id bigint"
    ),
}
