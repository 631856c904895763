"""Loosely structured sheets, as rows of cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(cell: Column) -> Column:
    return cell.isNotNull() & (F.trim(cell) != "")


def header_names(cells: str | Column) -> Column:
    """Upper-cased names; one running number marks blank and repeated ones."""
    start = F.struct(F.array().cast("array<string>").alias("names"), F.lit(0).alias("n"))

    def add(state: Column, cell: Column) -> Column:
        blank = ~F.coalesce(present(cell), F.lit(False))
        n = state["n"] + blank.cast("int")
        name = F.when(blank, F.concat(F.lit("NAN"), state["n"].cast("string"))).otherwise(F.upper(cell))
        repeated = F.array_contains(state["names"], name)
        unique = F.when(repeated, F.concat(name, n.cast("string"))).otherwise(name)
        return F.struct(
            F.array_append(state["names"], unique).alias("names"), (n + repeated.cast("int")).alias("n")
        )

    return F.aggregate(cells, start, add, lambda s: s["names"])


def sheet_headers(rows: DataFrame) -> DataFrame:
    """Header row of each sheet: the first whose second cell is present.

    ``found`` is false where that is the very first row, which has no preamble
    above it and so does not count as a found header.
    """
    second = F.try_element_at("cells", F.lit(2))
    named = F.when(F.coalesce(present(second), F.lit(False)), F.col("row_no"))
    found = rows.groupBy("file", "sheet").agg(
        F.min("row_no").alias("_first"), F.min(named).alias("header_row"), F.min_by("cells", named).alias("_cells")
    )
    return found.where(F.col("header_row").isNotNull()).select(
        "file", "sheet", "header_row", (F.col("header_row") > F.col("_first")).alias("found"), header_names("_cells").alias("names")
    )


def read_sheet_rows(rows: DataFrame, need_preamble: bool = True) -> DataFrame:
    """Data rows below each sheet's header as ``record``: header name -> cell.

    With ``need_preamble`` sheets whose header is their first row are left out.
    Rows shorter or longer than the header are fitted to it.
    """
    headers = sheet_headers(rows)
    if need_preamble:
        headers = headers.filter("found")
    width = F.size("names")
    padded = F.slice(F.concat(F.col("cells"), F.array_repeat(F.lit(None).cast("string"), width)), F.lit(1), width)
    return (
        rows.join(headers, ["file", "sheet"])
        .filter(F.col("row_no") > F.col("header_row"))
        .select("file", "sheet", "row_no", "names", F.map_from_arrays("names", padded).alias("record"))
    )
