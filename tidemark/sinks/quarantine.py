"""Typed loads that keep bad rows aside instead of failing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cast_problems(schema: T.StructType, required: Sequence[str], raw: Mapping[str, Column] | None = None) -> list[Column]:
    """What keeps text values from the schema's types, each NULL where nothing does."""
    problems = []
    for field in schema:
        value = F.col(field.name) if raw is None else raw[field.name]
        typed = value.try_cast(field.dataType)
        problems.append(F.when(value.isNotNull() & typed.isNull(), F.lit(f"{field.name}: not a {field.dataType.simpleString()}")))
        if field.name in required:
            problems.append(F.when(value.isNull(), F.lit(f"{field.name}: missing")))
    return problems


def typed_or_rejected(df: DataFrame, schema: T.StructType, required: Sequence[str] | None = None) -> DataFrame:
    """Cast text columns to the schema and add ``reject_reason`` (NULL for good rows).

    A row is bad when a value does not cast or a required one is missing.
    """
    problems = cast_problems(schema, schema.names if required is None else required)
    rest = [c for c in df.columns if c not in schema.names]
    reason = F.nullif(F.concat_ws("; ", *problems), F.lit(""))
    return df.select(
        *rest,
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema],
        F.struct(*schema.names).alias("_raw"),
        reason.alias("reject_reason"),
    )


def copy_with_rejects(
    df: DataFrame, schema: T.StructType, required: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Good rows in the schema's types, and bad ones as they came with their reason."""
    checked = typed_or_rejected(df, schema, required)
    rest = [c for c in df.columns if c not in schema.names]
    good = checked.filter(F.col("reject_reason").isNull()).drop("_raw", "reject_reason")
    bad = checked.filter(F.col("reject_reason").isNotNull()).select(
        *rest, *[F.col("_raw")[n].alias(n) for n in schema.names], "reject_reason"
    )
    return good, bad


def quarantine(
    df: DataFrame,
    problem: Column,
    table_name: str,
    src: str,
    run_ts: Column,
    file_name: Column | None = None,
    row: Column | None = None,
    unit: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Split off failing rows as log entries; ``problem`` is NULL for good rows.

    With ``unit`` a failing row takes its whole unit (a file, a response) out of
    the load, and the log holds one entry per unit.
    """
    marked = df.withColumn("_problem", problem)
    bad = marked.filter(F.col("_problem").isNotNull())
    none = F.lit(None).cast("string")
    entry = [
        F.lit(table_name).alias("table_name"),
        F.col("_problem").alias("description"),
        F.lit(src).alias("src"),
        (none if file_name is None else file_name.cast("string")).alias("file_name"),
        (none if row is None else row.cast("string")).alias("row"),
        run_ts.alias("date"),
    ]
    if not unit:
        return marked.filter(F.col("_problem").isNull()).drop("_problem"), bad.select(*entry)
    log = bad.select(*unit, F.struct(*entry).alias("_e")).groupBy(*unit).agg(F.min("_e").alias("_e"))
    return df.join(log.select(*unit), list(unit), "left_anti"), log.select("_e.*")
