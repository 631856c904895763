"""Typed staging of message payloads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.filters import strict_payload
from tidemark.schemas import PAYLOADS
from tidemark.sinks.quarantine import cast_problems, copy_with_rejects


def payload_fields(messages: DataFrame, model: T.StructType, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Messages whose payload has exactly the model's keys, as text columns; and the rest."""
    kind = messages.schema[payload].dataType
    fields = F.col(payload) if isinstance(kind, T.MapType) else F.from_json(payload, "map<string,string>")
    marked = messages.withColumn("_fields", fields)
    fitting = F.coalesce(strict_payload("_fields", model.names), F.lit(False))
    rest = [c for c in messages.columns if c != payload]
    shaped = marked.filter(fitting).select(*rest, *[F.col("_fields")[n].alias(n) for n in model.names])
    return shaped, marked.filter(~fitting).drop("_fields")


def stage_messages(
    messages: DataFrame, object_type: str, model: T.StructType | None = None, type_col: str = "object_type"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Typed rows of one object type, rows that do not cast, and payloads of another shape."""
    model = model or PAYLOADS[object_type]
    shaped, misfits = payload_fields(messages.filter(F.col(type_col) == object_type), model)
    good, bad = copy_with_rejects(shaped, model)
    return good, bad, misfits


# Outcomes of staging: typed rows, rows that do not cast, payloads of another
# shape, and types without a model.
GOOD, BAD, MISFIT, UNKNOWN = "good", "bad", "misfit", "unknown"


def stage_all(
    messages: DataFrame, path: str, models: Mapping[str, T.StructType] | None = None, type_col: str = "object_type", payload: str = "payload"
) -> dict[tuple[str, str], int]:
    """Stage messages of all types in one pass; the number of rows per (type, outcome).

    Payloads are parsed and checked once and all outcomes go out in one write
    partitioned by type and outcome, replacing what the path held of them.
    The numbers are observed while the rows are written, so nothing is read
    twice. ``read_staged`` reads one outcome of a type.
    """
    models = PAYLOADS if models is None else models
    kind = messages.schema[payload].dataType
    fields = F.col(payload) if isinstance(kind, T.MapType) else F.from_json(payload, "map<string,string>")
    rows = messages.withColumn("_fields", fields)
    outcome, reason = F.lit(UNKNOWN), F.lit(None).cast("string")
    for name, model in models.items():
        mine = F.col(type_col) == name
        raw = {f.name: F.col("_fields")[f.name] for f in model}
        fitting = F.coalesce(strict_payload("_fields", model.names), F.lit(False))
        problem = F.nullif(F.concat_ws("; ", *cast_problems(model, model.names, raw)), F.lit(""))
        of_type = F.when(~fitting, MISFIT).when(problem.isNotNull(), BAD).otherwise(GOOD)
        outcome, reason = F.when(mine, of_type).otherwise(outcome), F.when(mine & fitting, problem).otherwise(reason)
        typed = F.struct(*[raw[f.name].try_cast(f.dataType).alias(f.name) for f in model])
        rows = rows.withColumn(f"_{name}", F.when(mine & fitting & problem.isNull(), typed))
    rest = [c for c in messages.columns if c not in (payload, type_col)]
    rows = rows.withColumns({"outcome": outcome, "reject_reason": reason})
    staged = rows.select(
        *rest, "reject_reason", F.when(F.col("outcome") != GOOD, F.col("_fields")).alias("fields"), *[f"_{n}" for n in models], type_col, "outcome"
    )
    watched = Observation()
    kinds = {(n, o): F.count_if((F.col(type_col) == n) & (F.col("outcome") == o)) for n in models for o in (GOOD, BAD, MISFIT)}
    counts = [c.alias(f"{n}/{o}") for (n, o), c in kinds.items()]
    writer = staged.observe(watched, *counts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(type_col, "outcome").parquet(path)
    return {key: watched.get["/".join(key)] for key in kinds}


def read_staged(
    spark: SparkSession, path: str, object_type: str, outcome: str = GOOD, models: Mapping[str, T.StructType] | None = None, type_col: str = "object_type"
) -> DataFrame:
    """One outcome of one type: typed columns of good rows, the payload's texts of others."""
    model = (PAYLOADS if models is None else models)[object_type]
    stored = spark.read.parquet(path).where((F.col(type_col) == object_type) & (F.col("outcome") == outcome))
    rest = [c for c in stored.columns if not c.startswith("_") and c not in ("reject_reason", "fields", type_col, "outcome")]
    if outcome == GOOD:
        return stored.select(*rest, *[F.col(f"_{object_type}.{n}").alias(n) for n in model.names])
    if outcome == BAD:
        return stored.select(*rest, *[F.col("fields")[n].alias(n) for n in model.names], "reject_reason")
    return stored.select(*rest, F.col("fields").alias("payload"))


def staged_rejects(spark: SparkSession, counts: Mapping[tuple[str, str], int]) -> DataFrame:
    """(table_name, rejects) from the numbers that ``stage_all`` observed."""
    return spark.createDataFrame([(n, c) for (n, o), c in counts.items() if o == BAD], "table_name string, rejects bigint")
