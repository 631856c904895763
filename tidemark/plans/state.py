"""Progress marks, resumable loads and status changes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY, SETTINGS = "workflow_key", "workflow_settings"


def read_mark(state: DataFrame, key: str, mark: str, default: int = -1) -> int:
    row = state.filter(F.col(KEY) == key).select(SETTINGS).first()
    return default if row is None else json.loads(row[0]).get(mark, default)


def incremental_load(
    src: DataFrame, state: DataFrame, key: str, id_col: str, mark: str = "last_loaded", default: int = -1
) -> tuple[DataFrame, DataFrame]:
    """Rows after the stored mark, and the state row that belongs to having loaded them.

    The mark moves to the largest id read, whether or not its rows prove valid
    later, so a page without a single valid row cannot stall the load.
    """
    last = read_mark(state, key, mark, default)
    rows = src.filter(F.col(id_col) > last)
    reached = F.coalesce(F.max(id_col), F.lit(last)).cast("bigint")
    new_state = rows.agg(reached.alias(mark)).select(
        F.lit(key).alias(KEY), F.to_json(F.struct(mark)).alias(SETTINGS)
    )
    return rows, new_state


def claim(queue: DataFrame, status: str = "status", waiting: str = "no", claimed: str = "proceed") -> DataFrame:
    """Mark everything that waits as being worked on."""
    return queue.withColumn(status, F.when(F.col(status) == waiting, claimed).otherwise(F.col(status)))


def advance_status(queue: DataFrame, results: DataFrame, key: str = "id", status: str = "status") -> DataFrame:
    """Take over the status of each finished entry; others keep theirs.

    Should an entry report twice, ``ok`` outweighs ``err``.
    """
    final = results.groupBy(key).agg(F.max(status).alias("_status"))
    return (
        queue.join(final, key, "left")
        .withColumn(status, F.coalesce("_status", F.col(status)))
        .drop("_status")
        .select(*queue.columns)
    )


def finish_session(sessions: DataFrame, key: str, value, status: str = "status") -> DataFrame:
    """The running session becomes exported."""
    return sessions.withColumn(status, F.when(F.col(key) == value, "exported").otherwise(F.col(status)))
