"""Registration of queries and small result helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Registry(dict):
    """Query name -> (function, SQL text or None)."""

    def query(self, name: str, oracle: str | None = None) -> Callable:
        def register(fn):
            if name in self:
                raise ValueError(f"query {name} registered twice")
            self[name] = (fn, oracle)
            return fn

        return register


def plain(df: DataFrame, places: int = 6) -> DataFrame:
    """Decimals as doubles, which both engines print alike."""
    decimals = [f.name for f in df.schema if f.dataType.typeName().startswith("decimal")]
    return df.withColumns({c: F.round(c, places).cast("double") for c in decimals})
