"""Hubs, links and satellites.

Every loader returns the rows to append. Loading the same input twice appends
nothing the second time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import hash_key
from tidemark.operators.joins import only_new
from tidemark.operators.sets import union_roles
from tidemark.scale import spread

# Rows whose distinct keys one task gathers for a link.
LINK_ROWS = 500_000


def _audited(df: DataFrame, run_ts: Column, load_src: str) -> DataFrame:
    return df.withColumn("load_dt", run_ts).withColumn("load_src", F.lit(load_src))


def load_hub(
    target: DataFrame | None,
    src: DataFrame,
    key: str,
    run_ts: Column,
    load_src: str,
    attrs: Sequence[str] = (),
    event_ts: str | None = None,
    roles: Sequence[str] = (),
) -> DataFrame:
    """Business keys not yet in the hub, one row each.

    ``attrs`` come from the row with the earliest ``event_ts``. With ``roles``
    the key is gathered from several columns.
    """
    if roles:
        keys = union_roles(src, roles, key)
    elif attrs:
        rows = F.struct(*attrs)
        keys = (
            src.filter(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.min(F.struct(event_ts, rows.alias("_attrs"))).alias("_first"))
            .select(key, "_first._attrs.*")
        )
    else:
        keys = src.select(key).filter(F.col(key).isNotNull()).distinct()
    if target is not None:
        keys = only_new(keys, target, key)
    keyed = keys.select(hash_key(key).alias("hk"), *keys.columns)
    return _audited(keyed, run_ts, load_src)


@dataclass(frozen=True)
class Ref:
    """A hub that a link points to: its rows, its key, the source column, the link column."""

    hub: DataFrame
    hub_key: str
    src_col: str
    out: str


def resolve(src: DataFrame, refs: Sequence[Ref], checked: bool = False) -> DataFrame:
    """Replace business keys by hub keys; the same hub may serve several roles.

    The hub key is a function of the business key, so nothing is joined.
    With ``checked`` rows whose key a hub lacks are left out as well.
    """
    rows = src
    for ref in refs:
        rows = rows.filter(F.col(ref.src_col).isNotNull())
        if checked:
            rows = rows.join(ref.hub.select(F.col(ref.hub_key).alias(ref.src_col)), ref.src_col, "left_semi")
    return rows.withColumns({ref.out: hash_key(ref.src_col) for ref in refs})


def load_link(
    target: DataFrame | None, src: DataFrame, refs: Sequence[Ref], run_ts: Column, load_src: str, checked: bool = False
) -> DataFrame:
    """Distinct key combinations not yet linked, under a key of all references.

    The result of several loads does not depend on how their rows are cut.
    Rows are dealt by their number first: the few bytes of their business keys
    would let one task gather very many of them.
    """
    columns = list(dict.fromkeys(ref.src_col for ref in refs))
    outs = [ref.out for ref in refs]
    rows = spread(src.select(*columns), *columns, per_task=LINK_ROWS).distinct()
    resolved = resolve(rows, refs, checked).select(hash_key(*outs).alias("hk"), *outs)
    if target is not None:
        resolved = only_new(resolved, target, outs).select("hk", *outs)
    return _audited(resolved, run_ts, load_src)


def load_satellite(
    target: DataFrame | None,
    src: DataFrame,
    refs: Sequence[Ref],
    attrs: Mapping[str, str],
    unique: Sequence[str],
    run_ts: Column,
    load_src: str,
) -> DataFrame:
    """Attribute rows with their hub keys, unique on the reference and ``unique`` columns.

    ``attrs`` maps source columns to satellite columns. Of several rows with
    equal key the one with the smallest attributes is kept.
    """
    wanted = list(dict.fromkeys([*[ref.src_col for ref in refs], *attrs]))
    resolved = resolve(src.select(*wanted).distinct(), refs)
    keys = [*[ref.out for ref in refs], *unique]
    columns = [*[ref.out for ref in refs], *attrs.values()]
    rows = resolved.select(*[ref.out for ref in refs], *[F.col(s).alias(t) for s, t in attrs.items()])
    rest = [c for c in columns if c not in keys]
    if rest:
        rows = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(
            *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in columns]
        )
    if target is not None:
        rows = only_new(rows, target, keys)
    return _audited(rows, run_ts, load_src)
