"""Hash keys of business keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*cols: str | Column) -> Column:
    """128-bit binary key of the text form of its inputs, from two hashes of 64 bits with different seeds.

    Casting first makes a number and its text hash alike, so a code kept as a
    number in one feed meets the same code kept as text in another. Which
    inputs are NULL is part of the key.
    """
    given = [F.col(c) if isinstance(c, str) else c for c in cols]
    texts = [c.cast("string") for c in given]
    halves = [F.xxhash64(*texts), F.xxhash64(F.lit("second half"), *[c.isNull() for c in given], *texts)]
    return F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves]))
