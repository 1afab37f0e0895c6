"""Bounded samples that are the same in every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def least_hashes(df: DataFrame, columns: list[str], rows: int, of: int) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hashes of ``columns``; ``of`` is about how many rows there are.

    Rows that cannot be among them are left out before anything is ordered, so that what
    reaches one place does not grow with the table.
    """
    hashed = F.xxhash64(*columns)
    if of > 4 * rows:
        hashes = hashed <= F.lit(-(1 << 63) + int((2 * rows + 100) / of * (1 << 64)))
        df = df.where(hashes)
    return df.orderBy(hashed, *columns).limit(rows)
