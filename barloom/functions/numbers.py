"""Number columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(col: Column | str) -> Column:
    """The value, null where it is NaN or infinite: a missing value is null everywhere past the readers."""
    value = F.col(col) if isinstance(col, str) else col
    return F.when(F.abs(value) < F.lit(float("inf")), value)
