"""Small helpers shared by the operators that run Python on Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

import barloom

#: Characters of text that are turned into Python objects at a time.
CHUNK_CHARS = 1 << 20


#: Rows of an Arrow batch at most, so that batches of very long texts fit a worker.
BATCH_ROWS = 1000


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application: they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(barloom.__file__).parent
    archive = f"{tempfile.mkdtemp(prefix='barloom-')}/barloom.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, f"{package.name}/{file.relative_to(package)}")
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def batch_limit(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Make a session ready for Python on Arrow batches: lower its limit of rows in one, and ship the package."""
    ship(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def pieces(batch: pa.RecordBatch, column: str, chars: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``chars`` bytes of one string or binary column, one row at least."""
    if not batch.num_rows:
        return
    sizes = batch.column(column).nbytes / batch.num_rows
    if sizes * batch.num_rows <= chars:
        yield batch
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, length in enumerate(lengths):
        if held and held + length > chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += length
    yield batch.slice(start)


def with_columns(
    df: DataFrame, column: str, added: list[T.StructField], make: Callable[[list[str | None]], list[list]]
) -> DataFrame:
    """The rows with columns computed from one text column; columns of the same name are replaced.

    ``make`` gets a list of texts of bounded total size and returns one list for each added column.
    """
    names = [f.name for f in added]
    kept = [c for c in df.columns if c not in names or c == column]
    shown = [c for c in kept if c not in names]
    schema = T.StructType([*[df.schema[c] for c in shown], *added])
    types = [to_arrow_type(f.dataType) for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, column):
                made = make(part.column(column).to_pylist())
                arrays = [pa.array(v, t) for v, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in shown], *arrays], [*shown, *names])

    batch_limit(df.sparkSession)
    return df.select(*[f"`{c}`" for c in kept]).mapInArrow(run, schema)
