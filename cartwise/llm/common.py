"""Helpers the operators share: table reads, Arrow maps over texts, and tables written in the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from cartwise.session import checkpoint_dir

# A kernel takes lists of values and makes arrays; texts are handed to it in slices of about this many bytes.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_scopes: list[list[str]] = []


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder; inside :func:`cleared` it is deleted when the scope ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Deletes, at the end, the scratch tables made inside. Whatever is made of them must be written by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a table of the shared folder; one that is not there is no fault."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame) -> DataFrame:
    """The rows written once as Parquet in the shared folder and read back: a lineage cut any executor can read."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application; they need not have it installed.

    The archive is made on the driver and served by it, as any file given to ``addPyFile``.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="llm-package-"), "cartwise_package.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    file.write(path, os.path.relpath(path, os.path.dirname(home)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that one holds about ``most`` bytes of the column, and always a row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        share = max(1, int(batch.num_rows * most / max(values.nbytes, 1)))
        for start in range(0, batch.num_rows, share):
            yield batch.slice(start, share)


def map_texts(
    df: DataFrame, schema: str | StructType, kernel: Callable[..., Callable[[pa.RecordBatch], dict | None]], *args,
    column: str = "text",
) -> DataFrame:
    """Run ``kernel(*args)``, made once per task, over slices of the rows; it returns the columns of ``schema`` by name."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = fields.names
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = kernel(*args)
        for piece in slices(batches, column):
            made = step(piece)
            if made is not None:
                yield pa.RecordBatch.from_arrays([_array(made[name]) for name in names], names=names)

    return df.mapInArrow(run, fields)


def carried(df: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """``row``, a struct of the columns to keep, and ``text`` as bytes: whatever the columns are called, none clashes."""
    return df.select(F.struct(*[df[c] for c in columns]).alias("row"), df[text].cast("binary").alias("text"))


def with_row(held: DataFrame, more: str) -> StructType:
    """The schema of what a kernel makes of carried rows: ``row`` and the columns of ``more``."""
    return StructType([StructField("row", held.schema["row"].dataType), *StructType.fromDDL(more).fields])


def _array(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)
