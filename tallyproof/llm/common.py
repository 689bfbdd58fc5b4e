"""Reading tables, storing intermediate results and Arrow helpers shared by the operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.session import fresh_path, session_conf


# Columns of the documents table, which stages read by name.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keeps_columns(stage: Stage) -> Stage:
    """A stage that hands further columns of its input on as they are, whatever they are called."""

    @wraps(stage)
    def kept(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        names = [c if c in DOCUMENT else f"input_column_{k}" for k, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*names), folder).select(*names).toDF(*docs.columns)

    return kept


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: ends lineage, survives lost executors.

    The shuffle files of the write go with it, as only the copy is read again.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with session_conf(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, wherever they were started."""
    context = spark.sparkContext
    if getattr(context, "tallyproof_sent", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tallyproof-")) / "tallyproof.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, Path(package.name) / file.relative_to(package))
    context.addPyFile(str(archive))
    context.tallyproof_sent = True


def mapped(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


def fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def without(df: DataFrame, *names: str) -> list[str]:
    """Backquoted input columns whose names (in any case) are not among ``names``."""
    taken = {n.lower() for n in names}
    return [f"`{c}`" for c in df.columns if c.lower() not in taken]


def row_id(doc_id: str, text: str) -> Column:
    """Number of a row's id and text. Ids alone may be missing or repeated, and a join on them would
    meet all such rows with each other; rows that share this number are copies of each other."""
    ident, body = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    return F.xxhash64(ident.isNull(), ident, body.isNull(), body)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``most`` bytes each, or of a single longer row."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        end = min(rows, max(end, start + 1))
        yield start, end
        start = end
