"""Helpers that the operators share: reading tables, cutting lineage, walking Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import checkpoint_dir

#: Bytes of text that a task turns into numpy arrays at a time; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="barloom-")) / "barloom_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, Path(package.name) / file.relative_to(package))
    context.addPyFile(str(archive))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by any path that Spark can read."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Lets Spark delete the shuffle files of a query when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, so that a lost executor costs no recomputation.

    The shuffle files behind it are not needed any more and go at once, instead of when the driver next collects
    its garbage; so a chain of steps takes the disk of its largest step and not of all.
    """
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a new query, which takes the setting
    finally:
        spark.conf.set(_CLEANUP, before)


#: Up to so many narrow rows a list of documents is broadcast; a longer one is joined.
BROADCAST_IDS = 1_000_000


def short(rows: DataFrame) -> DataFrame:
    """A written table to join with: broadcast when it is counted to be short, whatever Spark's estimate of it."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows


def listed(ids: DataFrame) -> DataFrame:
    """A list of ids to join with, written first."""
    return short(cut(ids))


def without(docs: DataFrame, ids: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is not among ``ids``; rows with a null id stay."""
    return docs.join(listed(ids.select(id_column).distinct()), id_column, "left_anti").select(docs.columns)


def spread(df: DataFrame, column: str) -> int:
    """Number of partitions for a shuffle whose receivers run Python: the session's setting."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def texts_of(column: pa.Array) -> list[str]:
    """The texts of an Arrow column; null is the empty text."""
    return [x or "" for x in column.to_pylist()]


def utf8_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows, without a copy; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(lengths, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose lengths sum to ``most`` at most, or single rows beyond that."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)
