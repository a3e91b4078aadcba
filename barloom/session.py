"""Session helpers: a local session for development, and lineage cuts that survive executor loss."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "barloom", **conf: str) -> SparkSession:
    """A session for tests and small runs; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # Wide rows compile into methods the JIT refuses; beyond this width Spark splits the code.
        .config("spark.sql.codegen.maxFields", "30")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder, because there driver and executors are one process on one machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="barloom-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder once, as Parquet, and continue from the files.

    Columns that a reader does not need are not read again, and filters reach the files. The folder belongs to
    the caller of the session, who removes it when its results are no longer read.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/materialized/{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the executors, once for each application; operators that run Python in tasks call it."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    _sent.add(context.applicationId)
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="barloom-")) / "barloom_core.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, Path(package.name) / file.relative_to(package))
    context.addPyFile(str(archive))
