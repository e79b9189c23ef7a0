"""Intermediate tables in the shared scratch folder, and the package's code for Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from rondo.session import scratch_path

#: Applications whose workers have the package.
_shipped: set[str] = set()
#: Rows of an Arrow batch; of texts of some kB it holds some MB.
BATCH_ROWS = 2000


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage ends there, and every executor sees it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def share_code(spark: SparkSession) -> None:
    """Ship this package to the Python workers, once a session: they need not see the folder the driver has it in."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    # Spark copies the file from the driver to every executor, also to those that come later.
    archive = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python ``BATCH_ROWS`` at a time, unless the session names a number of its own.

    A worker's memory, and that of its executor's buffers, follows the batch. For applications: operators leave settings alone.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows, None) is None:
        spark.conf.set(rows, str(BATCH_ROWS))
