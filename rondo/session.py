"""Session helpers: recommended settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# For spark-submit or a builder; the library never changes a running session's settings.
# shuffle.partitions is only the starting count: AQE merges small ones up to the advisory size and the
# joins and sinks below split the large ones, so on a cluster start high (2-3 per core).
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
}


_own_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local run without one gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _own_roots:
        _own_roots[application] = tempfile.mkdtemp(prefix="rondo-")
    return _own_roots[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder. Nothing is created; writers create it."""
    return f"{scratch_root(spark)}/rondo/{label}-{uuid.uuid4().hex}"


def shuffle_tasks(spark: SparkSession) -> int:
    """The session's starting number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
