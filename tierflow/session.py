"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Results depend on these.
REQUIRED = {
    # Event times travel as text through the raw tier, so text and instants
    # must convert the same way on every machine.
    "spark.sql.session.timeZone": "UTC",
    # `date=2024-01-01` folders stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}
# Plans depend on these; a session's own choice stands.
PREFERRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Shuffled bytes that a task takes and files the rebalanced writers aim for. Events with the name
    # of their file take ten times as much in memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # Partition values that a task writes side by side. It sorts its rows for more of them only.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Reduce tasks per core before adaptive execution merges the small ones.
WAVES = 16


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session."""
    own = spark.conf.getAll
    for name, value in REQUIRED.items():
        spark.conf.set(name, value)
    for name, value in PREFERRED.items():
        if name not in own:
            spark.conf.set(name, value)
    if INITIAL_PARTITIONS not in own and not is_local(spark):
        static = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(INITIAL_PARTITIONS, str(max(static, WAVES * spark.sparkContext.defaultParallelism)))
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a session on local master may go without that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tierflow-")
    return f"{root.rstrip('/')}/tierflow/{label}-{uuid.uuid4().hex}"
