"""Session defaults and the shared folder used for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "parcela", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may fall back to a temporary folder of the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="parcela-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Hash a small table over all cores by a unique key; leave a large one as it is.

    A file of one row group is one task, however many texts have to be parsed in it.  A table that
    already has a partition per core is not shuffled.  ``scan`` must be a plain table scan: its
    partitions are known from the file listing, without running anything.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan


def sizing(shuffle_bytes: int, cores: int, target: int = 128 * 1024**2) -> dict[str, str]:
    """Session settings for a job whose largest shuffle moves that many bytes.

    Shuffles start with partitions of about ``target`` bytes, at least two per core; adaptive
    execution joins small ones and splits skewed ones.
    """
    partitions = max(2 * cores, -(-shuffle_bytes // target))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target),
    }
