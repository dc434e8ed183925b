"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def configure(spark: SparkSession) -> SparkSession:
    """UTC, which the results depend on, and the run-time splitting of skewed join partitions, also
    where it costs a shuffle more: one member, provider or claim may hold a third of the rows. Shuffled partitions are put
    together up to 16 MB only: ids and words shrink tenfold when packed, and four tasks must sort theirs in memory."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(ADVISORY)) > 16 << 20:
        spark.conf.set(ADVISORY, "16m")  # smaller ones stay: skewed partitions are cut to this size
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    A local-mode session without that setting, where driver and executors are one process, is given a folder of its
    own; on a cluster such a folder would be invisible to the other executors, so that is refused.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    own = tempfile.mkdtemp(prefix="claimlens-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/claimlens/{purpose}-{uuid.uuid4().hex}"
