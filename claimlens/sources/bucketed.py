"""Tables bucketed by their join key: joins and groupings on it need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` in ``buckets`` buckets, files sorted by ``key``, and return it as the table it now is.

    Tables that meet on the key want the same number of buckets. A large bucket is written by several tasks, each a range of its keys,
    so that none has to sort a whole one; one key with a great part of the rows still makes a large file.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    bucket = F.pmod(F.hash(key), F.lit(buckets))  # Spark's own rule for buckets
    dealt = df.withColumn("_bucket", bucket).repartitionByRange("_bucket", key).drop("_bucket")
    dealt.write.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """A table that another session wrote with ``write_bucketed``."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)
