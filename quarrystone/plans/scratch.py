"""Tables written once in the cluster's checkpoint folder.

Some shapes need an intermediate result that stays the same however often it is
read, even when an executor is lost in between.  It is written as Parquet under
``spark.checkpoint.dir`` and read back, which also cuts its lineage.  All tables of a session
lie in one folder, which ``clear`` removes once their results are no longer needed.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A new path below the session's checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="quarrystone-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/quarrystone/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete what this session has written; results that still read from it become unusable."""
    own = scratch_folder(spark).rsplit("/", 1)[0]
    where = spark._jvm.org.apache.hadoop.fs.Path(own)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame) -> DataFrame:
    """The table, written once and read back."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
