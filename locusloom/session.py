"""Session helpers: configuration, shared scratch space, lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root = os.path.join(tempfile.gettempdir(), f"locusloom-{uuid.uuid4().hex}")


def build_session(app_name: str = "locusloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; ``conf`` entries use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A path that does not exist yet, under the shared folder named by ``spark.checkpoint.dir``.

    Where that setting is absent, a cluster uses the home folder on its default file system, which must not be
    that of single machines; a session in one process (tests, a laptop) uses its temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = _local_root if re.match(r"local(\[|$)", spark.sparkContext.master) else _cluster_home(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


def _cluster_home(spark: SparkSession) -> str:
    hadoop = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark.sparkContext._jsc.hadoopConfiguration())
    if hadoop.getScheme() == "file":
        raise ValueError("executors don't share the default file system: set spark.checkpoint.dir to a folder that they share")
    return f"{hadoop.getHomeDirectory().toString()}/.locusloom"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared scratch folder and return a reader over it.

    This cuts lineage on storage that outlives executors, stops a costly subplan from running once
    per consumer, and gives Catalyst the true size when it picks a join strategy.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
