"""Tables in the folder that the cluster's driver and executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir; in a temporary folder only for a local session that names none."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        root = _own.setdefault(app, "") or "file://" + tempfile.mkdtemp(prefix="tapewright-")
        _own[app] = root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """df written once and read back, for plans that read it several times."""
    path = shared(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
