"""Written tables that cut lineage.

The cluster names its shared folder in ``spark.checkpoint.dir``; where that is unset, the
warehouse, which is shared too, takes its place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir")
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/reptally/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "part", path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Lost executors cannot force a recomputation past this point, and later joins are
    planned on the true size of the files.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
