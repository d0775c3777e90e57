"""Intermediate tables that survive the loss of an executor."""

import uuid

from pyspark.sql import DataFrame

from ..session import scratch_dir


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage, keeps column pruning and filter pushdown for whoever reads it next, and
    gives the planner the true size of the table instead of an estimate.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
