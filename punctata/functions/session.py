"""Where plans that must be cut are kept."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where none is set: a temporary folder if driver and executors are one process, else one in the warehouse.
    """
    held = spark.sparkContext.getCheckpointDir()
    if not held:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and re.match(r"local(\[|$)", spark.sparkContext.master):
            folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
        spark.sparkContext.setCheckpointDir(folder)
        held = spark.sparkContext.getCheckpointDir()
    return held


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Unlike a checkpoint, the rows are made once, the optimizer sees their true size, and no constraints of the plan before
    stay: in iterations those can double with every round.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(rows: DataFrame, *keys: Column | str, each: int = 200_000) -> DataFrame:
    """``rows`` by ``keys`` to so many tasks that each has about ``each``: what a task holds does not grow with the table.

    Rows are counted first, so they should come from files or be cheap to make.
    """
    return rows.repartition(max(1, math.ceil(rows.count() / each)), *keys)
