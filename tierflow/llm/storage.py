"""What steps of an operator hand on: tables in the shared folder that cut lineage, and broadcast objects."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from tierflow.session import shared_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df under spark.checkpoint.dir and read it back: lost executors then redo at most one step."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shipped(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast value with its class, so that a task needs no installed copy of this package; the result reads it in a task."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)
