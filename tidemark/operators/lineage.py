"""Reliable checkpoints in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is set, a local session gets one of its own; a cluster must name it."""
    sc = spark.sparkContext
    own = sc.getConf().get("spark.checkpoint.dir")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not own and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; it must name a folder that all executors share")
        sc.setCheckpointDir(own or tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
    return own or sc._jsc.sc().getCheckpointDir().get()


#: Bits of an estimated size beyond which it is no estimate any more.
_ESTIMATE_BITS = 100


def cut(df: DataFrame) -> DataFrame:
    """Computes df once and cuts its lineage.

    A checkpoint keeps the size that the planner estimated, which a join multiplies: after some rounds of a loop the number
    alone takes longer than the work. There df is written as a table, whose size is read off its files.
    """
    folder = shared_folder(df.sparkSession)
    if df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() <= _ESTIMATE_BITS:
        return df.checkpoint(eager=True)
    path = f"{folder.rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
