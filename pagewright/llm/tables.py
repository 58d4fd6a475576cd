"""Reading of the driver's tables and the checkpoint that cuts long lineages."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a scale directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to the shared checkpoint folder that the session names in spark.checkpoint.dir, and read from there.

    Where none is named, a temporary folder is set on a single machine only; on a cluster that is an error."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="pagewright-"))
    return df.checkpoint(eager=True)
