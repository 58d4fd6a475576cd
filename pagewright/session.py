"""Sessions: the settings the engine expects, and its code on every executor."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application, so that its Python functions can be loaded
    there wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parent
        handle, name = tempfile.mkstemp(prefix="pagewright-", suffix=".zip")
        os.close(handle)
        with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as packed:
            for path in sorted(root.rglob("*.py")):
                packed.write(path, path.relative_to(root.parent))
        spark.sparkContext.addPyFile(name)
        _SHIPPED.add(app)
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to the shared checkpoint folder that the session names in spark.checkpoint.dir, and read from there:
    it cuts a long lineage. Where none is named, a temporary folder is set on a single machine only; on a cluster that is
    an error."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="pagewright-"))
    return df.checkpoint(eager=True)
