"""Session settings the operators count on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings; each may also be given at cluster level.
SETTINGS = {
    # Times in the catalog are UTC throughout.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where an aggregation on the same key follows it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A repeated key in a JSON object keeps its last value instead of failing the parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The ancestors of a large registry outgrow the default cap on recursive rows.
    "spark.sql.cteRecursionRowLimit": "-1",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, and read from there from now on."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder: on a cluster
    the executors could not see one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="shelfmark-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
