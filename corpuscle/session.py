"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "corpuscle", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the plans rely on; on a cluster the submitter's master wins."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | extra
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def settle(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder and cut its lineage.

    The folder is the one named by ``spark.checkpoint.dir``; only a local session (tests, a laptop) that names none
    gets a temporary one, on a cluster that is an error. What no frame uses any longer is deleted by Spark where the session cleans checkpoints. checkpoint() replicates nothing to executors, so a lost executor loses nothing.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise ValueError("a cluster needs spark.checkpoint.dir, a folder that all executors share")
        sc.setCheckpointDir(folder or os.path.join(tempfile.gettempdir(), "corpuscle-checkpoints"))
    return df.checkpoint(eager=True)
