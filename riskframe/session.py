"""SparkSession helpers.

The library never creates a cluster-specific configuration: on a cluster
the caller's session is used as is.  ``local_session`` is for tests and
the bench only.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: settings every session should carry (all public Spark options)
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app_name: str = "riskframe") -> SparkSession:
    """A local session for tests / bench (UI off, UTC, AQE on)."""
    builder = (SparkSession.builder.master(f"local[{cores}]")
               .appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    active = SparkSession.getActiveSession()
    if active is None or not active.conf.get("spark.checkpoint.dir", None):
        # unset only in tests / local runs: a fresh scratch folder per run
        builder = builder.config("spark.checkpoint.dir",
                                 tempfile.mkdtemp(prefix="riskframe-ckpt-"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; only when it is unset (tests,
    local runs) a fresh local folder is created and registered.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("name a folder that driver and executors share in spark.checkpoint.dir")
    if not path:
        # unset in tests and local runs: a fresh local folder
        path = tempfile.mkdtemp(prefix="riskframe-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def written(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read again: the
    lineage is cut, and plans go on with the size of the files."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
