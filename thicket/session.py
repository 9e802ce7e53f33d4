"""What a session needs: workers that find this package, small Arrow batches, and the folder that all machines share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1024  # whole texts and series are long rows: Spark's 10 000 of them make large batches


def share_package(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it, whatever their working folder, and
    keeps Arrow batches small where the session does not say how large they are."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    if not spark.sparkContext.getConf().contains(BATCH) and spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, str(BATCH_ROWS))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where that setting is absent and all runs on one machine (tests), a temporary folder takes its place.
    """
    share_package(spark)
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.thicket.shared.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="thicket-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.thicket.shared.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and reads it back: lineage ends here and a lost
    executor costs a re-read only."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
