"""The append-only store: Parquet partitioned by dataset, resolution and version; versions are told apart by pedigree.

A version is written first, as folders of its own, and becomes part of the store by a manifest: one small file, which
appears whole or not at all. So whatever datasets it has are seen together; what a crash leaves behind has no manifest and
is not read; and a version that is sent again under its name is not added twice.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files

PLACE = ("dataset", "res", "version")  # a version's folder begins with v-, or Spark might take its name for a number


def parse_pedigree(given) -> int:
    """Seconds since the epoch; nothing given means now."""
    return int(time.time()) if given in (None, "") else int(given)


def manifests(spark: SparkSession, root: str) -> dict[str, dict]:
    """What is known of each version of a store."""
    folder = f"{root}/_versions"
    return {n.removesuffix(".json"): json.loads(files.read(spark, f"{folder}/{n}")) for n in files.names(spark, folder) if n.endswith(".json")}


def commit(df: DataFrame, root: str, pedigree=None, version: str | None = None, **about) -> bool:
    """Adds rows that name their ``dataset`` and ``res`` as one version; False if the store has that version.

    ``about`` goes to the manifest. An unfinished attempt under the same name is overwritten.
    """
    spark, version = df.sparkSession, version or uuid.uuid4().hex
    manifest = f"{root}/_versions/{version}.json"
    if files.exists(spark, manifest):
        return False
    out = df if "pedigree" in df.columns else df.withColumn("pedigree", F.lit(parse_pedigree(pedigree)).cast("long"))
    names = [c for c in out.columns if c not in PLACE]
    rows = out.select(*names, "dataset", "res", F.lit(f"v-{version}").alias("version"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PLACE).parquet(root)
    return files.write(spark, manifest, json.dumps({"written": int(time.time()), **about}))


def append(df: DataFrame, root: str, dataset: str, s_res: str, t_res: str, pedigree=None, version: str | None = None, **about) -> bool:
    """Adds a version of one dataset."""
    return commit(df.withColumns({"dataset": F.lit(dataset), "res": F.lit(f"{s_res}-{t_res}")}), root, pedigree, version, **about)


def append_all(df: DataFrame, root: str, pedigree=None, version: str | None = None, **about) -> bool:
    """As ``append``, for rows that name their ``dataset``, ``s_res`` and ``t_res``: all datasets in one write and version."""
    return commit(df.withColumn("res", F.concat_ws("-", "s_res", "t_res")), root, pedigree, version, **about)


def read_all(spark: SparkSession, root: str) -> DataFrame:
    """All rows of all versions that have a manifest, with ``dataset, res``."""
    known = [f"v-{v}" for v in sorted(manifests(spark, root))]
    return spark.read.parquet(root).where(F.col("version").isin(known)).drop("version")


def read(spark: SparkSession, root: str, dataset: str, s_res: str, t_res: str) -> DataFrame:
    """A dataset's versions. Partition filters keep other folders, and those without a manifest, from being listed or read."""
    return read_all(spark, root).where((F.col("dataset") == dataset) & (F.col("res") == f"{s_res}-{t_res}")).drop("dataset", "res")


def absorb(spark: SparkSession, source: str, target: str, version: str | None = None) -> bool:
    """Adds all rows of another store, as one version."""
    return commit(read_all(spark, source), target, version=version)


def consolidate(spark: SparkSession, root: str, target: str, files: int = 1) -> bool:
    """A copy of a store as one version, with at most ``files`` files in each partition, each written by a task of its own.

    Rows are dealt by a number that goes round in each task, so parts are about equal, however large a partition is.
    """
    rows = read_all(spark, root)
    name = "part"
    while name in rows.columns:
        name += "_"
    part = (F.monotonically_increasing_id() % files).cast("int")
    tasks = max(4 * files, int(spark.conf.get("spark.sql.shuffle.partitions")))  # said outright, so that small ones are not joined again
    spread = rows.withColumn(name, part).repartition(tasks, "dataset", "res", name).sortWithinPartitions("dataset", "res")
    return commit(spread.drop(name), target)


def write_text(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Tab-separated text, arrays as JSON; ``partition_by`` makes folders of their values."""
    plain = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes])
    writer = plain.write.mode("overwrite").option("sep", "\t").option("quote", "").option("emptyValue", "")
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)
