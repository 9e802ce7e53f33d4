"""Shared helpers: the cluster's shared folder, materialised tables, column-name hygiene."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from thicket.session import fresh_path, materialize, shared_dir

__all__ = ["fresh_path", "free_name", "materialize", "shared_dir", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores until no column of ``df`` has that name (case is ignored, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
