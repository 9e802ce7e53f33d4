"""A trap for bad records: one pass over the input, whose good rows and rejects are written apart and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path


def split(df: DataFrame, good: Column, name: str = "trap") -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` that pass ``good``, and the others (null counts as bad), with all columns.

    The input is read and parsed once: rows are written to folders of their own in the shared folder, and each result
    reads only its folder. A lost executor costs a re-read. An empty table gives two.
    """
    spark, mark = df.sparkSession, "good"
    while mark in df.columns:
        mark += "_"
    path = fresh_path(spark, name)
    df.withColumn(mark, F.coalesce(good, F.lit(False)).cast("int")).write.partitionBy(mark).parquet(path)
    both = spark.read.schema(f"{df._jdf.schema().toDDL()}{', ' if df.columns else ''}`{mark}` int").parquet(path)
    return both.where(F.col(mark) == 1).drop(mark), both.where(F.col(mark) == 0).drop(mark)
