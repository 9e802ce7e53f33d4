"""Small dimensions: ecoregions, admin units, humid tropics. Their files are parameters."""

from __future__ import annotations

import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HITS_THRESHOLD = 0.005


def read_ecoregions(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated concordance with header: ``ecoid, ecoregion, country1, country2, regionid, region, pixels, hits`` and
    ``hit_share``."""
    schema = "ecoid int, ecoregion string, country1 string, country2 string, regionid int, region string, pixels long, hits long"
    rows = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").csv(path)
    return rows.withColumns({"region": F.regexp_replace("region", '"', ""), "hit_share": F.try_divide("hits", "pixels")})


def read_admin_units(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated units with header (iso, objectid, id_0 ..): ``objectid, iso, ids``, and the sentinel -9999."""
    lines = spark.read.text(path)
    f = F.split("value", ",")
    rows = lines.select(f[1].try_cast("int").alias("objectid"), f[0].alias("iso"), F.transform(F.slice(f, 3, F.greatest(F.size(f) - 2, F.lit(0))), lambda x: x.try_cast("int")).alias("ids"))
    sentinel = spark.createDataFrame([(-9999, "UNK", [-9999] * 6)], "objectid int, iso string, ids array<int>")
    return rows.where(F.col("objectid").isNotNull()).unionByName(sentinel)


def read_admin_map(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``ISO,id``; further fields are ignored."""
    f = F.split("value", ",")
    return spark.read.text(path).select(f[1].try_cast("int").alias("objectid"), f[0].alias("iso")).where(F.col("objectid").isNotNull())


def unzip(path: str, target: str) -> list[str]:
    """Unpacks an archive on the driver; the members' paths."""
    with zipfile.ZipFile(path) as z:
        z.extractall(target)
        return [f"{target}/{n}" for n in z.namelist()]


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One ecoregion id a line."""
    return spark.read.text(path).select(F.trim("value").try_cast("int").alias("ecoid")).where(F.col("ecoid").isNotNull())


def in_region(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids.select("ecoid").distinct(), "ecoid", "left_semi")
