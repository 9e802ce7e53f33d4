"""Fire detections from text files. Numbers are read in 32 bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo as G
from ..functions import periods as P
from ..operators.pixels import screen_tiles
from ..operators.series import fire_counts
from . import trap


def _parsed(df: DataFrame, lat: Column, lon: Column, kelvin: Column, conf: Column, date: Column) -> DataFrame:
    num = lambda c: c.try_cast("float")
    out = df.select(date.alias("date"), num(lat).alias("lat"), num(lon).alias("lon"), num(kelvin).alias("kelvin"), num(conf).alias("conf"))
    return out.where(F.col("date").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("kelvin").isNotNull() & F.col("conf").isNotNull())


def daily_date(text: Column) -> Column:
    """MM/DD/YYYY as YYYY-MM-DD, without a look at the calendar."""
    p = F.split(text, "/")
    return F.when(F.size(p) == 3, F.concat_ws("-", F.get(p, F.lit(2)), F.get(p, F.lit(0)), F.get(p, F.lit(1))))


def monthly_date(text: Column) -> Column:
    return P.convert(text, "yyyyMMdd", "yyyy-MM-dd")


def parse_monthly(lines: DataFrame) -> DataFrame:
    """Blank-separated monthly files; the header goes."""
    f = F.split(F.trim("value"), r"\s+")
    rows = lines.where((F.size(f) >= 10) & (F.get(f, F.lit(0)) != "YYYYMMDD"))
    return _parsed(rows, F.get(f, F.lit(3)), F.get(f, F.lit(4)), F.get(f, F.lit(5)), F.get(f, F.lit(9)), monthly_date(F.get(f, F.lit(0))))


def parse_daily(lines: DataFrame) -> DataFrame:
    """Twelve comma fields, dates MM/DD/YYYY."""
    f = F.split("value", ",")
    return _parsed(lines.where(F.size(f) == 12), F.get(f, F.lit(0)), F.get(f, F.lit(1)), F.get(f, F.lit(2)), F.get(f, F.lit(8)), daily_date(F.get(f, F.lit(5))))


def is_valid_line(line: Column, fields: int = 12) -> Column:
    """As many fields, the first a number, none with more than one point: headers and broken lines fail."""
    f = F.split(line, ",")
    return (F.size(f) == fields) & F.forall(f, lambda x: F.size(F.split(x, r"\.")) <= 2) & F.get(f, F.lit(0)).try_cast("double").isNotNull()


def parse_new(lines: DataFrame) -> DataFrame:
    """The newer daily format: dates YYYY-MM-DD, invalid lines left out."""
    f = F.split("value", ",")
    return _parsed(lines.where(is_valid_line(F.col("value"))), F.get(f, F.lit(0)), F.get(f, F.lit(1)), F.get(f, F.lit(2)), F.get(f, F.lit(8)), F.get(f, F.lit(5)))


def parse_trapped(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``parse_new``, and the lines that it leaves out, whatever is wrong with them, from one pass over the text."""
    f = F.split("value", ",")
    fields = {"lat": 0, "lon": 1, "kelvin": 2, "conf": 8}
    rows = lines.select("value", F.get(f, F.lit(5)).alias("date"), *[F.get(f, F.lit(k)).try_cast("float").alias(c) for c, k in fields.items()])
    whole = is_valid_line(F.col("value")) & F.col("date").isNotNull()
    for c in fields:
        whole &= F.col(c).isNotNull()
    good, bad = trap.split(rows, whole, "fires")
    return good.drop("value"), bad.select("value")


def rejected(lines: DataFrame) -> DataFrame:
    """The lines that are no detections by their form."""
    return lines.where(~is_valid_line(F.col("value")))


def located(fires: DataFrame, s_res: str, tiles: set[tuple[int, int]] | None = None) -> DataFrame:
    """Fires with their pixel; those outside ``tiles`` go."""
    at = fires.withColumn("at", G.latlon_to_pixel(s_res, F.col("lat").cast("double"), F.col("lon").cast("double")))
    out = at.select(F.lit(s_res).alias("s_res"), "at.*", "date", "lat", "lon", "kelvin", "conf")
    return out if tiles is None else screen_tiles(out, tiles)


def daily_counts(fires: DataFrame) -> DataFrame:
    """Fire counts by position and date."""
    return fire_counts(fires, ["date", "lat", "lon"]).select(F.lit("fire").alias("dataset"), F.lit("01").alias("t_res"), "*")
