"""Virtual pixels over the driver's tables, so that every operator has data with an exact counterpart in SQL.

A supplier is a pixel of tile (28, 8) at 500 m; its shipments are its observations, by 16-day period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import periods as P
from ..operators.series import to_series
from ..schema import KEYS

H, V, RES = 28, 8, "500"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(df: DataFrame, key: str) -> DataFrame:
    k = F.col(key)
    return df.withColumns({"s_res": F.lit(RES), "h": F.lit(H), "v": F.lit(V), "sample": (k % 10).cast("int"), "line": F.floor(k / 10).cast("int")})


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k, period, qty, rain, prob``: sums of whole quantities, so that any order of summing agrees."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), P.period("l_shipdate", "16").alias("period"), "l_quantity", "l_discount")
    out = rows.groupBy("k", "period").agg(F.sum("l_quantity").cast("int").alias("qty"), F.round(F.max("l_discount") * 100).cast("int").alias("rain"))
    return out.withColumn("prob", F.col("qty") * 37 % 101 / 100.0)


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixel keys, ``start_idx``, ``prob`` with holes, and ``gadm2``, ``ecoid`` of the supplier."""
    series = to_series(observations(spark, sf_dir), ["k"], "period", ["prob"], -9999.0)
    dims = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("gadm2"), F.col("s_nationkey").alias("ecoid"))
    return keyed(series.join(dims, "k"), "k").select(*KEYS, "start_idx", "prob", "gadm2", "ecoid")


def ndvi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixel keys, ``start_idx``, ``ndvi`` and ``precl`` with holes."""
    rows = observations(spark, sf_dir).select("k", "period", F.col("qty").cast("double").alias("ndvi"), F.col("rain").cast("double").alias("precl"))
    return keyed(to_series(rows, ["k"], "period", ["ndvi", "precl"], -9999.0), "k").select(*KEYS, "start_idx", "ndvi", "precl")


def static(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    s = keyed(table(spark, sf_dir, "supplier"), "s_suppkey")
    return s.select(*KEYS, (k * 37 % 100).cast("int").alias("vcf"), F.col("s_nationkey").alias("gadm"), F.col("s_nationkey").alias("ecoid"), (F.col("s_acctbal") > 5000).cast("int").alias("hansen"), (k % 20).cast("int").alias("coast_dist"))


def layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return static(spark, sf_dir).select(*KEYS, F.col(name).alias("val"))


def admin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admin units but those of the last region, whose rows exports drop."""
    n = table(spark, sf_dir, "nation").where(F.col("n_regionkey") < 4)
    return n.select(F.col("n_nationkey").alias("objectid"), F.col("n_name").alias("iso"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("ecoid"), (F.col("n_regionkey") + 1000).alias("regionid"), (F.col("n_nationkey") % 10 / 1000.0).alias("hit_share"))


def fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("value").isNotNull())
    k = F.col("user_id") % 1000
    return e.select(k.alias("k"), F.col("ts").cast("date").alias("date"), (F.col("value") + 300).alias("kelvin"), (F.col("value") % 100).alias("conf"))


# --- the same in SQL ---


def p16(d: str) -> str:
    return f"((year({d}) - 1970) * 23 + (dayofyear({d}) - 1) // 16)"


def p32(d: str) -> str:
    return f"((year({d}) - 1970) * 12 + month({d}) - 1)"


def start16(p: str) -> str:
    return f"CAST(make_date(CAST(1970 + ({p}) // 23 AS BIGINT), 1, 1) + CAST((({p}) % 23) * 16 AS INTEGER) AS DATE)"


OBS = f"""obs AS (
  SELECT l_suppkey AS k, {p16('l_shipdate')} AS period, CAST(sum(l_quantity) AS INTEGER) AS qty, CAST(round(max(l_discount) * 100) AS INTEGER) AS rain
  FROM lineitem GROUP BY 1, 2),
obs2 AS (SELECT *, (qty * 37 % 101) / 100.0::DOUBLE AS prob FROM obs)"""

DENSE = f"""{OBS},
span AS (SELECT k, min(period) AS lo, max(period) AS hi FROM obs GROUP BY k),
grid AS (SELECT k, lo, unnest(range(lo, hi + 1)) AS period FROM span),
dense AS (SELECT g.k, g.lo, g.period, o.qty, o.rain, o.prob FROM grid g LEFT JOIN obs2 o ON o.k = g.k AND o.period = g.period)"""

CLEAN = f"""{DENSE},
filled AS (SELECT k, lo, period, coalesce(last_value(prob IGNORE NULLS) OVER (PARTITION BY k ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0::DOUBLE) AS p FROM dense),
lagged AS (SELECT *, lag(p, 1) OVER w AS p1, lag(p, 2) OVER w AS p2 FROM filled WINDOW w AS (PARTITION BY k ORDER BY period)),
smooth AS (SELECT k, lo, period, CAST(CAST((coalesce(p2, 0.0::DOUBLE) + coalesce(p1, 0.0::DOUBLE) + p) / least(3, period - lo + 1) AS FLOAT) AS DOUBLE) AS s FROM lagged),
clean AS (SELECT k, lo, period, CAST(floor(max(s) OVER (PARTITION BY k ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100 + 0.5) AS INTEGER) AS c FROM smooth)"""

HITS = """hit AS (SELECT k, min(period) AS period FROM clean WHERE c >= 50 GROUP BY k),
adm AS (SELECT n_nationkey AS objectid, n_name AS iso FROM nation WHERE n_regionkey < 4),
hits AS (SELECT h.k, h.period, s.s_nationkey AS gadm2, a.iso FROM hit h JOIN supplier s ON s.s_suppkey = h.k JOIN adm a ON a.objectid = s.s_nationkey)"""

RHO = 6371007.181


def latlon(k: str = "k") -> tuple[str, str]:
    """Latitude and longitude of a supplier's pixel."""
    edge = f"(pi() * {RHO} / 18 / 2400)"
    lat = f"((pi() / 2 * {RHO} - (({V} * 2400 + {k} // 10) * {edge} + {edge} / 2)) / {RHO})"
    lon = f"((-pi() * {RHO} + (({H} * 2400 + {k} % 10) * {edge} + {edge} / 2)) / ({RHO} * cos({lat})))"
    return f"degrees({lat})", f"degrees({lon})"


def tile(lat: str, lon: str, zoom: int) -> tuple[str, str]:
    size = f"(2 * pi() * 6378137 / 256 / {2**zoom})"
    shift = "(pi() * 6378137)"
    x = f"CAST(ceil((({lon}) * {shift} / 180 + {shift}) / {size} / 256) - 1 AS BIGINT)"
    y = f"CAST({2**zoom - 1} - (ceil((ln(tan((({lat}) + 90) * pi() / 360)) / (pi() / 180) * ({shift} / 180) + {shift}) / {size} / 256) - 1) AS BIGINT)"
    return x, y
