"""What is made of probability series: map tiles, country counts, downloads, API tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import geo as G
from ..functions import periods as P
from ..schema import KEYS, NODATA

EPOCH = "2000-01-01"


def discounted(series: str, ecoid: str | None, discounts: dict[int, float] | None) -> Column:
    """The series times its ecoregion's discount (1 if it has none)."""
    if not discounts or ecoid is None:
        return F.col(series)
    factor = F.create_map(*[F.lit(x) for kv in discounts.items() for x in (int(kv[0]), float(kv[1]))])
    return A.scale(series, F.coalesce(F.try_element_at(factor, F.col(ecoid).cast("int")), F.lit(1.0)))


def with_iso(df: DataFrame, gadm: DataFrame, unit: str = "gadm2") -> DataFrame:
    """Adds ``iso`` from the admin dimension (objectid, iso). Rows of unknown units go, as in every export.

    The dimension is left to the planner: it is broadcast while it is below the session's limit.
    """
    return df.join(gadm.select(F.col("objectid").alias("objectid__"), "iso"), F.col(unit) == F.col("objectid__")).drop("objectid__")


def first_hits(df: DataFrame, threshold: int, series: str = "prob", ecoid: str | None = None, discounts: dict[int, float] | None = None, nodata: float = NODATA) -> DataFrame:
    """Adds ``clean`` and ``period``, that of the first clean value at the threshold; pixels never there go."""
    clean = df.withColumn("clean", A.clean_probabilities(discounted(series, ecoid, discounts), nodata))
    hit = clean.withColumn("hit__", A.first_hit("clean", threshold)).where(F.col("hit__").isNotNull())
    return hit.withColumn("period", F.col("start_idx") + F.col("hit__")).drop("hit__")


def latlon(df: DataFrame, s_res: str) -> DataFrame:
    at = G.pixel_to_latlon(s_res, "h", "v", "sample", "line")
    return df.withColumn("at__", at).withColumns({"lat": F.col("at__.lat"), "lon": F.col("at__.lon")}).drop("at__")


def map_tiles(df: DataFrame, gadm: DataFrame, s_res: str, zoom: int, t_res: str, t_res_out: str, threshold: int, discounts: dict[int, float] | None = None, nodata: float = NODATA) -> DataFrame:
    """``x, y, z, period``: the earliest hit in each map tile, in periods since 2000. Pixels of a tile count once."""
    epoch = P.period_of(EPOCH, t_res_out)
    hits = with_iso(first_hits(df, threshold, ecoid="ecoid" if "ecoid" in df.columns else None, discounts=discounts, nodata=nodata), gadm)
    placed = latlon(hits, s_res).where(G.is_mappable("lat", "lon")).withColumn("tile", G.latlon_to_tile("lat", "lon", zoom))
    moved = placed.withColumn("p", P.shift_resolution("period", t_res, t_res_out) - epoch)
    return moved.groupBy("tile.x", "tile.y", "tile.z").agg(F.min("p").alias("period"))


def all_zooms(tiles: DataFrame, min_zoom: int) -> DataFrame:
    """``x, y, z, period, count``: tiles counted in themselves and each of their parents.

    Counting before exploding keeps the exploded rows to one a tile and period."""
    once = tiles.groupBy("x", "y", "z", "period").agg(F.count(F.lit(1)).alias("n"))
    parents = once.select("period", "n", F.explode(G.parent_tiles("x", "y", "z", min_zoom)).alias("t"))
    return parents.groupBy("t.x", "t.y", "t.z", "period").agg(F.sum("n").alias("count"))


def period_arrays(tiles: DataFrame) -> DataFrame:
    """One row a tile with its periods, ascending, and their counts as PostgreSQL arrays."""
    sorted_ = F.array_sort(F.collect_list(F.struct("period", "count")))
    out = tiles.groupBy("x", "y", "z").agg(sorted_.alias("pc"))
    return out.select("x", "y", "z", A.pg_array(F.col("pc.period")).alias("periods"), A.pg_array(F.col("pc.count")).alias("counts"))


def website(df: DataFrame, gadm: DataFrame, s_res: str, zoom: int, min_zoom: int, t_res: str, t_res_out: str, threshold: int, discounts: dict[int, float] | None = None) -> DataFrame:
    return period_arrays(all_zooms(map_tiles(df, gadm, s_res, zoom, t_res, t_res_out, threshold, discounts), min_zoom))


def country_stats(df: DataFrame, gadm: DataFrame, threshold: int, t_res: str, t_res_out: str, nodata: float = NODATA) -> DataFrame:
    """``iso, cdm_period, date, count`` of first hits."""
    epoch = P.period_of(EPOCH, t_res_out)
    hits = with_iso(first_hits(df, threshold, nodata=nodata), gadm).withColumn("p", P.shift_resolution("period", t_res, t_res_out))
    counted = hits.groupBy("iso", "p").agg(F.count(F.lit(1)).alias("count"))
    return counted.select("iso", (F.col("p") - epoch).alias("cdm_period"), P.period_start("p", t_res_out).cast("string").alias("date"), "count")


def spark_hits(df: DataFrame, gadm: DataFrame, threshold: int, t_res: str, t_res_out: str, keys: list[str] = KEYS) -> DataFrame:
    """The earliest hit of each pixel with its country, in periods since 2000."""
    epoch = P.period_of(EPOCH, t_res_out)
    hits = with_iso(first_hits(df, threshold), gadm)
    return hits.groupBy("iso", *keys).agg(F.min(P.shift_resolution("period", t_res, t_res_out) - epoch).alias("period"))


def spark_graph(hits: DataFrame) -> DataFrame:
    return hits.groupBy("iso", "period").agg(F.count(F.lit(1)).alias("count"))


def located_series(df: DataFrame, static: DataFrame, gadm: DataFrame, s_res: str, discounts: dict[int, float] | None = None, keys: list[str] = KEYS, nodata: float = NODATA) -> DataFrame:
    """Clean series with cover, admin unit, ecoregion, label and position."""
    rows = df.join(static.select(*keys, "vcf", "hansen"), keys)
    clean = rows.withColumn("clean", A.clean_probabilities(discounted("prob", "ecoid", discounts), nodata))
    return latlon(with_iso(clean, gadm), s_res).select(*keys, "lat", "lon", "iso", "vcf", "gadm2", "ecoid", "hansen", "clean")


def download(df: DataFrame, gadm: DataFrame, s_res: str, threshold: int, t_res: str, discounts: dict[int, float] | None = None, nodata: float = NODATA) -> DataFrame:
    """Distinct rows of position (8 decimals), country, unit and date of the first hit."""
    hits = with_iso(first_hits(df, threshold, ecoid="ecoid", discounts=discounts, nodata=nodata), gadm)
    text = lambda c: F.format_string("%.8f", F.col(c))
    return latlon(hits, s_res).select(text("lat").alias("lat"), text("lon").alias("lon"), "iso", "gadm2", P.period_start("period", t_res).cast("string").alias("date")).distinct()


def labelled_series(df: DataFrame, static: DataFrame, s_res: str, keys: list[str] = KEYS, nodata: float = NODATA) -> DataFrame:
    rows = df.join(static.select(*keys, "hansen"), keys)
    return latlon(rows, s_res).select("lat", "lon", A.clean_probabilities("prob", nodata).alias("clean"), "gadm2", "ecoid", "hansen")


def _api(df: DataFrame, gadm: DataFrame, s_res: str, nodata: float) -> DataFrame:
    return latlon(with_iso(df, gadm), s_res).select("lat", "lon", "iso", F.col("iso").alias("iso_extra"), "gadm2", "start_idx", A.clean_probabilities("prob", nodata).alias("clean"))


def api_long(df: DataFrame, gadm: DataFrame, s_res: str, t_res: str, threshold: int = 0, nodata: float = NODATA) -> DataFrame:
    """A row for each period of the pixels that reach the threshold. Clean series rise, so their last value tells."""
    rows = _api(df, gadm, s_res, nodata).where(F.element_at("clean", -1) >= threshold)
    out = rows.select("lat", "lon", "iso", "iso_extra", "gadm2", "start_idx", F.posexplode("clean").alias("at", "prob"))
    date = P.period_start(F.col("start_idx") + F.col("at"), t_res)
    return out.select("lat", "lon", "iso", "iso_extra", "gadm2", date.cast("string").alias("date"), F.date_format(date, "yyyy").alias("year"), "prob")


def _api_hit(rows: DataFrame, t_res: str) -> DataFrame:
    date = P.period_start(F.col("start_idx") + F.col("hit"), t_res).cast("string")
    return rows.select("lat", "lon", "iso", "iso_extra", "gadm2", date.alias("date"), F.element_at("clean", F.col("hit") + 1).alias("prob"))


def api_first(df: DataFrame, gadm: DataFrame, s_res: str, t_res: str, threshold: int = 0, nodata: float = NODATA) -> DataFrame:
    """A row for each pixel at its first hit."""
    rows = _api(df, gadm, s_res, nodata).withColumn("hit", A.first_hit("clean", threshold)).where(F.col("hit").isNotNull())
    return _api_hit(rows, t_res)


def api_latest(df: DataFrame, gadm: DataFrame, s_res: str, t_res: str, threshold: int = 0, nodata: float = NODATA) -> DataFrame:
    """As ``api_first``, of pixels whose first hit is the latest period."""
    rows = _api(df, gadm, s_res, nodata).withColumn("hit", A.first_hit("clean", threshold)).where(F.col("hit") == F.size("clean") - 1)
    return _api_hit(rows, t_res)


def hansen_tiles(lines: DataFrame, zoom: int = 16, meters: bool = False, date: str = "2010-12-01") -> DataFrame:
    """Text lines of ``lon,lat,...`` (or mercator metres) as map tiles at one fixed period."""
    parts = F.split("value", ",")
    a, b = F.try_element_at(parts, F.lit(1)).try_cast("double"), F.try_element_at(parts, F.lit(2)).try_cast("double")
    rows = lines.select(a.alias("a"), b.alias("b"))
    period = P.period_of(date, "32") - P.period_of(EPOCH, "32")
    if meters:
        rows = rows.where("a is not null and b is not null").withColumn("t", G.meters_to_tile("a", "b", zoom))
    else:
        rows = rows.where(G.is_mappable("b", "a")).withColumn("t", G.latlon_to_tile("b", "a", zoom))
    return rows.select("t.x", "t.y", "t.z", F.lit(period).alias("period"))
