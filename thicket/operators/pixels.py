"""Relational queries over pixels: static joins, filters, semi-joins, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import periods as P
from ..schema import KEYS, NEIGHBOR_STATS, NODATA, PIXEL_STATS, RAW_FILL, RunParams, has_nodata


def consolidate_static(vcf_limit: int, vcf: DataFrame, hansen: DataFrame, ecoid: DataFrame, gadm: DataFrame, border: DataFrame, ecoregions: DataFrame | None = None, keys: list[str] = KEYS) -> DataFrame:
    """Five layers (keys, val) inner-joined on the pixel: ``vcf, gadm, ecoid, hansen, coast_dist``.

    The cover limit is applied to its layer before the joins; ``ecoregions`` (ecoid), if given, keeps members only.
    """
    out = vcf.select(*keys, F.col("val").alias("vcf")).where(F.col("vcf") >= vcf_limit)
    eco = ecoid.select(*keys, F.col("val").alias("ecoid"))
    if ecoregions is not None:
        eco = eco.join(ecoregions.select("ecoid").distinct(), "ecoid", "left_semi")
    for name, layer in (("gadm", gadm), ("ecoid", None), ("hansen", hansen), ("coast_dist", border)):
        out = out.join(eco if layer is None else layer.select(*keys, F.col("val").alias(name)), keys)
    return out.select(*keys, "vcf", "gadm", "ecoid", "hansen", "coast_dist")


def screen_tiles(df: DataFrame, tiles: set[tuple[int, int]]) -> DataFrame:
    """Rows whose (h, v) is among ``tiles``. A tile set has at most 648 members, so a list reaches the scan."""
    if not tiles:
        return df.where(F.lit(False))
    return df.where(F.col("h").isin(sorted({h for h, _ in tiles})) & (F.col("h") * 100 + F.col("v")).isin(sorted(h * 100 + v for h, v in tiles)))


def filter_covered(series: DataFrame, static: DataFrame, vcf_limit: int, keys: list[str] = KEYS) -> DataFrame:
    """Series of pixels with enough cover."""
    covered = static.where(F.col("vcf") >= vcf_limit).select(*keys)
    return series.join(covered, keys, "left_semi")


def adjust_rain(rain: DataFrame, from_res: str, to_res: str, series: str = "series") -> DataFrame:
    """Rain series (start_idx, series) at another resolution, rounded; as they are where resolutions agree."""
    if from_res == to_res:
        return rain
    s = A.stretch(F.col("start_idx"), F.col(series), from_res, to_res)
    out = rain.withColumn("stretched__", s)
    return out.withColumns({"start_idx": F.col("stretched__.start"), series: F.transform(F.col("stretched__.series"), A.round_half_up)}).drop("stretched__")


def trained_on_fill(start: Column, series: Column, est_start_idx: int) -> Column:
    """Every value up to the end of training is raster fill (true of none)."""
    return A.all_equal(F.slice(series, 1, F.greatest(F.lit(est_start_idx) - start + 1, F.lit(0))), RAW_FILL)


def dynamic_filter(ndvi: DataFrame, rain: DataFrame, params: RunParams, keys: list[str] = KEYS) -> DataFrame:
    """Vegetation (start_idx, ndvi) and rain (start_idx, precl) of a pixel, filled forward and cut to common periods.

    Pixels whose training values are all fill go. Leading nodata stays.
    """
    first = P.period_of(params.est_start, params.t_res)
    n = ndvi.select(*keys, F.col("start_idx").alias("n_start"), "ndvi").where(~trained_on_fill(F.col("n_start"), F.col("ndvi"), first))
    r = rain.select(*keys, F.col("start_idx").alias("p_start"), "precl")
    fill = lambda c: A.fill_forward(c, params.nodata, params.nodata)
    both = n.join(r, keys).withColumn("a", A.align(("p_start", fill("precl")), ("n_start", fill("ndvi"))))
    return both.select(*keys, F.col("a.start").alias("start_idx"), F.col("a.s1").alias("ndvi"), F.col("a.s0").alias("precl"))


def estimable(df: DataFrame, nodata: float = NODATA, value: str = "val", neighbor: str = "neighbor") -> DataFrame:
    """Rows without nodata in the pixel's or its neighbours' features."""
    return df.where(~has_nodata(F.col(value), PIXEL_STATS, nodata) & ~has_nodata(F.col(neighbor), NEIGHBOR_STATS, nodata))


def training_rows(neighbors: DataFrame, static: DataFrame, params: RunParams, regions: DataFrame | None = None, keys: list[str] = KEYS) -> DataFrame:
    """Rows to learn from: the last training period, away from coasts, no nodata. ``regions`` (ecoid, regionid) adds each
    row once more under its super-ecoregion."""
    first = P.period_of(params.est_start, params.t_res)
    rows = estimable(neighbors.where(F.col("period") == first), params.nodata)
    labels = static.where(F.col("coast_dist") >= params.min_coast_dist).select(*keys, "ecoid", "hansen")
    out = rows.join(labels, keys)
    if regions is None:
        return out.withColumnRenamed("ecoid", "ecoregion")
    both = out.join(regions.select("ecoid", "regionid"), "ecoid", "left")
    return both.withColumn("ecoregion", F.explode(F.array_compact(F.array("ecoid", "regionid")))).drop("ecoid", "regionid")


def final_ecoregion(df: DataFrame, regions: DataFrame, super_ecoregions: bool, threshold: float = 0.005) -> DataFrame:
    """``ecoregion``: the super-ecoregion of pixels whose ecoregion has too few hits, else the ecoregion."""
    if not super_ecoregions:
        return df.withColumn("ecoregion", F.col("ecoid"))
    known = regions.select("ecoid", "regionid", "hit_share")
    return df.join(known, "ecoid", "left").withColumn("ecoregion", F.when(F.col("hit_share") <= threshold, F.col("regionid")).otherwise(F.col("ecoid"))).drop("regionid", "hit_share")


def with_admin(probs: DataFrame, gadm2: DataFrame, static: DataFrame | None = None, keys: list[str] = KEYS) -> DataFrame:
    """Probabilities with their admin unit, and with ``static`` their ecoregion."""
    out = probs.join(gadm2.select(*keys, "gadm2"), keys)
    return out if static is None else out.join(static.select(*keys, "ecoid"), keys)


def counted_hits(hits: DataFrame, counts: DataFrame, year: int, threshold: float, max_h: int = 16) -> DataFrame:
    """External counts of hit pixels; null where the other source has none (a left join)."""
    own = hits.where((F.col("year") == year) & (F.col("h") < max_h) & (F.col("prob") > threshold))
    return own.join(counts, ["h", "v", "s", "l", "year"], "left").select("h", "v", "s", "l", "count")


def average_count(hits: DataFrame) -> DataFrame:
    """Sum of the counts over all hits, those without a count included."""
    return hits.agg((F.coalesce(F.sum("count"), F.lit(0)) / F.count(F.lit(1))).cast("double").alias("avg_count"))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int = 40) -> DataFrame:
    """Rows by equal bins of ``value``; the top edge falls in the last bin."""
    at = F.least(F.floor((F.col(value) - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("int")
    return df.where(F.col(value).between(low, high)).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def error_counts(df: DataFrame, threshold: float, label: str = "hansen", prob: str = "prob") -> DataFrame:
    """False and true positives and negatives, with precision and sensitivity (null where undefined)."""
    yes, hit = F.col(label) != 0, F.col(prob) > threshold
    n = df.agg(F.count_if(~yes & hit).alias("fp"), F.count_if(~yes & ~hit).alias("tn"), F.count_if(yes & hit).alias("tp"), F.count_if(yes & ~hit).alias("fn"))
    return n.withColumns({"precision": F.try_divide("tp", F.col("tp") + F.col("fp")), "sensitivity": F.try_divide("tp", F.col("tp") + F.col("fn"))})


def summarize_regions(concordance: DataFrame) -> DataFrame:
    """Pixels, hits and hit share by super-ecoregion, quotes stripped from its name."""
    name = F.regexp_replace("region", '"', "")
    n = concordance.groupBy("regionid", name.alias("region")).agg(F.sum("pixels").alias("pixels"), F.sum("hits").alias("hits"))
    return n.withColumn("hit_share", F.try_divide("hits", "pixels"))
