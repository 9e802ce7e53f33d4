"""Types of the stored tables and the parameters of a run."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

KEYS = ["s_res", "h", "v", "sample", "line"]
NODATA = -9999.0
RAW_FILL = -3000  # of vegetation index rasters
CHUNK_SIZE = 24000  # pixels

FIRE = "struct<temp330:int,conf50:int,both_preds:int,count:int>"
PIXEL_VALUE = f"struct<fire:{FIRE},short_drop:double,long_drop:double,t_stat:double,param_break:double>"
NEIGHBOR_VALUE = (
    f"struct<fire:{FIRE},neighbor_count:int,avg_short_drop:double,min_short_drop:double,avg_long_drop:double,min_long_drop:double,"
    "avg_t_stat:double,min_t_stat:double,avg_param_break:double,max_param_break:double>"
)
KEY_FIELDS = "s_res string, h int, v int, sample int, line int"
SERIES = f"dataset string, {KEY_FIELDS}, t_res string, start_idx int, end_idx int, series array<double>, pedigree bigint"
CHUNK = "dataset string, s_res string, t_res string, date string, h int, v int, chunk int, chunk_size int, data array<int>, pedigree bigint"

# Ecoregions whose probabilities are halved (nearly) before export: fixed values.
DISCOUNTED = {
    60122: 0.51, 60147: 0.51, 30109: 0.51, 40134: 0.51, 40150: 0.51, 40131: 0.51, 40136: 0.51,
    40126: 0.51, 30130: 0.51, 40141: 0.51, 40132: 0.51, 40120: 0.51, 40135: 0.51, 30123: 0.51,
}


@dataclass(frozen=True)
class RunParams:
    """What a run at one resolution needs; dates are ISO strings."""

    est_start: str = "2005-12-19"
    est_end: str | None = None
    s_res: str = "500"
    t_res: str = "16"
    neighbors: int = 1
    window: int = 600  # side of the blocks inside which neighbours are sought
    vcf_limit: int = 25
    long_block: int = 30
    short_block: int = 10
    ridge: float = 1e-8
    threshold: float = 1e-6
    max_iter: int = 500
    min_coast_dist: int = 3
    nodata: float = NODATA
    discounts: dict[int, float] = field(default_factory=lambda: dict(DISCOUNTED))


RUNS = {"500-16": RunParams(), "1000-32": RunParams(s_res="1000", t_res="32", est_start="2005-12-01", long_block=15, short_block=5)}


def run_params(s_res: str, t_res: str, est_start: str | None = None, est_end: str | None = None) -> RunParams:
    """The parameters of a known resolution pair; dates may be replaced."""
    from dataclasses import replace

    base = RUNS[f"{s_res}-{t_res}"]
    return replace(base, est_start=est_start or base.est_start, est_end=est_end or base.est_end)


def fire(temp330=0, conf50=0, both=0, count=0) -> Column:
    names = ("temp330", "conf50", "both_preds", "count")
    return F.struct(*[(x if isinstance(x, Column) else F.lit(x)).cast("int").alias(n) for n, x in zip(names, (temp330, conf50, both, count), strict=True)])


def add_fires(a: Column, b: Column) -> Column:
    return fire(*[a[n] + b[n] for n in ("temp330", "conf50", "both_preds", "count")])


def pixel_value(fire_value: Column, short: Column, long: Column, t_stat: Column, param_break: Column) -> Column:
    """The features of a pixel in a period; a pixel without fires has zeros."""
    names = ("short_drop", "long_drop", "t_stat", "param_break")
    stats = [x.cast("double").alias(n) for n, x in zip(names, (short, long, t_stat, param_break), strict=True)]
    return F.struct(F.coalesce(fire_value, fire()).alias("fire"), *stats)


def has_nodata(value: Column, fields: tuple[str, ...], nodata: float = NODATA) -> Column:
    """Any of the top-level fields is the nodata value (fire counts are not looked into)."""
    out = F.lit(False)
    for f in fields:
        out = out | (value[f] == nodata)
    return out


PIXEL_STATS = ("short_drop", "long_drop", "t_stat", "param_break")
NEIGHBOR_STATS = ("avg_short_drop", "min_short_drop", "avg_long_drop", "min_long_drop", "avg_t_stat", "min_t_stat", "avg_param_break", "max_param_break")


def time_series(start: Column, series: Column) -> Column:
    """``struct<start_idx, end_idx, series>``; a start that is not positive raises."""
    end = start + F.size(series) - 1
    checked = F.when(start > 0, start).otherwise(F.raise_error(F.lit("series must start after period 0")).cast("int"))
    return F.struct(checked.cast("int").alias("start_idx"), end.cast("int").alias("end_idx"), series.alias("series"))
