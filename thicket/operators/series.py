"""From observations to series: dense expansion, chunks to pixel series, fires, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import geo as G
from ..functions import periods as P
from ..schema import KEYS, NODATA, fire


def _looked_up(entries: str, periods: Column, field: str, fill) -> Column:
    """A field of a map's structs at each period, holes filled."""
    other = fill if isinstance(fill, Column) else F.lit(fill)
    return F.transform(periods, lambda p: F.coalesce(F.try_element_at(entries, p)[field], other))


def to_series(df: DataFrame, keys: list[str], period: str, values: list[str], fill, start=None, end=None) -> DataFrame:
    """One row for each key: ``start_idx`` and a dense array for each of ``values``, holes filled.

    The series runs from ``start`` to ``end``, or from the first to the last period of the key. Periods outside are left
    out; of equal periods the largest entry counts. One exchange, on the keys.
    """
    rows = df
    if start is not None:
        rows = rows.where(F.col(period) >= start)
    if end is not None:
        rows = rows.where(F.col(period) <= end)
    rows = rows.select(*keys, F.col(period).alias("p__"), *values).repartition(*keys)  # serves both aggregations
    once = rows.groupBy(*keys, "p__").agg(*[F.max(v).alias(v) for v in values])
    packed = once.groupBy(*keys).agg(F.min("p__").alias("lo__"), F.max("p__").alias("hi__"), F.map_from_entries(F.collect_list(F.struct("p__", F.struct(*values)))).alias("m__"))
    lo = F.lit(start) if start is not None else F.col("lo__")
    hi = F.lit(end) if end is not None else F.col("hi__")
    series = [_looked_up("m__", F.sequence(lo, hi), v, fill).alias(v) for v in values]
    return packed.select(*keys, lo.cast("int").alias("start_idx"), *series)


def from_series(df: DataFrame, keys: list[str], series: str = "series", start: str = "start_idx") -> DataFrame:
    """A row for each value: ``period, value``."""
    return df.select(*keys, start, F.posexplode(series).alias("at__", "value")).select(*keys, (F.col(start) + F.col("at__")).alias("period"), "value")


def sparse_windows(df: DataFrame, keys: list[str], width: int, height: int, value: str, fill) -> DataFrame:
    """Pixels as row-major windows: ``win_col, win_row, data``."""
    at = (F.col("line") % height) * width + F.col("sample") % width
    placed = df.select(*keys, F.floor(F.col("sample") / width).cast("int").alias("win_col"), F.floor(F.col("line") / height).cast("int").alias("win_row"), at.cast("int").alias("at"), value)
    once = placed.repartition(*keys, "win_col", "win_row").groupBy(*keys, "win_col", "win_row", "at").agg(F.max(value).alias("val__"))
    packed = once.groupBy(*keys, "win_col", "win_row").agg(F.array_sort(F.collect_list(F.struct("at", "val__"))).alias("e__"))
    full = F.transform("e__", lambda e: e["val__"])  # a full window needs no look-up
    m = F.map_from_entries("e__")
    sparse = A.let(m, lambda held: F.transform(F.sequence(F.lit(0), F.lit(width * height - 1)), lambda p: F.coalesce(F.try_element_at(held, p), F.lit(fill))))
    return packed.select(*keys, "win_col", "win_row", F.when(F.size("e__") == width * height, full).otherwise(sparse).alias("data"))


def to_chunks(df: DataFrame, keys: list[str], s_res: str, chunk_size: int, value: str = "val", fill=int(NODATA)) -> DataFrame:
    """Tile pixels as whole-row chunks: ``chunk, data``."""
    width, height = G.chunk_dims(s_res, chunk_size)
    out = sparse_windows(df, keys, width, height, value, fill)
    return out.select(*keys, F.col("win_row").alias("chunk"), "data").where(F.size("data") == chunk_size)


def blossom_chunks(chunks: DataFrame, keep: list[str], s_res: str, chunk_size: int, data: str = "data") -> DataFrame:
    """A row for each pixel of a chunk: ``sample, line, val``."""
    rows = chunks.select(*keep, "chunk", F.posexplode(data).alias("idx", "val"))
    return rows.withColumn("at", G.chunk_position(s_res, chunk_size, F.col("chunk"), F.col("idx"))).select(*keep, F.col("at.sample").alias("sample"), F.col("at.line").alias("line"), "val")


def newest_chunks(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """One chunk for each of ``keys``: that of the newest pedigree; of equally new ones the largest data. A table without
    pedigrees is taken as it is, copies and all, to one."""
    order = F.struct("pedigree", "data") if "pedigree" in chunks.columns else F.col("data")
    return chunks.groupBy(*keys).agg(F.max_by("data", order).alias("data"))


def chunks_to_series(chunks: DataFrame, t_res: str, chunk_size: int, missing: int = int(NODATA)) -> DataFrame:
    """Chunks (dataset, s_res, h, v, chunk, date, data; pedigree where versions are kept) as pixel series; a date without a
    chunk is missing for all.

    Of versions of a chunk and period the newest counts. Start and end are the chunk's first and last period. Each
    resolution has its own place in a tile. The period arrays are built once a chunk, so pixels are not shuffled one by one.
    """
    keys = ["dataset", "s_res", "h", "v", "chunk"]
    held = [c for c in ("pedigree",) if c in chunks.columns]
    dated = chunks.select(*keys, *held, P.period("date", t_res).alias("p"), "data").repartition(*keys)  # serves both aggregations
    byp = newest_chunks(dated, [*keys, "p"]).groupBy(*keys).agg(F.min("p").alias("lo"), F.max("p").alias("hi"), F.map_from_entries(F.collect_list(F.struct("p", "data"))).alias("m"))
    pixel = F.transform(F.sequence(F.lit(0), F.lit(chunk_size - 1)), lambda i: F.transform(F.sequence("lo", "hi"), lambda p: F.coalesce(F.try_element_at(F.try_element_at("m", p), i + 1), F.lit(missing))))
    rows = byp.select(*keys, "lo", "hi", F.posexplode(pixel).alias("idx", "series"))
    width = (F.lit(G.BASE_PIXELS * G.BASE_RES) / F.col("s_res").cast("int")).cast("int")
    whole = F.when(F.lit(chunk_size) % width == 0, width).otherwise(F.raise_error(F.lit("a chunk must hold whole rows")).cast("int"))
    at = G.window_position(F.col("width__"), F.lit(chunk_size) / F.col("width__"), F.lit(0), F.col("chunk"), F.col("idx"))
    return rows.withColumn("width__", whole).withColumn("at", at).select("dataset", "s_res", "h", "v", F.col("at.sample").alias("sample"), F.col("at.line").alias("line"), F.col("lo").alias("start_idx"), F.col("hi").alias("end_idx"), "series")


FIRE_FIELDS = ("temp330", "conf50", "both_preds", "count")


def fire_counts(df: DataFrame, keys: list[str], kelvin: str = "kelvin", conf: str = "conf") -> DataFrame:
    """Fires by key: all with a confidence, those of 330 K or more, of confidence 50 or more, and both."""
    hot, sure = F.col(kelvin) >= 330, F.col(conf) >= 50
    return df.groupBy(*keys).agg(F.count_if(hot).alias("temp330"), F.count_if(sure).alias("conf50"), F.count_if(hot & sure).alias("both_preds"), F.count(conf).alias("count"))


def aggregate_fires(df: DataFrame, keys: list[str], t_res: str, date: str = "date") -> DataFrame:
    """Fire counts summed by period."""
    return df.groupBy(*keys, P.period(date, t_res).alias("period")).agg(*[F.sum(f).alias(f) for f in FIRE_FIELDS])


def fire_series(df: DataFrame, keys: list[str], t_res: str, first_date: str, end_date: str) -> DataFrame:
    """Running sums of fire counts from ``first_date`` to ``end_date``: ``start_idx, fires``.

    Sums accumulate in one pass over a pixel's periods; a period without fires repeats the sums before it.
    """
    start, end = P.period_of(first_date, t_res), P.period_of(end_date, t_res)
    sums = aggregate_fires(df, keys, t_res).where(F.col("period").between(start, end))
    packed = sums.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("period", F.struct(*[F.col(f).cast("int").alias(f) for f in FIRE_FIELDS])))).alias("m"))
    zero = F.struct(F.array().cast("array<struct<temp330:int,conf50:int,both_preds:int,count:int>>").alias("out"), fire().alias("last"))

    def step(acc: Column, p: Column) -> Column:
        here = F.try_element_at("m", p)
        now = fire(*[acc["last"][f] + F.coalesce(here[f], F.lit(0)) for f in FIRE_FIELDS])
        return F.struct(F.concat(acc["out"], F.array(now)).alias("out"), now.alias("last"))

    return packed.select(*keys, F.lit(start).alias("start_idx"), F.aggregate(F.sequence(F.lit(start), F.lit(end)), zero, step, lambda acc: acc["out"]).alias("fires"))


def overlay_versions(df: DataFrame, keys: list[str], series: list[str], consecutive: bool = True, nodata: float = NODATA) -> DataFrame:
    """Versions of a pixel's series (start_idx, pedigree) laid over each other: in each period the newest one counts, of
    equally new ones the one with the later start.

    A gap between versions raises with ``consecutive``, else it is filled.
    """
    zipped = F.arrays_zip(*series)
    rows = df.select(*keys, "pedigree", "start_idx", F.posexplode(zipped).alias("at", "z")).withColumn("p", F.col("start_idx") + F.col("at"))
    newest = rows.repartition(*keys).groupBy(*keys, "p").agg(F.max_by("z", F.struct("pedigree", "start_idx")).alias("z"))
    whole = newest.groupBy(*keys).agg(F.min("p").alias("lo"), F.max("p").alias("hi"), F.map_from_entries(F.collect_list(F.struct("p", "z"))).alias("m"))
    if consecutive:
        gap = F.raise_error(F.lit("versions leave a gap")).cast("int")
        whole = whole.withColumn("lo", F.when(F.size("m") == F.col("hi") - F.col("lo") + 1, F.col("lo")).otherwise(gap))
    fields = [_looked_up("m", F.sequence("lo", "hi"), s, nodata).alias(s) for s in series]
    return whole.select(*keys, F.col("lo").alias("start_idx"), *fields)


def pixel_values(dynamic: DataFrame, fires: DataFrame, start: int, end: int, keys: list[str] = KEYS, nodata: float = NODATA) -> DataFrame:
    """Trend series and fires as one row a pixel and period: ``period, val``.

    Pixels without fires have zero counts (a left join). Running minima of short and running maxima of break statistics
    ride over nulls; other nulls become nodata. Fires cut shorter than the trends cut the rows, too.
    """
    joined = dynamic.join(fires.select(*keys, F.col("start_idx").alias("f_start"), "fires"), keys, "left")
    big = 1_000_000.0
    low = A.replace_value(A.running(A.fill_forward("short", None, big), F.array_min), big, nodata)
    high = A.replace_value(A.running(A.fill_forward("break", None, -big), F.array_max), -big, nodata)
    n = F.size("short")
    cut = A.align(("start_idx", "short"), ("f_start", "fires"))["s1"]
    size = F.when(F.col("fires").isNull(), n).otherwise(F.least(n, F.size(cut)))
    named = F.arrays_zip(low.alias("short_drop"), A.nulls_to_nodata("long", nodata).alias("long_drop"), A.nulls_to_nodata("t_stat", nodata).alias("t_stat"), high.alias("param_break"))
    rows = joined.select(*keys, "start_idx", cut.alias("fire_cut"), F.posexplode(F.slice(named, 1, size)).alias("at", "z"))
    value = F.struct(F.coalesce(F.try_element_at("fire_cut", F.col("at") + 1), fire()).alias("fire"), *[F.col(f"z.{k}").cast("double").alias(k) for k in ("short_drop", "long_drop", "t_stat", "param_break")])
    return rows.select(*keys, (F.col("start_idx") + F.col("at")).alias("period"), value.alias("val")).where(F.col("period").between(start, end))
