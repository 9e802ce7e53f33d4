"""Features of the pixels around a pixel."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import KEYS, NEIGHBOR_STATS, NODATA, PIXEL_STATS, add_fires, fire, has_nodata


def neighbor_of(value: Column) -> Column:
    """A single pixel's features as an aggregate of one."""
    stats = [value[s] for s in PIXEL_STATS for _ in (0, 1)]
    return _aggregate(value["fire"], F.lit(1), stats)


def empty_neighbor() -> Column:
    return _aggregate(fire(), F.lit(0), [F.lit(0.0)] * 8)


def _aggregate(fires: Column, count: Column, stats: list[Column]) -> Column:
    return F.struct(fires.alias("fire"), count.cast("int").alias("neighbor_count"), *[s.cast("double").alias(n) for n, s in zip(NEIGHBOR_STATS, stats, strict=True)])


def merge_neighbor(acc: Column, value: Column, nodata: float = NODATA) -> Column:
    """Adds a pixel to an aggregate. A pixel with nodata is passed over, and replaces nothing but is replaced when it
    came first; two with nodata at the start leave the empty aggregate, whose zeros then count."""
    n = acc["neighbor_count"]
    stats = []
    for k, s in enumerate(PIXEL_STATS):
        mean, edge = acc[NEIGHBOR_STATS[2 * k]], acc[NEIGHBOR_STATS[2 * k + 1]]
        pick = F.greatest if s == "param_break" else F.least
        stats += [(mean * n + value[s]) / (n + 1), pick(edge, value[s])]
    bad_acc, bad = has_nodata(acc, NEIGHBOR_STATS, nodata), has_nodata(value, PIXEL_STATS, nodata)
    merged = _aggregate(add_fires(acc["fire"], value["fire"]), n + 1, stats)
    return F.when(bad_acc & bad, empty_neighbor()).when(bad_acc, neighbor_of(value)).when(bad, acc).otherwise(merged)


def combine_neighbors(values: Column, nodata: float = NODATA) -> Column:
    """An array of pixel features, in order, as one aggregate; none give the empty one."""
    rest = F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0)))
    folded = F.aggregate(rest, neighbor_of(values[0]), lambda acc, v: merge_neighbor(acc, v, nodata))
    return F.when(F.size(values) > 0, folded).otherwise(empty_neighbor())


def _sent(df: DataFrame, keys: list[str], columns: list[str], radius: int, side: int, across: bool) -> DataFrame:
    """Each pixel at all places within ``radius``, in blocks of ``side`` x ``side`` places: ``block_s, block_l``, the place's
    ``sample, line``, and the offset ``ds, dl`` from place to pixel.

    Pixels travel by block, one row each, and a second one for each further block that their places reach (``across``; else
    no place beyond the own block is seen). Only then, in the block's task, are they copied to their places.
    """
    block = lambda c: F.floor(c / side)
    placed = df.select(*keys, F.col("sample").alias("from_s"), F.col("line").alias("from_l"), *columns)
    if across:
        reach = lambda c: F.sequence(block(F.col(c) - radius), block(F.col(c) + radius))
        placed = placed.withColumn("block_s", F.explode(reach("from_s"))).withColumn("block_l", F.explode(reach("from_l")))
    else:
        placed = placed.withColumns({"block_s": block(F.col("from_s")), "block_l": block(F.col("from_l"))})
    span = range(-radius, radius + 1)
    at = F.explode(F.array(*[F.struct(F.lit(dl).alias("dl"), F.lit(ds).alias("ds")) for dl in span for ds in span]))
    copied = placed.repartition(*keys, "block_s", "block_l").select("*", at.alias("o"))
    copied = copied.select(*keys, "block_s", "block_l", (F.col("from_s") - F.col("o.ds")).alias("sample"), (F.col("from_l") - F.col("o.dl")).alias("line"), "o.ds", "o.dl", *columns)
    return copied.where((block(F.col("sample")) == F.col("block_s")) & (block(F.col("line")) == F.col("block_l")))


def neighbor_values(df: DataFrame, window: int = 600, halo: bool = False, keys: list[str] = KEYS, nodata: float = NODATA) -> DataFrame:
    """Each pixel's features (keys, period, val) with ``neighbor``, those of up to 8 pixels around it in its period.

    Pixels of another window of ``window`` x ``window`` are not seen, nor of another tile, so a window is what one exchange
    brings together, a row a pixel; ``halo`` sees across windows of a tile, whose edges then travel twice. A place is met
    by at most nine pixels, inside the task.
    """
    place = [k for k in keys if k not in ("sample", "line")]
    met = _sent(df, [*place, "period"], ["val"], 1, window, halo)
    own = (F.col("ds") == 0) & (F.col("dl") == 0)
    order = (F.col("dl") + 1) * 3 + F.col("ds") + 1  # by rows
    groups = met.groupBy(*place, "period", "block_s", "block_l", "sample", "line").agg(
        F.max(F.when(own, F.col("val"))).alias("val"),
        F.array_sort(F.collect_list(F.when(~own, F.struct(order.alias("k"), "val")))).alias("around"),
    )
    combined = combine_neighbors(F.transform("around", lambda x: x["val"]), nodata)
    return groups.where(F.col("val").isNotNull()).select(*keys, "period", "val", combined.alias("neighbor"))


def _spread(grid: np.ndarray, width: int, pick: np.ufunc, fill: float) -> np.ndarray:
    """Least or greatest of each ``width`` neighbouring values along the last axis: the window is the end of one stretch of
    ``width`` and the beginning of the next, so that running extremes of stretches from both sides give it, whatever its width."""
    n = grid.shape[-1]
    padded = np.concatenate([grid, np.full((*grid.shape[:-1], -n % width), fill)], axis=-1)
    parts = padded.reshape(*grid.shape[:-1], -1, width)
    ahead = pick.accumulate(parts, axis=-1).reshape(padded.shape)
    back = pick.accumulate(parts[..., ::-1], axis=-1)[..., ::-1].reshape(padded.shape)
    return pick(back[..., : n - width + 1], ahead[..., width - 1 : n])


def _moved(grid: np.ndarray, width: int) -> np.ndarray:
    """Sums of each ``width`` neighbouring values along the last axis, by running sums."""
    upto = np.cumsum(np.concatenate([np.zeros((*grid.shape[:-1], 1)), grid], axis=-1), axis=-1)
    return upto[..., width:] - upto[..., :-width]


def _both(grid: np.ndarray, one) -> np.ndarray:
    """A pass along rows, and one along columns."""
    return one(one(grid).T).T


def window_stat(df: DataFrame, keys: list[str], value: str, radius: int = 1, side: int = 64) -> DataFrame:
    """Count, mean, least and greatest value of the (2 radius + 1)**2 block around each pixel, itself included; nulls do not
    count. One exchange, by squares of ``side`` pixels and their rims: a row a pixel, and one more for each further square
    that sees it.

    In its task a square is a grid. Sums and extremes are taken along rows and then along columns, each in a pass that does
    not depend on the radius. A pixel that comes twice counts once, with its greatest value.
    """
    side, width = max(side, 2 * radius), 2 * radius + 1
    block = lambda c: F.floor(c / side)
    reach = lambda c: F.sequence(block(F.col(c) - radius), block(F.col(c) + radius))
    kind = df.schema[value].dataType.simpleString()
    placed = df.select(*keys, "sample", "line", F.col(value).cast("double").alias("value__"))
    sent = placed.withColumn("block_s", F.explode(reach("sample"))).withColumn("block_l", F.explode(reach("line")))
    names = [*keys, "sample", "line", "n", "avg_value", "min_value", "max_value"]
    types = {k: df.schema[k].dataType.simpleString() for k in [*keys, "sample", "line"]}
    schema = ", ".join([f"{k} {t}" for k, t in types.items()]) + ", n long, avg_value double, min_value double, max_value double"

    def square(key, rows: pd.DataFrame) -> pd.DataFrame:
        s0, l0 = (int(key[len(keys) + i]) * side for i in (0, 1))
        s, line = rows["sample"].to_numpy() - s0 + radius, rows["line"].to_numpy() - l0 + radius
        grid = np.full((side + 2 * radius, side + 2 * radius), np.nan)
        np.fmax.at(grid, (line, s), rows["value__"].to_numpy(dtype=float))
        known = ~np.isnan(grid)
        n = _both(known.astype(float), lambda g: _moved(g, width))
        total = _both(np.where(known, grid, 0.0), lambda g: _moved(g, width))
        least = _both(np.where(known, grid, np.inf), lambda g: _spread(g, width, np.minimum, np.inf))
        most = _both(np.where(known, grid, -np.inf), lambda g: _spread(g, width, np.maximum, -np.inf))
        inside = (s >= radius) & (s < side + radius) & (line >= radius) & (line < side + radius)
        own = inside & ~rows.duplicated(["sample", "line"]).to_numpy()
        at = (line[own] - radius, s[own] - radius)
        count = np.rint(n[at]).astype(np.int64)
        out = rows.loc[own, [*keys, "sample", "line"]].assign(n=count)
        none = count == 0
        with np.errstate(all="ignore"):
            found = {"avg_value": total[at] / count, "min_value": least[at], "max_value": most[at]}
        return out.assign(**{c: np.where(none, np.nan, v) for c, v in found.items()})[names]

    out = sent.groupBy(*keys, "block_s", "block_l").applyInPandas(square, schema)
    real = lambda c: F.when(~F.isnan(c), F.col(c))
    return out.select(*keys, "sample", "line", "n", real("avg_value").alias("avg_value"), real("min_value").cast(kind).alias("min_value"), real("max_value").cast(kind).alias("max_value"))
