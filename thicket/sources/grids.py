"""Static layers on latitude/longitude grids or in the sinusoidal grid itself, from ASCII rasters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo as G
from ..operators.series import to_chunks
from ..schema import NODATA
from ..session import materialize
from . import trap

# Corner (lon, lat), directions, step and nodata of each layer: fixed values.
GRIDS = {
    "precl": {"corner": (0.0, -90.0), "travel": (1, 1), "step": 0.5, "nodata": -999},
    "gadm": {"corner": (-180.000001, 83.635972), "travel": (1, -1), "step": 0.01, "nodata": -9999},
    "ecoid": {"corner": (-179.99996728576, 83.628027), "travel": (1, -1), "step": 0.01, "nodata": -9999},
    "hansen": {"corner": (-179.99998844516, 40.164567), "travel": (1, -1), "step": 0.0041752289295106, "nodata": -9999},
    "vcf": {"corner": (-179.99998844516, 40.164567), "travel": (1, -1), "step": 0.0041752289295106, "nodata": -9999},
    "border": {"corner": (-179.999988445, 40.1690038607), "travel": (1, -1), "step": 0.0041666667, "nodata": -9999},
    "gadm2": {"corner": (-180.0000153, 40.0000010), "travel": (1, -1), "step": 0.0041666667, "nodata": -9999},
}

PIXEL = ["h", "v", "sample", "line"]


def index_lines(spark: SparkSession, path: str, drop: int = 0) -> DataFrame:
    """``row, value``: lines of a text raster numbered from 0 after ``drop`` header lines. One file, in its order.

    Lines are written with their place first, as a second scan could be split otherwise; a row a part comes to the driver.
    """
    lines = materialize(spark.read.text(path).withColumn("i", F.monotonically_increasing_id()), "raster-lines")
    parts = lines.groupBy(F.shiftright("i", 33).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    first = {r["p"]: r["n"] for r in parts.collect()}
    starts, at = [], 0
    for p in range(max(first, default=-1) + 1):
        starts.append(at)
        at += first.get(p, 0)
    base = F.array(*[F.lit(x) for x in starts or [0]])[F.shiftright("i", 33).cast("int")]
    row = base + F.col("i").bitwiseAND(F.lit((1 << 33) - 1))
    return lines.select((row - drop).cast("int").alias("row"), "value").where(F.col("row") >= 0)


def grid_cells(lines: DataFrame) -> DataFrame:
    """``row, col, val`` from lines of ``row v0 v1 ...``; what is not a number is left out."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = lines.select(parts[0].cast("int").alias("row"), F.posexplode(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))).alias("col", "v"))
    return rows.select("row", "col", F.col("v").try_cast("int").alias("val")).where(F.col("val").isNotNull())


def grid_cells_trapped(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``grid_cells``, and the lines (``value``) in which anything is no whole number, from one pass over the text. The
    good cells of such a line count."""
    values = F.filter(F.split(F.trim("value"), r"\s+"), lambda x: x != "")
    whole = (F.size(values) > 1) & F.forall(values, lambda x: x.try_cast("int").isNotNull())
    good, bad = trap.split(lines.select("value"), whole, "layer")
    rows = good.unionByName(bad.where(F.get(values, F.lit(0)).try_cast("int").isNotNull()))
    return grid_cells(rows), bad


def upsample(cells: DataFrame, pixels: DataFrame, s_res: str, grid: dict) -> DataFrame:
    """A coarser grid at each pixel: the cell of the pixel's centre."""
    at = pixels.withColumn("cell", G.pixel_to_cell(s_res, grid, *PIXEL)).select(*PIXEL, "cell.row", "cell.col")
    return at.join(cells, ["row", "col"]).select(*PIXEL, "val")


def downsample(cells: DataFrame, pixels: DataFrame, s_res: str, grid: dict, how: str = "max") -> DataFrame:
    """A finer grid at the given pixels: the sum or the maximum of the cells in each. Cells are summed before the semi-join."""
    if how not in ("max", "sum"):
        raise ValueError("how must be max or sum")
    at = cells.withColumn("p", G.cell_to_pixel(s_res, grid, "row", "col")).select("p.*", "val")
    return at.groupBy(*PIXEL).agg(getattr(F, how)("val").alias("val")).join(pixels.select(*PIXEL), PIXEL, "left_semi")


def absorb(cells: DataFrame, pixels: DataFrame, s_res: str = "500", first_row: int = 5) -> DataFrame:
    """A grid that already is in sinusoidal pixels, whose first row of tiles is ``first_row``."""
    n = G.pixels_at(s_res)
    rows = cells.select(
        F.floor(F.col("col") / n).cast("int").alias("h"), (F.floor(F.col("row") / n) + first_row).cast("int").alias("v"),
        (F.col("col") % n).cast("int").alias("sample"), (F.col("row") % n).cast("int").alias("line"), "val",
    )
    return rows.join(pixels.select(*PIXEL), PIXEL, "left_semi")


def static_layer(cells: DataFrame, pixels: DataFrame, s_res: str, dataset: str, how: str = "max") -> DataFrame:
    """A layer at the pixels, sampled up or down as its step demands."""
    grid = GRIDS[dataset]
    return upsample(cells, pixels, s_res, grid) if grid["step"] >= G.degrees_per_pixel(s_res) else downsample(cells, pixels, s_res, grid, how)


def layer_chunks(layer: DataFrame, dataset: str, s_res: str, chunk_size: int, fill: int = int(NODATA)) -> DataFrame:
    """A layer as stored chunks."""
    chunks = to_chunks(layer, ["h", "v"], s_res, chunk_size, "val", fill)
    return chunks.select(F.lit(dataset).alias("dataset"), F.lit(s_res).alias("s_res"), F.lit("00").alias("t_res"), F.lit(None).cast("string").alias("date"), "h", "v", "chunk", F.lit(chunk_size).alias("chunk_size"), "data")
