"""Monthly rain grids: yearly binary files of little-endian 32-bit floats, 24 grids of 360 x 720, where each grid of
rain is followed by one of gauge counts; plain or gzip."""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import files
from ..functions import arrays as A
from ..functions import geo as G
from ..functions import periods as P
from ..operators.series import to_series
from ..schema import NODATA

PIXELS_ACROSS = {"250": 240, "500": 120, "1000": 60}  # pixels on a rain cell's side


def grid_bytes(step: float) -> int:
    cols, rows = G.grid_dims(step)
    return 4 * cols * rows


def months(data: bytes, step: float = 0.5) -> list[np.ndarray]:
    """The rain grids of a file, one a month."""
    raw = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    n, (cols, rows) = grid_bytes(step), G.grid_dims(step)
    return [np.frombuffer(raw[k : k + n], dtype="<f4").reshape(rows, cols) for k in range(0, len(raw) - n + 1, 2 * n)]


def month_date(name: str, month: int) -> str:
    """First day of a month of the year in a file's name."""
    found = re.search(r"\d{4}", name)
    if not found:
        raise ValueError(f"no year in {name!r}")
    return f"{found[0]}-{month:02d}-01"


SCHEMA = "date string, row int, col int, val double"


@dataclass
class Month(InputPartition):
    path: str
    date: str
    number: int  # of the grid in its file


class RainReader(DataSourceReader):
    """A partition for each file and month from ``first`` to ``last``; other months are never opened."""

    def __init__(self, paths: list[str], first: str, last: str, step: float, nodata: float):
        self.paths, self.first, self.last, self.step, self.nodata = paths, first, last, step, nodata

    def partitions(self) -> list[Month]:
        out = [Month(path, month_date(path.rsplit("/", 1)[-1], k + 1), k) for path in self.paths for k in range(12)]
        return [m for m in out if self.first <= m.date <= self.last] or [Month("", "", 0)]

    def read(self, partition: Month):
        grid = month_grid(partition.path, partition.number, self.step) if partition.path else None
        if grid is None or (grid == self.nodata).all():
            return
        row, col = np.indices(grid.shape, dtype=np.int32)
        columns = [pa.array(np.full(grid.size, partition.date)), pa.array(row.ravel()), pa.array(col.ravel()), pa.array(grid.ravel().astype(float))]
        for batch in pa.Table.from_arrays(columns, names=["date", "row", "col", "val"]).to_batches(max_chunksize=1 << 16):
            yield batch


class RainSource(DataSource):
    """Rain grids as a Spark data source. ``paths``: files, one a line; ``first``, ``last``: dates; ``step``, ``nodata``."""

    @classmethod
    def name(cls) -> str:
        return "rain_grids"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RainReader:
        return RainReader(self.options["paths"].split("\n"), self.options.get("first", ""), self.options.get("last", "9999"), float(self.options.get("step", 0.5)), float(self.options.get("nodata", -999.0)))


def _opened(path: str):
    system, place = pa_fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    return system.open_input_file(place)


def month_grid(path: str, number: int, step: float = 0.5) -> np.ndarray | None:
    """A month's rain grid from a file of any file system that Arrow knows; None where the file ends before it.

    A plain file is read from the grid's place on; a gzip file is read through to it, and not kept.
    """
    size, (cols, rows) = grid_bytes(step), G.grid_dims(step)
    with _opened(path) as file:
        packed = file.read(2) == b"\x1f\x8b"
        file.seek(0)
        source = gzip.GzipFile(fileobj=file) if packed else file
        if packed:
            for _ in range(2 * number):
                if len(source.read(size)) < size:
                    return None
        else:
            source.seek(2 * number * size)
        data = source.read(size)
    return np.frombuffer(data, dtype="<f4").reshape(rows, cols) if len(data) == size else None


def rain_files(spark: SparkSession, path: str) -> list[str]:
    """The files under a path whose names have a year; all others are left out."""
    found = [x.rsplit(" ", 2)[0] for x in files.listing(spark, path)]
    return [x for x in found if re.search(r"\d{4}", x.rsplit("/", 1)[-1])]


def read_rain(spark: SparkSession, path: str, step: float = 0.5, nodata: float = -999.0, first: str = "", last: str = "9999") -> DataFrame:
    """``date, row, col, val`` of every cell; months without any value are left out.

    A task reads a month of a file; only months (first days, YYYY-MM-DD) from ``first`` to ``last`` are opened. Files without a year in their
    names are none. A file that ends inside a month ends before it. Where Arrow has no file system for the path, Spark
    reads whole files, each in one task.
    """
    if not re.match("(/|file:|hdfs:|s3a?:|gs:|abfss?:)", path):
        return _read_whole(spark, path, step, nodata).where(F.col("date").between(first, last))
    spark.dataSource.register(RainSource)
    found = rain_files(spark, path)
    if not found:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.format("rain_grids").option("paths", "\n".join(found)).option("first", first).option("last", last).option("step", step).option("nodata", nodata).load()


def _read_whole(spark: SparkSession, path: str, step: float, nodata: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"], strict=True):
                for k, grid in enumerate(months(bytes(content), step)):
                    if not (grid == nodata).all():
                        row, col = np.indices(grid.shape)
                        yield pd.DataFrame({"date": month_date(name, k + 1), "row": row.ravel().astype(np.int32), "col": col.ravel().astype(np.int32), "val": grid.ravel().astype(float)})

    named = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return named.where(F.col("name").rlike(r"\d{4}")).mapInPandas(run, SCHEMA)


def bad_files(spark: SparkSession, path: str, step: float = 0.5) -> DataFrame:
    """``path, reason`` of files that are not rain grids of whole months."""
    size, found = 2 * grid_bytes(step), [x.rsplit(" ", 2) for x in files.listing(spark, path)]
    rows = [(p, "no year in the name") for p, _, _ in found if not re.search(r"\d{4}", p.rsplit("/", 1)[-1])]
    rows += [(p, "not of whole months") for p, n, _ in found if not p.endswith(".gz") and re.search(r"\d{4}", p.rsplit("/", 1)[-1]) and int(n) % size and not _packed(p)]
    return spark.createDataFrame(rows, "path string, reason string")


def _packed(path: str) -> bool:
    with _opened(path) as file:
        return file.read(2) == b"\x1f\x8b"


def cell_series(rain: DataFrame, nodata: float = NODATA) -> DataFrame:
    """Monthly series of each cell, missing months nodata."""
    return to_series(rain.select("row", "col", P.period("date", "32").alias("p"), F.col("val").cast("double").alias("series")), ["row", "col"], "p", ["series"], nodata)


def stretched_cells(rain: DataFrame, to_res: str, nodata: float = NODATA, raw_nodata: float = -999.0) -> DataFrame:
    """Cell series filled forward (leading holes 0), at another resolution, rounded. Both nodata values are holes."""
    cells = cell_series(rain, nodata)
    filled = cells.withColumn("series", A.fill_forward("series", lambda x: (x == nodata) | (x == raw_nodata), 0.0))
    if to_res == "32":
        return filled
    s = filled.withColumn("s", A.stretch("start_idx", "series", "32", to_res))
    return s.select("row", "col", F.col("s.start").alias("start_idx"), F.transform("s.series", A.round_half_up).alias("series"))


def cell_tile(row: Column, col: Column) -> Column:
    """``struct<h, v, tile_col, tile_row>`` of a half-degree cell; the grid begins in the south, at longitude 0."""
    v = F.lit(17) - F.floor(row / 20)
    h = F.pmod(F.floor(col / 20) + 18, F.lit(36))
    return F.struct(
        h.cast("int").alias("h"), v.cast("int").alias("v"),
        (F.pmod(col + 360, F.lit(720)) - h * 20).cast("int").alias("tile_col"), (F.lit(359) - row - v * 20).cast("int").alias("tile_row"),
    )


def explode_cells(cells: DataFrame, s_res: str, tiles: set[tuple[int, int]] | None = None) -> DataFrame:
    """Cell series at each pixel of the cell. Cells outside ``tiles`` go before they are exploded."""
    from ..operators.pixels import screen_tiles

    n = PIXELS_ACROSS[s_res]
    at = cells.withColumn("t", cell_tile(F.col("row"), F.col("col"))).select("t.*", "start_idx", "series")
    if tiles is not None:
        at = screen_tiles(at, tiles)
    rows = at.withColumn("line", F.explode(F.sequence(F.col("tile_row") * n, F.col("tile_row") * n + n - 1)))
    out = rows.withColumn("sample", F.explode(F.sequence(F.col("tile_col") * n, F.col("tile_col") * n + n - 1)))
    return out.select(F.lit(s_res).alias("s_res"), "h", "v", "sample", "line", "start_idx", "series")


def resample(rain: DataFrame, pixels: DataFrame, s_res: str, grid: dict) -> DataFrame:
    """Cells (date, row, col, val) at the pixels (h, v, sample, line) whose centre lies in them: an equi-join on the cell."""
    at = pixels.withColumn("cell", G.pixel_to_cell(s_res, grid, "h", "v", "sample", "line")).select("h", "v", "sample", "line", "cell.row", "cell.col")
    out = rain.join(at, ["row", "col"])
    return out.select(F.lit("precl").alias("dataset"), F.lit(s_res).alias("s_res"), F.lit("32").alias("t_res"), "date", "h", "v", "sample", "line", F.col("val").cast("double").alias("val"))


def _cells_of(pixels: DataFrame, s_res: str) -> DataFrame:
    from .grids import GRIDS

    at = pixels.withColumn("cell", G.pixel_to_cell(s_res, GRIDS["precl"], "h", "v", "sample", "line"))
    return at.select("h", "v", "sample", "line", "cell.row", "cell.col")


def series_at(rain: DataFrame, pixels: DataFrame, s_res: str, t_res: str) -> DataFrame:
    """Series of the cells (date, row, col, val) at the pixels (h, v, sample, line) in them: ``s_res, h, v, sample, line,
    start_idx, series``. Cells without a pixel go first, so that a map of a few tiles costs a few tiles."""
    at = _cells_of(pixels, s_res)
    cells = stretched_cells(rain.join(at.select("row", "col").distinct(), ["row", "col"], "left_semi"), t_res)
    return at.join(cells, ["row", "col"]).select(F.lit(s_res).alias("s_res"), "h", "v", "sample", "line", "start_idx", "series")


def rain_chunks(rain: DataFrame, pixels: DataFrame, s_res: str, chunk_size: int, fill: float = NODATA) -> DataFrame:
    """Monthly rain at the pixels, as stored chunks of each tile and month."""
    from ..operators.series import to_chunks
    from .grids import GRIDS

    rows = resample(rain, pixels, s_res, GRIDS["precl"])
    chunks = to_chunks(rows, ["dataset", "s_res", "t_res", "date", "h", "v"], s_res, chunk_size, "val", fill)
    return chunks.withColumn("chunk_size", F.lit(chunk_size))
