"""The sinusoidal tile grid, latitude/longitude grids, and web-map tiles, as column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the grid and of spherical Mercator.
RHO = 6371007.181
H_TILES, V_TILES = 36, 18
BASE_RES, BASE_PIXELS = 250, 4800
ROW_OFFSETS = [14, 11, 9, 6, 4, 2, 1, 0, 0, 0, 0, 1, 2, 4, 6, 9, 11, 14]
DATASETS = {"MCD45A1": ("500", "32"), "MOD13Q1": ("250", "16"), "MOD13A1": ("500", "16"), "MOD13A2": ("1000", "16"), "MOD13A3": ("1000", "32")}
MERCATOR_RADIUS = 6378137
TILE_PIXELS = 256

MIN_X, MAX_Y = -math.pi * RHO, math.pi / 2 * RHO
ORIGIN_SHIFT = 2 * math.pi * MERCATOR_RADIUS / 2
INITIAL_RES = 2 * math.pi * MERCATOR_RADIUS / TILE_PIXELS


def _c(x) -> Column:
    return x if isinstance(x, Column) else (F.col(x) if isinstance(x, str) else F.lit(x))


def pixels_at(res: str) -> int:
    """Pixels on a tile's side; ``res`` in metres must divide the tile evenly."""
    total = BASE_RES * BASE_PIXELS
    if total % int(res):
        raise ValueError(f"resolution {res} does not divide a tile")
    return total // int(res)


def spatial_res(product: str) -> str | None:
    return DATASETS.get(product, (None, None))[0]


def temporal_res(product: str) -> str | None:
    return DATASETS.get(product, (None, None))[1]


def chunk_dims(res: str, chunk_size: int) -> tuple[int, int]:
    """Width and height of a chunk of whole pixel rows."""
    width = pixels_at(res)
    if chunk_size <= 0 or chunk_size % width:
        raise ValueError("a chunk must hold whole rows")
    return width, chunk_size // width


def degrees_per_pixel(res: str) -> float:
    return 10.0 / pixels_at(res)


def valid_tiles() -> set[tuple[int, int]]:
    """Tiles that hold data."""
    return {(h, v) for v, off in enumerate(ROW_OFFSETS) for h in range(off, H_TILES - off)}


def is_valid_tile(h, v) -> Column:
    off = F.try_element_at(F.array(*[F.lit(x) for x in ROW_OFFSETS]), (_c(v) + 1).cast("int"))
    inside = (_c(v) >= 0) & (_c(v) < V_TILES)
    return F.when(inside, (_c(h) >= off) & (_c(h) < H_TILES - off)).otherwise(F.lit(False))


def is_valid_pixel(res: str, h, v, sample, line) -> Column:
    n = pixels_at(res)
    return is_valid_tile(h, v) & (_c(sample) < n) & (_c(line) < n)


def tile_string(h, v) -> Column:
    """``HHHVVV`` of a valid tile, else null."""
    return F.when(is_valid_tile(h, v), F.format_string("%03d%03d", _c(h).cast("int"), _c(v).cast("int")))


def parse_tile_string(text) -> Column:
    h, v = F.substring(_c(text), 1, 3).cast("int"), F.substring(_c(text), 4, 3).cast("int")
    return F.when(is_valid_tile(h, v), F.struct(h.alias("h"), v.alias("v")))


def window_position(width: int, height: int, win_col, win_row, idx) -> Column:
    """Sample and line of a pixel by its index in a window."""
    i = _c(idx)
    return F.struct((i % width + _c(win_col) * width).cast("int").alias("sample"), (F.floor(i / width) + _c(win_row) * height).cast("int").alias("line"))


def chunk_position(res: str, chunk_size: int, chunk, idx) -> Column:
    width, height = chunk_dims(res, chunk_size)
    return window_position(width, height, F.lit(0), chunk, idx)


def is_valid_latlon(lat, lon) -> Column:
    return F.coalesce(_c(lat).between(-90, 90) & _c(lon).between(-180, 180), F.lit(False))


def pixel_length(res: str) -> float:
    return (MAX_Y + MAX_Y) / V_TILES / pixels_at(res)


def latlon_to_sinu(lat, lon) -> tuple[Column, Column]:
    lat, lon = F.radians(_c(lat)), F.radians(_c(lon))
    return F.lit(RHO) * (F.cos(lat) * lon), F.lit(RHO) * lat


def sinu_to_latlon(x, y) -> tuple[Column, Column]:
    lat = _c(y) / RHO
    return F.degrees(lat), F.degrees(_c(x) / (F.lit(RHO) * F.cos(lat)))


def latlon_to_pixel(res: str, lat, lon) -> Column:
    """``struct<h, v, sample, line>`` of a position. The index is the distance times the reciprocal of the pixel's
    length, truncated: dividing would give other pixels at edges."""
    x, y = latlon_to_sinu(lat, lon)
    n, inverse = pixels_at(res), 1 / pixel_length(res)
    across, down = ((x - MIN_X) * inverse).cast("int"), ((F.lit(MAX_Y) - y) * inverse).cast("int")
    return F.struct(
        F.floor(across / n).cast("int").alias("h"), F.floor(down / n).cast("int").alias("v"),
        (across % n).cast("int").alias("sample"), (down % n).cast("int").alias("line"),
    )


def pixel_to_latlon(res: str, h, v, sample, line) -> Column:
    """``struct<lat, lon>`` of a pixel's centre."""
    edge, n = pixel_length(res), pixels_at(res)
    across, down = ((_c(a) * n + _c(b)) * edge + edge / 2 for a, b in ((h, sample), (v, line)))
    lat, lon = sinu_to_latlon(F.lit(MIN_X) + across, F.lit(MAX_Y) - down)
    return F.struct(lat.alias("lat"), lon.alias("lon"))


def snap_latlon(res: str, lat, lon) -> Column:
    """The centre of the pixel at ``res`` that holds a position."""
    p = latlon_to_pixel(res, lat, lon)
    return pixel_to_latlon(res, p["h"], p["v"], p["sample"], p["line"])


def bucket(step: float, value) -> Column:
    return F.floor(_c(value) * (1 / step)).cast("int")


def travel(step: float, sign: int, start: float, idx) -> Column:
    return F.lit(start) + sign * ((_c(idx) + 0.5) * step)


def constrain(span: float, start: float, value) -> Column:
    return F.lit(start) + F.pmod(_c(value) - start, F.lit(float(span)))


def grid_dims(step: float) -> tuple[int, int]:
    """Columns and rows of a global grid."""
    return int(360 // step), int(180 // step)


def latlon_to_cell(grid: dict, lat, lon) -> Column:
    """``struct<row, col>`` on a grid given by ``corner`` (lon, lat), ``travel`` (+1/-1 each) and ``step``."""
    (lon0, lat0), (lon_dir, lat_dir), step = grid["corner"], grid["travel"], grid["step"]
    row = F.pmod(lat_dir * (_c(lat) - lat0), F.lit(180.0))
    col = F.pmod(lon_dir * (_c(lon) - lon0), F.lit(360.0))
    return F.struct(bucket(step, row).alias("row"), bucket(step, col).alias("col"))


def cell_to_latlon(grid: dict, row, col) -> Column:
    (lon0, lat0), (lon_dir, lat_dir), step = grid["corner"], grid["travel"], grid["step"]
    return F.struct(constrain(180, -90, travel(step, lat_dir, lat0, row)).alias("lat"), constrain(360, -180, travel(step, lon_dir, lon0, col)).alias("lon"))


def is_valid_cell(step: float, row, col) -> Column:
    cols, rows = grid_dims(step)
    return _c(row).between(0, rows) & _c(col).between(0, cols)


def cell_to_pixel(res: str, grid: dict, row, col) -> Column:
    at = cell_to_latlon(grid, row, col)
    return latlon_to_pixel(res, at["lat"], at["lon"])


def pixel_to_cell(res: str, grid: dict, h, v, sample, line) -> Column:
    at = pixel_to_latlon(res, h, v, sample, line)
    return latlon_to_cell(grid, at["lat"], at["lon"])


# --- web-map tiles (spherical Mercator) ---


def is_mappable(lat, lon) -> Column:
    """Within bounds; the poles, whose map coordinate is infinite, are left out."""
    return is_valid_latlon(lat, lon) & (F.abs(_c(lat)) < 90)


def latlon_to_meters(lat, lon) -> tuple[Column, Column]:
    x = _c(lon) * ORIGIN_SHIFT / 180
    y = F.ln(F.tan((_c(lat) + 90) * math.pi / 360)) / (math.pi / 180) * (ORIGIN_SHIFT / 180)
    return x, y


def meters_to_pixels(x, y, zoom: int) -> tuple[Column, Column]:
    res = INITIAL_RES / 2**zoom
    return (_c(x) + ORIGIN_SHIFT) / res, (_c(y) + ORIGIN_SHIFT) / res


def meters_to_tile(x, y, zoom: int) -> Column:
    """``struct<x, y, z>``, rows counted from the top."""
    px, py = meters_to_pixels(x, y, zoom)
    tx, ty = (F.ceil(p / TILE_PIXELS) - 1 for p in (px, py))
    return F.struct(tx.cast("long").alias("x"), (F.lit(2**zoom - 1) - ty).cast("long").alias("y"), F.lit(zoom).alias("z"))


def latlon_to_tile(lat, lon, zoom: int) -> Column:
    return meters_to_tile(*latlon_to_meters(lat, lon), zoom)


def zoom_out(n) -> Column:
    return F.shiftright(_c(n), 1)


def parent_tiles(x, y, z, min_z: int) -> Column:
    """The tile and its parents down to ``min_z``, coarsest first; none if it is coarser than ``min_z``."""
    levels = F.when(_c(z) >= min_z, F.sequence(F.lit(min_z), _c(z))).otherwise(F.array().cast("array<int>"))

    def at(level: Column) -> Column:
        factor = F.pow(F.lit(2.0), _c(z) - level).cast("long")
        return F.struct(F.floor(_c(x) / factor).cast("long").alias("x"), F.floor(_c(y) / factor).cast("long").alias("y"), level.alias("z"))

    return F.transform(levels, at)


# --- the world as one grid, and windows of it ---


def global_dims(res: str) -> tuple[int, int]:
    """Rows and columns of the whole grid."""
    n = pixels_at(res)
    return V_TILES * n, H_TILES * n


def global_rowcol(res: str, h, v, sample, line) -> Column:
    n = pixels_at(res)
    return F.struct((_c(v) * n + _c(line)).cast("long").alias("row"), (_c(h) * n + _c(sample)).cast("long").alias("col"))


def global_index(res: str, row, col) -> Column:
    return _c(row).cast("long") * global_dims(res)[1] + _c(col)


def index_rowcol(res: str, idx) -> Column:
    cols = global_dims(res)[1]
    return F.struct(F.floor(_c(idx) / cols).cast("long").alias("row"), (_c(idx) % cols).cast("long").alias("col"))


def pixel_of_rowcol(res: str, row, col) -> Column:
    n = pixels_at(res)
    return F.struct(
        F.floor(_c(col) / n).cast("int").alias("h"), F.floor(_c(row) / n).cast("int").alias("v"),
        (_c(col) % n).cast("int").alias("sample"), (_c(row) % n).cast("int").alias("line"),
    )


def pixel_from_tile(res: str, h, v, pixel) -> Column:
    """A pixel as tile ``h, v`` numbers it: sample and line count from that tile's corner, beyond its sides for pixels of
    other tiles."""
    n, p = pixels_at(res), _c(pixel)
    return F.struct(
        _c(h).cast("int").alias("h"), _c(v).cast("int").alias("v"),
        (p["sample"] + (p["h"] - _c(h)) * n).cast("int").alias("sample"), (p["line"] + (p["v"] - _c(v)) * n).cast("int").alias("line"),
    )


def window_rowcol(top: int, left: int, height: int, width: int, row, col) -> Column:
    """Row and column inside a window of the world; null outside it."""
    r, c = _c(row) - top, _c(col) - left
    return F.when((r >= 0) & (r < height) & (c >= 0) & (c < width), F.struct(r.alias("row"), c.alias("col")))


def window_index(top: int, left: int, height: int, width: int, row, col) -> Column:
    at = window_rowcol(top, left, height, width, row, col)
    return at["row"] * width + at["col"]


def window_index_to_global(res: str, top: int, left: int, width: int, idx) -> Column:
    return global_index(res, F.floor(_c(idx) / width) + top, _c(idx) % width + left)


def neighbor_indices(res: str, idx) -> Column:
    """The 9 indices around and at an index, by rows; edges are not treated."""
    cols = global_dims(res)[1]
    return F.array(*[_c(idx) + dr * cols + dc for dr in (-1, 0, 1) for dc in (-1, 0, 1)])
