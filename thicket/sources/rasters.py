"""Whole files and raster bands as pixel chunks. HDF needs GDAL, which is asked for where it is used."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo as G

# Marks by which a band is known in a file's list of bands: fixed values.
BANDS = {
    "evi": "EVI", "qual": "VI Quality", "red": "red reflectance", "mir": "MIR reflectance", "nir": "NIR reflectance", "azi": "azimuth",
    "blue": "blue reflectance", "reli": "pixel", "viewz": "view zenith", "ndvi": "NDVI", "sunz": "sun zenith",
}
WANTED = ("ndvi", "evi", "qual", "reli")


def whole_files(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """``name, content`` of each file."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def band_of(path: str) -> str | None:
    """The first band whose mark is in a band's long name."""
    return next((k for k, mark in BANDS.items() if mark in path), None)


def wants(*bands: str) -> Callable[[str], bool]:
    if unknown := set(bands) - set(BANDS):
        raise ValueError(f"unknown bands: {sorted(unknown)}")
    return lambda path: any(BANDS[b] in path for b in bands)


def tile_of(tile_id: str) -> tuple[int, int]:
    """h and v of a sinusoidal tile id: 5, a digit of resolution, then HHHVVV."""
    if not tile_id.startswith("5"):
        raise ValueError("not a sinusoidal tile")
    return int(tile_id[2:5]), int(tile_id[5:8])


def resolution_of(tile_id: str) -> str:
    return {"1": "1000", "2": "500", "4": "250"}[tile_id[1]]


def chunks_of(values: np.ndarray, size: int) -> list[np.ndarray]:
    """Whole chunks of a raster, row by row; a rest is left out."""
    flat = np.asarray(values).ravel()
    return [flat[k : k + size] for k in range(0, len(flat) - size + 1, size)]


def open_hdf(content: bytes, bands: tuple[str, ...]) -> Iterator[tuple[str, dict[str, str], np.ndarray]]:
    """Band, metadata and values of each wanted band of an HDF file."""
    from osgeo import gdal

    keep = wants(*bands)
    with tempfile.TemporaryDirectory() as folder:
        path = os.path.join(folder, "raster.hdf")
        with open(path, "wb") as f:
            f.write(content)
        names = [v for k, v in gdal.Open(path).GetMetadata_Dict("SUBDATASETS").items() if "_NAME" in k]
        for name in filter(keep, names):
            data = gdal.Open(name)
            yield band_of(name), data.GetMetadata_Dict(), data.GetRasterBand(1).ReadAsArray()


CHUNKS = "dataset string, s_res string, t_res string, date string, h int, v int, chunk int, chunk_size int, data array<int>"


def raster_chunks(files: DataFrame, chunk_size: int, bands: tuple[str, ...] = WANTED, opener: Callable = open_hdf) -> DataFrame:
    """Chunks of the wanted bands of whole files. ``opener`` yields (band, metadata, values) from a file's bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                for band, meta, values in opener(bytes(content), bands):
                    h, v = tile_of(meta["TileID"])
                    parts = chunks_of(values, chunk_size)
                    yield pd.DataFrame({
                        "dataset": band, "s_res": resolution_of(meta["TileID"]), "t_res": G.temporal_res(meta["SHORTNAME"]), "date": meta["RANGEBEGINNINGDATE"],
                        "h": h, "v": v, "chunk": range(len(parts)), "chunk_size": chunk_size, "data": [p.astype(np.int32) for p in parts],
                    })

    return files.select("content").mapInPandas(run, CHUNKS)
