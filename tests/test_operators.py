"""Operators over small tables."""

import gzip
import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from thicket.functions import geo as G
from thicket.functions import periods as P
from thicket.operators import classify, exports, neighbors, pixels, series
from thicket.plans.jobs import JOBS, Workflow, main
from thicket.schema import KEYS, RunParams, pixel_value
from thicket.sources import dims, fires, grids, rain, rasters, store, tiles

KEYED = "s_res string, h int, v int, sample int, line int"
PX = ("500", 28, 8, 0, 0)


def test_tiles(spark):
    assert len(tiles.tile_set("all")) == 77
    assert tiles.tile_set((8, 6), "PHL") == {(30, 7), (29, 7), (30, 8), (29, 8), (8, 6)}
    assert tiles.without_countries(tiles.tile_set("PER"), "BRA") == {(9, 9), (10, 10)}
    assert tiles.tile_glob({(28, 8)}) == "*{h28v08}*" and tiles.glob_string("/a", "*", ["b", "c"]) == "/a/*/{b,c}"
    assert tiles.parse_locations("['IDN', [8, 6]]") == tiles.tile_set("IDN", (8, 6)) and tiles.parse_locations("[8, 6]") == {(8, 6)}
    assert tiles.all_pixels(spark, {(8, 6), (8, 7)}, 3).distinct().count() == 18


def test_versions(spark):
    rows = [("a", 1, 827, [1.0, 2.0, 3.0]), ("a", 10, 828, [11.0]), ("b", 1, 5, [1.0])]
    df = spark.createDataFrame(rows, "id string, pedigree long, start_idx int, s array<double>")
    got = {r.id: (r.start_idx, r.s) for r in series.overlay_versions(df, ["id"], ["s"]).collect()}
    assert got == {"a": (827, [1.0, 11.0, 3.0]), "b": (5, [1.0])}
    gap = spark.createDataFrame([("a", 1, 1, [1.0]), ("a", 2, 5, [2.0])], df.schema)
    with pytest.raises(Exception, match="gap"):
        series.overlay_versions(gap, ["id"], ["s"]).collect()
    assert series.overlay_versions(gap, ["id"], ["s"], consecutive=False).first().s == [1.0, -9999.0, -9999.0, -9999.0, 2.0]


def test_series_and_windows(spark):
    df = spark.createDataFrame([(1, 827, 1), (1, 829, 3)], "id int, p int, v int")
    assert series.to_series(df, ["id"], "p", ["v"], -9999).first().v == [1, -9999, 3]
    px = spark.createDataFrame([(0, 0, 5), (1, 1, 6), (3, 0, 7)], "sample int, line int, val int").withColumn("h", F.lit(1))
    got = {(r.win_col, r.win_row): r.data for r in series.sparse_windows(px, ["h"], 2, 2, "val", 0).collect()}
    assert got == {(0, 0): [5, 0, 0, 6], (1, 0): [0, 7, 0, 0]}
    full = spark.createDataFrame([(s, l, s + 10 * l) for s in range(2) for l in range(2)], "sample int, line int, val int").withColumn("h", F.lit(1))
    assert series.sparse_windows(full, ["h"], 2, 2, "val", 0).first().data == [0, 1, 10, 11]


def test_chunks_to_series(spark):
    rows = [("ndvi", "1000", 8, 6, 0, "2000-01-01", list(range(10))), ("ndvi", "1000", 8, 6, 0, "2000-02-18", list(range(10)))]
    df = spark.createDataFrame(rows, "dataset string, s_res string, h int, v int, chunk int, date string, data array<int>")
    with pytest.raises(Exception, match="whole rows"):
        series.chunks_to_series(df, "16", 10).collect()
    wide = df.withColumn("data", F.concat("data", F.array_repeat(F.lit(0), 1190)))
    got = series.chunks_to_series(wide, "16", 1200).where("sample = 4").first()
    assert (got.start_idx, got.end_idx, got.series, got.line) == (690, 693, [4, -9999, -9999, 4], 0)


def test_chunk_versions(spark):
    """Of versions of a chunk and date the newest counts, whatever order they come in; resolutions have their own places."""
    rows = [
        (2, "ndvi", "1000", 8, 6, 1, "2000-01-01", [7] * 1200), (1, "ndvi", "1000", 8, 6, 1, "2000-01-01", [1] * 1200), (1, "ndvi", "1000", 8, 6, 1, "2000-02-01", [3] * 1200),
        (3, "ndvi", "1000", 8, 6, 1, "2000-01-15", [5] * 1200), (1, "ndvi", "500", 8, 6, 1, "2000-01-01", [4] * 1200),
    ]
    df = spark.createDataFrame(rows, "pedigree long, dataset string, s_res string, h int, v int, chunk int, date string, data array<int>")
    out = series.chunks_to_series(df.where("s_res = '1000'"), "32", 1200).collect()
    assert len(out) == 1200 and {(r.line, tuple(r.series)) for r in out} == {(1, (5, 3))} and {r.sample for r in out} == set(range(1200))
    with pytest.raises(Exception, match="whole rows"):
        series.chunks_to_series(df, "32", 1200).collect()
    both = df.withColumn("data", F.concat("data", "data"))
    found = {(r.s_res, r.sample, r.line) for r in series.chunks_to_series(both, "32", 2400).collect()}
    assert {x for x in found if x[0] == "500"} == {("500", s, 1) for s in range(2400)} and {x[2] for x in found if x[0] == "1000"} == {2, 3}
    plain = df.drop("pedigree").where("s_res = '1000' and date = '2000-01-01'")
    assert {tuple(r.series) for r in series.chunks_to_series(plain, "32", 1200).collect()} == {(7,)}


def test_window_stat(spark):
    """Against every window written out; holes, nulls, a pixel twice, and windows that go over squares."""
    rng = np.random.default_rng(6)
    held = {(int(s), int(l)): None if rng.random() < 0.1 else int(rng.integers(-50, 50)) for s, l in rng.integers(0, 40, (500, 2))}
    rows = [("500", s, l, v) for (s, l), v in held.items()]
    df = spark.createDataFrame([*rows, rows[0]], "s_res string, sample int, line int, val int").repartition(3)
    for radius, side in ((1, 8), (3, 8), (7, 64)):
        out = {(r.sample, r.line): (r.n, r.avg_value, r.min_value, r.max_value) for r in neighbors.window_stat(df, ["s_res"], "val", radius, side).collect()}
        assert set(out) == set(held)
        for (s, l), got in out.items():
            seen = [held[i, j] for i in range(s - radius, s + radius + 1) for j in range(l - radius, l + radius + 1) if held.get((i, j)) is not None]
            assert got == ((len(seen), pytest.approx(sum(seen) / len(seen)), min(seen), max(seen)) if seen else (0, None, None, None))
    assert neighbors.window_stat(df.where("false"), ["s_res"], "val").count() == 0


def test_null_group_is_fitted(spark):
    rng = np.random.default_rng(4)
    rows = [(g, int(rng.random() < 0.4), [1.0, float(x)]) for g in (1, 2, None) for x in rng.normal(size=60)]
    df = spark.createDataFrame(rows, "ecoregion int, hansen int, x array<double>").repartition(4).cache()
    by = {r.ecoregion: r.beta for r in classify.fit_distributed(df, ["ecoregion"], RunParams()).collect()}
    one = {r.ecoregion: r.beta for r in classify.fit(df.fillna(0, ["ecoregion"]), ["ecoregion"], RunParams()).collect()}
    assert set(by) == {1, 2, None} and all(by[g or None] == pytest.approx(b) for g, b in one.items())


def test_fires(spark):
    lines = spark.createDataFrame([("1.0,2.0,331,1,1,2011-03-15,0,A,51,5,1,1",), ("lat,lon,kelvin,1,1,date,0,A,conf,5,1,1",), ("1.0,2.0.1,331,1,1,2011-03-15,0,A,51,5,1,1",), ("1,2,3",), ("",), (None,)], "value string")
    assert fires.parse_new(lines).count() == 1
    assert fires.daily_counts(fires.parse_new(lines)).first().both_preds == 1
    month = spark.createDataFrame([("YYYYMMDD HHMM sat lat lon T21 T31 sample FRP conf",), ("20001101 0000 T 1.0 2.0 330.0 1 1 1 50",)], "value string")
    assert fires.parse_monthly(month).first().date == "2000-11-01"
    daily = spark.createDataFrame([("1.0,2.0,331,1,1,03/15/2011,0,A,51,5,1,1",)], "value string")
    assert fires.parse_daily(daily).first().date == "2011-03-15"
    days = spark.createDataFrame([(f"2000-01-{d:02d}", 1, 1, 1, 1, 1) for d in range(1, 31)], "date string, k int, temp330 int, conf50 int, both_preds int, count int")
    out = series.fire_series(days, ["k"], "16", "2000-01-01", "2000-02-20").first()
    assert [f["count"] for f in out.fires] == [16, 30, 30, 30]
    assert series.aggregate_fires(days, ["k"], "16").orderBy("period").collect()[1]["count"] == 14


def values(spark, rows):
    df = spark.createDataFrame(rows, "sample int, line int, x double, n int")
    f = F.struct(*[F.col("n").alias(c) for c in ("temp330", "conf50", "both_preds", "count")])
    return df.select(F.lit("500").alias("s_res"), F.lit(28).alias("h"), F.lit(8).alias("v"), "sample", "line", F.lit(827).alias("period"), pixel_value(f, F.col("x"), F.col("x"), F.col("x"), F.col("x")).alias("val"))


def test_neighbors(spark):
    out = neighbors.neighbor_values(values(spark, [(0, 0, 1.0, 1), (1, 0, 2.0, 1), (0, 1, 3.0, 1), (1, 1, 4.0, 1)]))
    got = {(r.sample, r.line): r.neighbor for r in out.collect()}
    assert got[0, 0].neighbor_count == 3 and got[0, 0].avg_short_drop == 3.0 and got[0, 0].min_short_drop == 2.0 and got[0, 0].max_param_break == 4.0
    assert got[0, 0].fire["count"] == 3
    borders = neighbors.neighbor_values(values(spark, [(0, 0, 1.0, 1), (1, 0, 2.0, 1)]), window=1)
    assert {r.neighbor.neighbor_count for r in borders.collect()} == {0}
    assert {r.neighbor.neighbor_count for r in neighbors.neighbor_values(values(spark, [(0, 0, 1.0, 1), (1, 0, 2.0, 1)]), window=1, halo=True).collect()} == {1}


def test_neighbor_nodata(spark):
    nd = -9999.0
    fold = lambda rows: {(r.sample, r.line): r.neighbor for r in neighbors.neighbor_values(values(spark, rows)).collect()}
    one = fold([(0, 0, nd, 1), (1, 0, 5.0, 1)])
    assert one[1, 0].avg_short_drop == nd and one[1, 0].neighbor_count == 1  # a single neighbour's nodata stays
    skip = fold([(0, 0, 1.0, 1), (1, 0, 9.0, 0), (2, 0, nd, 1)])
    assert skip[1, 0].neighbor_count == 1 and skip[1, 0].avg_short_drop == 1.0
    two = fold([(0, 0, nd, 1), (1, 0, nd, 1), (1, 1, 3.0, 1)])
    assert two[1, 1].neighbor_count == 0 and two[1, 1].min_short_drop == 0.0


def test_pixel_values(spark):
    dyn = spark.createDataFrame([(*PX, 827, [None, -2.0, -1.0], [1.0, None, 3.0], [1.0, 2.0, 3.0], [None, 5.0, 4.0]), ("500", 28, 8, 1, 0, 827, [1.0, 2.0, 3.0], [1.0] * 3, [1.0] * 3, [1.0] * 3)], f"{KEYED}, start_idx int, short array<double>, `long` array<double>, t_stat array<double>, `break` array<double>")
    days = spark.createDataFrame([("2005-12-20", *PX, 1, 1, 1, 1)], f"date string, {KEYED}, temp330 int, conf50 int, both_preds int, count int")
    f = series.fire_series(days, KEYS, "16", "2005-01-01", "2006-06-01")
    out = {(r.sample, r.period): r.val for r in series.pixel_values(dyn, f, 827, 828).collect()}
    assert sorted(out) == [(0, 827), (0, 828), (1, 827), (1, 828)]
    assert out[0, 827].short_drop == -9999.0 and out[0, 828].short_drop == -2.0 and out[0, 828].long_drop == -9999.0 and out[0, 828].param_break == 5.0
    assert out[0, 827].fire["count"] == 1 and out[1, 827].fire["count"] == 0


def test_static_and_filters(spark):
    layer = lambda v: spark.createDataFrame([(*PX, v)], f"{KEYED}, val int")
    out = pixels.consolidate_static(25, *map(layer, (26, 100, 10101, 40132, 4))).first()
    assert tuple(out)[5:] == (26, 40132, 10101, 100, 4)
    ndvi = spark.createDataFrame([(*PX, 1, [1, 2, 3]), ("500", 28, 8, 1, 0, 1, [-3000, -3000, 3])], f"{KEYED}, start_idx int, ndvi array<int>")
    wet = spark.createDataFrame([(*PX, 1, [0.1, 0.2]), ("500", 28, 8, 1, 0, 1, [0.1, 0.2])], f"{KEYED}, start_idx int, precl array<double>")
    got = pixels.dynamic_filter(ndvi, wet, RunParams(est_start="1970-02-01", t_res="32")).collect()
    assert [(r.ndvi, r.precl) for r in got] == [([1.0, 2.0], [0.1, 0.2])]
    cells = spark.createDataFrame([(*PX, 360, [1.5, 2.5, 3.4, 4.7])], f"{KEYED}, start_idx int, series array<double>")
    grown = pixels.adjust_rain(cells, "32", "16").first()
    assert (grown.start_idx, grown.series) == (690, [2, 2, 3, 3, 3, 4, 5])


def test_rain(spark, tmp_path):
    rows = [("2000-01-01", 0, 0, 1.0), ("2000-03-01", 0, 0, 5.0), ("2000-01-01", 1, 1, -999.0)]
    got = rain.stretched_cells(spark.createDataFrame(rows, "date string, row int, col int, val double"), "16").orderBy("row").collect()
    assert got[0].start_idx == 690 and got[0].series[0] == 1 and got[0].series[-1] == 5 and set(got[1].series) == {0}
    grid = np.full((24, 360, 720), -999, dtype="<f4")
    grid[0, 0, 0], grid[2, 1, 1] = 7.0, 8.0
    (tmp_path / "precl_mon_v1.0.lnx.2001.gri0.5m").write_bytes(gzip.compress(grid.tobytes()))
    read = rain.read_rain(spark, str(tmp_path))
    assert {(r.date, r.row, r.col, r.val) for r in read.where("val > 0").collect()} == {("2001-01-01", 0, 0, 7.0), ("2001-02-01", 1, 1, 8.0)}
    assert read.select("date").distinct().count() == 2
    pix = spark.createDataFrame([(8, 6, 0, 0)], "h int, v int, sample int, line int")
    cell = spark.createDataFrame([("2000-01-01", 239, 489, 100.0)], "date string, row int, col int, val double")
    assert rain.resample(cell, pix, "500", grids.GRIDS["precl"]).first().val == 100.0
    series_ = spark.createDataFrame([(239, 489, 1, [1])], "row int, col int, start_idx int, series array<int>")
    assert rain.explode_cells(series_, "1000", {(6, 6)}).count() == 3600 and rain.explode_cells(series_, "1000", {(9, 6)}).count() == 0


def test_grids_and_rasters(spark, tmp_path):
    (tmp_path / "g.txt").write_text("head\n1 2 x\n3 4 5\n")
    lines = grids.index_lines(spark, str(tmp_path / "g.txt"), 1)
    cells = grids.grid_cells(lines.select(F.concat_ws(" ", "row", "value").alias("value")))
    assert {tuple(r) for r in cells.collect()} == {(0, 0, 1), (0, 1, 2), (1, 0, 3), (1, 1, 4), (1, 2, 5)}
    pix = spark.createDataFrame([(0, 5, 1, 1)], "h int, v int, sample int, line int")
    assert grids.absorb(cells, pix).first().val == 4
    meta = {"TileID": "51008006", "SHORTNAME": "MOD13A3", "RANGEBEGINNINGDATE": "2000-01-01"}
    opener = lambda content, bands: iter([("ndvi", meta, np.arange(2400).reshape(2, 1200))])
    files = spark.createDataFrame([("a", bytearray(b"x"))], "name string, content binary")
    out = rasters.raster_chunks(files, 1200, ("ndvi",), opener).orderBy("chunk").collect()
    assert [(r.chunk, r.data[0], r.s_res, r.t_res, r.h, r.v) for r in out] == [(0, 0, "1000", "32", 8, 6), (1, 1200, "1000", "32", 8, 6)]
    assert rasters.band_of("x NDVI y") == "ndvi" and rasters.wants("ndvi")("a NDVI") and not rasters.wants("evi")("a NDVI")


def test_store_and_dims(spark, tmp_path):
    root = str(tmp_path / "s")
    df = spark.createDataFrame([(*PX, 1, [1.0])], f"{KEYED}, start_idx int, prob array<double>")
    store.append(df, root, "probs", "500", "16", 1)
    store.append(df, root, "probs", "500", "16", 2)
    assert store.read(spark, root, "probs", "500", "16").count() == 2 and store.read(spark, root, "probs", "500", "32").count() == 0
    store.consolidate(spark, root, str(tmp_path / "t"))
    assert store.read_all(spark, str(tmp_path / "t")).count() == 2
    (tmp_path / "eco.txt").write_text('ecoid\tecoregion\tc1\tc2\tregionid\tregion\tpixels\thits\n10101\tx\ta\tb\t21\t"R"\t1000\t2\n')
    eco = dims.read_ecoregions(spark, str(tmp_path / "eco.txt"))
    assert eco.first().hit_share == 0.002 and eco.first().region == "R"
    (tmp_path / "gadm.csv").write_text("iso,objectid,id_0\nAFG,1,5\n")
    assert {(r.objectid, r.iso) for r in dims.read_admin_units(spark, str(tmp_path / "gadm.csv")).collect()} == {(1, "AFG"), (-9999, "UNK")}
    s = spark.createDataFrame([(*PX, 10101)], f"{KEYED}, ecoid int")
    assert pixels.final_ecoregion(s, eco, True).first().ecoregion == 21 and pixels.final_ecoregion(s, eco, False).first().ecoregion == 10101


def test_classify(spark):
    rng = np.random.default_rng(1)
    rows = [(k % 2, int(rng.random() < 0.4), [1.0, float(x)]) for k, x in enumerate(rng.normal(size=200))]
    df = spark.createDataFrame(rows, "ecoregion int, hansen int, x array<double>").cache()
    p = RunParams(ridge=1e-3, max_iter=30)
    a = {r.ecoregion: r.beta for r in classify.fit(df, ["ecoregion"], p).collect()}
    b = {r.ecoregion: r.beta for r in classify.fit_distributed(df, ["ecoregion"], p).collect()}
    assert a[0] == pytest.approx(b[0], rel=1e-5) and a[1] == pytest.approx(b[1], rel=1e-5)
    rows = neighbors.neighbor_values(values(spark, [(0, 0, 1.0, 1)])).withColumn("ecoregion", F.lit(1))
    betas = spark.createDataFrame([(1, [0.0] * 21)], "ecoregion int, beta array<double>")
    assert classify.estimate(rows, betas, RunParams()).first().prob == [0.5]
    with pytest.raises(Exception, match="no coefficients"):
        classify.estimate(rows, betas.where("false"), RunParams()).collect()


def test_exports(spark):
    probs = spark.createDataFrame([(*PX, 827, [0.1, 0.9, 0.9, 0.9], 88500, 1), ("500", 28, 8, 1, 0, 827, [0.1] * 4, 88500, 1), ("500", 28, 8, 2, 0, 827, [0.9] * 4, 5, 1)], f"{KEYED}, start_idx int, prob array<double>, gadm2 int, ecoid int")
    gadm = spark.createDataFrame([(88500, "IDN")], "objectid int, iso string")
    assert [tuple(r) for r in exports.country_stats(probs, gadm, 50, "16", "32").collect()] == [("IDN", 72, "2006-01-01", 1)]
    assert exports.api_first(probs, gadm, "500", "16", 50).count() == 1 and exports.api_long(probs, gadm, "500", "16", 50).count() == 4
    assert exports.download(probs, gadm, "500", 50, "16").first().date == "2006-01-01"
    assert exports.website(probs, gadm, "500", 17, 16, "16", "32", 50).count() == 2
    assert exports.country_stats(probs.where("false"), gadm, 50, "16", "32").count() == 0
    lines = spark.createDataFrame([("101.5,9.9,1",), ("bad",), ("0,90",)], "value string")
    assert exports.hansen_tiles(lines).count() == 1
    errors = pixels.error_counts(spark.createDataFrame([(0, 0.9), (0, 0.1), (1, 0.9), (1, 0.1)], "hansen int, prob double"), 0.5).first()
    assert tuple(errors) == (1, 1, 1, 1, 0.5, 0.5)


def test_workflow(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x").write_text("1")

    def flow(end="1", broken=False):
        w = Workflow(spark, at("_steps"))
        keep = lambda name: (tmp_path / name).mkdir(exist_ok=True)
        w.step("one", at("one"), (), lambda: keep("one"), (at("in"),))
        w.step("two", at("two"), ("one",), lambda: keep("two"), temporary=True)
        w.step("three", at("three"), ("two",), lambda: 1 / 0 if broken else keep("three"), params={"end": end})
        w.step("other", at("other"), (), lambda: keep("other"))
        return w

    assert flow().run() == ["one", "two", "three", "other"] and flow().run() == []
    assert not (tmp_path / "two").exists() and (tmp_path / "three").exists()
    assert flow("2").run() == ["two", "three"]  # a later end needs what is temporary again, and no more
    with pytest.raises(ZeroDivisionError):
        flow("3", broken=True).run()
    assert flow("3").run() == ["three"]  # what ended well before the failure stays
    (tmp_path / "in" / "y").write_text("2")
    assert flow("3").run() == ["one", "two", "three"]
    (tmp_path / "other").rmdir()
    assert flow("3").run() == ["other"]
    with pytest.raises(ValueError):
        flow().step("x", None, ("nothing",), lambda: None)
    with pytest.raises(SystemExit):
        main(["no-such-job"])
    assert {"update", "gen_betas", "api", "preprocess_rain", "run_config"} <= set(JOBS)


def test_steps_side_by_side(spark, tmp_path):
    import threading

    met = threading.Barrier(2, timeout=30)
    w = Workflow(spark, str(tmp_path / "_steps"))
    for name in ("a", "b"):
        w.step(name, None, (), met.wait)  # each waits for the other
    assert w.run() == ["a", "b"]


def test_update_chain(spark, tmp_path):
    """The whole chain over four pixels, then once more: nothing is left to do."""
    rng = np.random.default_rng(2)
    px = [("500", 28, 8, s, l) for s in range(2) for l in range(2)]
    at = lambda n: str(tmp_path / n)
    save = lambda rows, schema, n: spark.createDataFrame(rows, schema).write.parquet(at(n))
    n = 140
    save([(*p, 700, rng.normal(5000, 200, n).tolist()) for p in px], f"{KEYED}, start_idx int, ndvi array<double>", "ndvi")
    save([(*p, 700, rng.normal(5, 1, n).tolist()) for p in px], f"{KEYED}, start_idx int, precl array<double>", "rain")
    save([(*p, 30, 7, 10101, 1, 5) for p in px], f"{KEYED}, vcf int, gadm int, ecoid int, hansen int, coast_dist int", "static")
    save([(*p, 88500) for p in px], f"{KEYED}, gadm2 int", "gadm2")
    save([("2005-12-20", *px[0], 1, 1, 1, 1)], f"date string, {KEYED}, temp330 int, conf50 int, both_preds int, count int", "daily")
    series.fire_series(spark.read.parquet(at("daily")), KEYS, "16", "2000-11-01", "2006-06-01").write.parquet(at("fires"))
    save([("500", 10101, [3.0] + [0.0] * 20)], "s_res string, ecoregion int, beta array<double>", "betas")
    (tmp_path / "gadm.csv").write_text("iso,objectid\nIDN,88500\n")
    args = (spark, at("work"), at("ndvi"), at("rain"), at("static"), at("gadm2"), at("gadm.csv"), at("fires"), at("betas"), "2006-02-15")
    ran = JOBS["update"](*args)
    assert len(ran) == 15
    assert spark.read.csv(at("work/download"), sep="\t").count() == 4
    assert JOBS["update"](*args) == [] and not (tmp_path / "work" / "filtered").exists()
    # A later period: what it does not touch stays, and both versions of trends and probabilities are kept.
    later = JOBS["update"](*args[:-1], "2006-03-20")
    assert "adjust" not in later and "filter" not in later and {"trends", "values", "estimate", "website"} <= set(later)
    assert len(store.manifests(spark, at("work/store-trends"))) == 2
    merged = spark.read.parquet(at("work/merged-trends")).first()
    assert merged.start_idx + len(merged.short) - 1 == P.period_of("2006-03-20", "16")
    (tmp_path / "config.json").write_text(json.dumps({"paths": {"work": at("work"), "ndvi": at("ndvi"), "rain_series": at("rain"), "static": at("static"), "gadm2": at("gadm2"), "gadm": at("gadm.csv"), "fires_path": at("fires"), "betas": at("betas")}, "period": {"est_end": "2006-02-15"}}))
    assert JOBS["run_config"](spark, str(tmp_path / "config.json"), "2006-03-20") == []
    (tmp_path / "config.json").write_text(json.dumps({"no_such": 1}))
    with pytest.raises(ValueError):
        JOBS["run_config"](spark, str(tmp_path / "config.json"))


def test_update_from_raw_files(spark, tmp_path):
    """Rasters, rain grids and fire text through the whole chain, with coefficients learned in it."""
    at = lambda n: str(tmp_path / n)
    rng, width = np.random.default_rng(3), 1200
    dates = [str(P.start_of(P.period_of("2004-01-01", "32") + k, "32")) for k in range(30)]
    (tmp_path / "hdf").mkdir()
    for d in dates:
        (tmp_path / "hdf" / f"{d}.hdf").write_bytes(d.encode())

    def opener(content, bands):
        values = np.random.default_rng(int(content[-5:-3]) + int(content[:4])).integers(4000, 6000, (2, width))
        yield "ndvi", {"TileID": "51028008", "SHORTNAME": "MOD13A3", "RANGEBEGINNINGDATE": content.decode()}, values

    (tmp_path / "rain").mkdir()
    for year in (2004, 2005, 2006):
        grid = np.full((24, 360, 720), -999, dtype="<f4")
        grid[::2, 180:200] = rng.uniform(1, 9, (12, 20, 720))
        (tmp_path / "rain" / f"precl_{year}").write_bytes(gzip.compress(grid.tobytes(), 1))
    keep = [("1000", 28, 8, s, l) for s in range(6) for l in range(2)]
    lat, lon = spark.createDataFrame([keep[0]], KEYED).select(*[G.pixel_to_latlon("1000", "h", "v", "sample", "line")[x] for x in ("lat", "lon")]).first()
    lines = ["latitude,longitude,x", f"{lat:.5f},{lon:.5f},340,1,1,2005-12-20,0,A,80,5,1,1", "1.2.3,4,5"]
    (tmp_path / "fires.txt").write_text("\n".join(lines))
    spark.createDataFrame([(*p, 30, 7, 10101, int(p[3] % 2), 5) for p in keep], f"{KEYED}, vcf int, gadm int, ecoid int, hansen int, coast_dist int").write.parquet(at("static"))
    spark.createDataFrame([(*p, 88500) for p in keep], f"{KEYED}, gadm2 int").write.parquet(at("gadm2"))
    (tmp_path / "gadm.csv").write_text("iso,objectid\nIDN,88500\n")
    run = lambda end="2006-05-01": JOBS["update"](
        spark, at("work"), None, None, at("static"), at("gadm2"), at("gadm.csv"), None, None, end, est_start="2005-12-01", s_res="1000", t_res="32",
        raster_source=at("hdf"), rain_source=at("rain"), fires_source=at("fires.txt"), chunk_size=str(width), opener=opener,
    )
    ran = run()
    assert {"rasters", "ndvi", "rain", "fires", "training", "betas", "estimate", "website"} <= set(ran) and len(ran) == 21
    read = spark.read.parquet
    assert read(at("work/ndvi")).count() == 2 * width and read(at("work/ndvi")).first().ndvi[0] >= 4000
    assert read(at("work/fires")).count() == 1 and {r.value for r in spark.read.text(at("work/fires-rejected")).collect()} == {lines[0], lines[2]}
    assert read(at("work/betas")).count() == 1 and all(0 <= p <= 1 for r in read(at("work/estimated")).collect() for p in r.prob)
    assert read(at("work/estimated")).count() == len(keep)
    assert run() == []
    # A raster sent again, with other values: only it is read, its chunk counts, and rain and fires are left alone where they can be.
    before = read(at("work/ndvi")).orderBy("line", "sample").first().ndvi
    sent = tmp_path / "hdf" / "again.hdf"
    sent.write_bytes(dates[3].encode().replace(b"2004", b"2004"))
    opened = []
    first_opener = opener

    def opener(content, bands):  # noqa: F811
        opened.append(content)
        for band, meta, values in first_opener(content, bands):
            yield band, meta, values + 7

    again = JOBS["update"](
        spark, at("work"), None, None, at("static"), at("gadm2"), at("gadm.csv"), None, None, "2006-05-01", est_start="2005-12-01", s_res="1000", t_res="32",
        raster_source=at("hdf"), rain_source=at("rain"), fires_source=at("fires.txt"), chunk_size=str(width), opener=opener,
    )
    after = read(at("work/ndvi")).orderBy("line", "sample").first().ndvi
    assert "fires" not in again and {"rasters", "ndvi", "filter", "trends"} <= set(again)
    assert [b - a for a, b in zip(before, after, strict=True)] == [7 * (k == 3) for k in range(len(before))]
    assert sorted(len(m["sources"]) for m in store.manifests(spark, at("work/chunks")).values()) == [1, 30]


def test_layers_in_the_store(spark, tmp_path):
    """Static layers and rain as stored chunks, and back to pixels."""
    root, px = str(tmp_path / "store"), str(tmp_path / "px")
    pix = spark.createDataFrame([("1000", 28, 8, s, l) for s in range(1200) for l in range(2)], KEYED)
    pix.write.parquet(px)
    (tmp_path / "g.txt").write_text("\n".join(" ".join(str(c + 10 * r) for c in range(5)) for r in range(2)))
    tile = spark.createDataFrame([("1000", 0, 5, s, l) for s in range(5) for l in range(2)], KEYED)
    tile.write.parquet(str(tmp_path / "t"))
    JOBS["preprocess_ascii"](spark, "gadm", str(tmp_path / "g.txt"), str(tmp_path / "t"), root, s_res="1000", chunk_size="1200")
    JOBS["explode_static"](spark, root, "gadm", str(tmp_path / "out"), s_res="1000", chunk_size="1200")
    assert {(r["sample"], r.line, r.val) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(c, r, c + 10 * r) for c in range(5) for r in range(2)}
    cells = pix.withColumn("c", G.pixel_to_cell("1000", grids.GRIDS["vcf"], "h", "v", "sample", "line")).select("c.row", "c.col").distinct().withColumn("val", (F.col("row") + F.col("col")) % 50)
    fine = grids.static_layer(cells, pix, "1000", "vcf")
    down = grids.downsample(cells, pix, "1000", grids.GRIDS["vcf"], "sum")
    assert fine.count() == down.count() > 0 and fine.agg(F.max("val")).first()[0] < 50 <= down.agg(F.max("val")).first()[0] + 50
    coarse = pix.withColumn("c", G.pixel_to_cell("1000", grids.GRIDS["precl"], "h", "v", "sample", "line")).select("c.row", "c.col").distinct()
    up = grids.static_layer(coarse.withColumn("val", F.col("col").cast("int")), pix, "1000", "precl")
    assert up.count() == pix.count()
    month = coarse.select(F.lit("2001-02-01").alias("date"), "row", "col", (F.col("col") * 1.5).alias("val"))
    chunks = rain.rain_chunks(month, pix, "1000", 1200).collect()
    assert [len(r.data) for r in chunks] == [1200, 1200] and {r.date for r in chunks} == {"2001-02-01"}
    assert sum(chunks[0].data) + sum(chunks[1].data) == pytest.approx(rain.resample(month, pix, "1000", grids.GRIDS["precl"]).agg(F.sum("val")).first()[0])


def test_consolidate_spreads(spark, tmp_path):
    df = spark.range(400).select(F.col("id").alias("x")).repartition(8)
    store.append(df, str(tmp_path / "s"), "probs", "500", "16", 1)
    for files in (1, 4):
        store.consolidate(spark, str(tmp_path / "s"), str(tmp_path / f"t{files}"), files)
        out = store.read_all(spark, str(tmp_path / f"t{files}"))
        assert out.count() == 400 and 1 <= len(out.inputFiles()) <= files
    assert len(out.inputFiles()) > 1
    store.absorb(spark, str(tmp_path / "s"), str(tmp_path / "t1"))
    assert store.read(spark, str(tmp_path / "t1"), "probs", "500", "16").count() == 800


def test_lines_are_numbered_whatever_the_split(spark, tmp_path):
    (tmp_path / "g.txt").write_text("".join(f"{k}\n" for k in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        lines = grids.index_lines(spark, str(tmp_path / "g.txt"), 1)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.row == int(r.value) - 1 for r in lines.collect()} == {True} and lines.count() == 2999


def test_fire_windows_by_period(spark, tmp_path):
    from thicket.streaming.updates import fire_windows

    rows = [(1, "2024-01-02 10:00:00", 340.0, 60.0), (1, "2024-01-09 10:00:00", 320.0, 40.0), (1, "2024-01-20 00:00:00", 350.0, 10.0), (2, "2024-01-02 00:00:00", 1.0, None)]
    spark.createDataFrame(rows, "k int, ts string, kelvin double, conf double").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k int, ts timestamp, kelvin double, conf double").parquet(str(tmp_path / "in"))
    q = fire_windows(stream, ["k"]).writeStream.format("memory").queryName("fire_windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(90)
    start = P.period_of("2024-01-01", "16")
    assert {tuple(r) for r in spark.table("fire_windows").collect()} == {(1, start, 1, 1, 1, 2), (1, start + 1, 1, 0, 0, 1), (2, start, 0, 0, 0, 0)}


def test_neighbors_travel_once(spark, tmp_path):
    """One exchange of one row a pixel; windows and blocks against a look at every pair."""
    rng = np.random.default_rng(5)
    some = sorted({(int(a), int(b)) for a, b in rng.integers(0, 14, (90, 2))})
    values(spark, [(s, l, float(7 * s + l), 1) for s, l in some]).write.parquet(str(tmp_path / "v"))
    df = spark.read.parquet(str(tmp_path / "v"))
    for window, halo in ((5, False), (5, True), (600, False)):
        out = neighbors.neighbor_values(df, window, halo)
        text = plan(out).split("Physical Plan")[1].split("== Initial Plan ==")[-1]
        assert text.count("Exchange hashpartitioning") == 1
        for r in out.collect():
            near = [(s, l) for s, l in some if (s, l) != (r["sample"], r.line) and abs(s - r["sample"]) <= 1 and abs(l - r.line) <= 1 and (halo or (s // window, l // window) == (r["sample"] // window, r.line // window))]
            assert r.neighbor.neighbor_count == len(near)
            if near:
                assert r.neighbor.min_short_drop == min(7 * s + l for s, l in near)
    for side in (4, 64):
        out = neighbors.window_stat(df.withColumn("x", F.col("val.short_drop")), ["h", "v"], "x", 2, side)
        for r in out.collect():
            near = [7 * s + l for s, l in some if abs(s - r["sample"]) <= 2 and abs(l - r.line) <= 2]
            assert (r.n, r.min_value, r.max_value) == (len(near), min(near), max(near))
        assert out.count() == len(some)


def test_stream(spark, tmp_path):
    from thicket.streaming.updates import stream_versions

    schema = f"{KEYED}, start_idx int, prob array<double>"
    spark.createDataFrame([(*PX, 1, [1.0])], schema).write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        stream_versions(spark, str(tmp_path / "in"), schema, str(tmp_path / "root"), "probs", "500", "16", str(tmp_path / "cp"), 3).awaitTermination(60)
    assert store.read(spark, str(tmp_path / "root"), "probs", "500", "16").count() == 1


def test_small_files(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("ids.txt", "10101\n x \n\n10102 \n")
        z.writestr("units.csv", "iso,id,more\nIDN,88500,x\nMYS,none\nBRA,7\n")
    ids, units = dims.unzip(str(tmp_path / "a.zip"), str(tmp_path / "out"))
    assert sorted(r.ecoid for r in dims.read_ids(spark, ids).collect()) == [10101, 10102]
    assert sorted(tuple(r) for r in dims.read_admin_map(spark, units).collect()) == [(7, "BRA"), (88500, "IDN")]
    df = spark.createDataFrame([(1, 10101), (2, 3), (3, None)], "x int, ecoid int")
    assert [r.x for r in dims.in_region(df, dims.read_ids(spark, ids)).collect()] == [1]
    assert tiles.tiles_frame(spark, {(28, 8), (8, 6)}).collect() == [(8, 6), (28, 8)]


def test_versions_are_whole(spark, tmp_path, monkeypatch):
    """A crash between data and manifest leaves nothing to be read; the same version sent again is one version."""
    root = str(tmp_path / "s")
    two = spark.createDataFrame([("ndvi", 1), ("evi", 2)], "dataset string, x int").withColumns({"s_res": F.lit("500"), "t_res": F.lit("16")})
    seen = lambda: sorted(r.x for r in store.read_all(spark, root).collect())
    assert store.append_all(two, root, 1, "a") and seen() == [1, 2]
    with monkeypatch.context() as m:
        m.setattr(store.files, "write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.append_all(two.withColumn("x", F.col("x") + 10), root, 2, "b")
    assert (tmp_path / "s" / "dataset=evi" / "res=500-16" / "version=v-b").exists() and seen() == [1, 2]
    assert store.append_all(two.withColumn("x", F.col("x") + 20), root, 2, "b") and seen() == [1, 2, 21, 22]
    assert not store.append_all(two, root, 3, "b") and seen() == [1, 2, 21, 22]


def test_replayed_batch(spark, tmp_path):
    from thicket.streaming.updates import commit_batches

    add = commit_batches(str(tmp_path / "s"), "probs", "500", "16", "stream")
    batch = spark.createDataFrame([(1,), (2,)], "x int")
    for epoch in (0, 0, 1, 1, 0):
        add(batch, epoch)
    assert store.read(spark, str(tmp_path / "s"), "probs", "500", "16").count() == 4


def test_newest_values_as_a_stream(spark, tmp_path):
    """Versions in any order, one of them twice, give what the overlay of all of them gives."""
    from thicket.streaming.updates import newest_values

    schema = "k int, pedigree long, start_idx int, s array<double>, u array<double>"
    versions = [(1, 5, 800, [1.0, 2.0, 3.0], [0.0] * 3), (1, 7, 801, [20.0, 30.0], [1.0] * 2), (1, 6, 800, [11.0, 12.0, 13.0, 14.0], [2.0] * 4), (1, 5, 800, [1.0, 2.0, 3.0], [0.0] * 3), (2, 1, 803, [9.0], [3.0])]
    (tmp_path / "in").mkdir()
    for k, v in enumerate(versions):
        spark.createDataFrame([v], schema).coalesce(1).write.parquet(str(tmp_path / f"one{k}"))
        next((tmp_path / f"one{k}").glob("part-*.parquet")).rename(tmp_path / "in" / f"{k}.parquet")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found = newest_values(source, ["k"], ["s", "u"], "16", "3650 days")
    found.writeStream.outputMode("complete").format("memory").queryName("newest").trigger(availableNow=True).start().awaitTermination(120)
    want = series.overlay_versions(spark.createDataFrame(versions, schema), ["k"], ["s", "u"])
    rows = {(r.k, r.period): (r.s, r.u) for r in spark.table("newest").collect()}
    assert rows == {(r.k, r.start_idx + i): (a, b) for r in want.collect() for i, (a, b) in enumerate(zip(r.s, r.u, strict=True))}
    ended = newest_values(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), ["k"], ["s", "u"], "16", "1 day")
    ended.writeStream.outputMode("append").format("memory").queryName("final").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
    assert {r.period for r in spark.table("final").collect()} <= {800, 801, 802}  # the last period stays open


def test_trap(spark, tmp_path):
    from thicket.sources import fires, trap

    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "x int, good boolean")
    good, bad = trap.split(df, F.col("good"))
    assert [r.x for r in good.collect()] == [1] and sorted(r.x for r in bad.collect()) == [2, 3] and good.columns == bad.columns == df.columns
    lines = ["10.5,20.5,340,1,1,2005-12-20,0,A,80,5,1,1", "10.5,20.5,hot,1,1,2005-12-20,0,A,80,5,1,1", "lat,lon", ""]
    good, bad = fires.parse_trapped(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert [tuple(r) for r in good.select("date", "lat", "kelvin").collect()] == [("2005-12-20", 10.5, 340.0)] and sorted(r.value for r in bad.collect()) == sorted(lines[1:])
    cells, bad = grids.grid_cells_trapped(spark.createDataFrame([("0 1 2",), ("1 x 4",), ("y 1",)], "value string"))
    assert sorted(tuple(r) for r in cells.collect()) == [(0, 0, 1), (0, 1, 2), (1, 1, 4)] and bad.count() == 2
    empty = trap.split(df.where("false"), F.col("good"))
    assert [x.count() for x in empty] == [0, 0]


def test_rain_is_read_by_month(spark, tmp_path):
    for year in (2004, 2005):
        grid = np.full((24, 360, 720), -999, dtype="<f4")
        grid[::2] = np.arange(12)[:, None, None] + year
        (tmp_path / f"precl_{year}").write_bytes(gzip.compress(grid.tobytes(), 1) if year == 2004 else grid.tobytes())
    (tmp_path / "notes").write_text("no rain")
    (tmp_path / "precl_2006").write_bytes(b"short")
    df = rain.read_rain(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() == 36
    read = lambda *span: rain.read_rain(spark, str(tmp_path), first=span[0], last=span[1])
    june = read("2005-06-01", "2005-06-01")
    assert june.rdd.getNumPartitions() == 1 and june.count() == 360 * 720 and june.agg(F.max("val")).first()[0] == 2010
    late = read("2004-11-01", "2005-01-31")
    assert late.rdd.getNumPartitions() == 3 and sorted(r.date for r in late.select("date").distinct().collect()) == ["2004-11-01", "2004-12-01", "2005-01-01"]
    assert df.groupBy("date").count().count() == 24 and read("1999-01-01", "1999-12-01").count() == 0
    assert sorted(r.reason for r in rain.bad_files(spark, str(tmp_path)).collect()) == ["no year in the name", "not of whole months"]


def plan(df):
    return df._jdf.queryExecution().toString()


def test_plans(spark, tmp_path):
    """Tile filters and column choices reach the scan; a dense series takes one exchange; store filters prune folders."""
    root = str(tmp_path / "px")
    spark.range(50).select(F.lit("500").alias("s_res"), F.lit(28).alias("h"), F.lit(8).alias("v"), F.col("id").cast("int").alias("sample"), F.lit(0).alias("line"), F.lit(827).alias("p"), F.lit(1.5).alias("val"), F.lit("x").alias("unused")).write.parquet(root)
    df = spark.read.parquet(root)
    screened = plan(pixels.screen_tiles(df, {(28, 8)}).select("sample", "val"))
    assert "In(h, [28])" in screened.replace("EqualTo(h,28)", "In(h, [28])") and "unused" not in screened.split("Physical Plan")[1]
    dense = plan(series.to_series(df, KEYS, "p", ["val"], 0.0)).split("Physical Plan")[1]
    assert dense.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1
    store.append(df.select(*KEYS, "p", "val"), str(tmp_path / "st"), "probs", "500", "16", 1)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    assert re.search(r"PartitionFilters: \[[^\]]*dataset#\d+ = probs", plan(store.read(spark, str(tmp_path / "st"), "probs", "500", "16")))
