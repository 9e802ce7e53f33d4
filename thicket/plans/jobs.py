"""Jobs over stored tables, a chain of them that redoes what its inputs or parameters change, and a command line.

Tables are Parquet folders. ``python -m thicket.plans.jobs JOB --option value ...`` runs one; ``update`` runs the chain.
"""

from __future__ import annotations

import argparse
import hashlib
import inspect
import json
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files
from ..functions import periods as P
from ..operators import classify, exports, neighbors, pixels, series, trends
from ..schema import KEYS, NODATA, run_params
from ..session import share_package
from ..sources import dims, fires, grids, rain, rasters, store, tiles

JOBS: dict[str, Callable] = {}


def job(f):
    JOBS[f.__name__] = f
    return f


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


# --- preparing inputs ---


@job
def preprocess_modis(spark, source, root, locations="all", chunk_size="24000", opener=rasters.open_hdf):
    """Rasters to chunks in the store, in one partitioned write. Files that an earlier version of the store was made of, of the
    same length and time, are not read again."""
    known = {f for m in store.manifests(spark, root).values() for f in m.get("sources", [])}
    new = [f for f in files.listing(spark, source) if f not in known]
    if not new:
        return
    paths = [f.rsplit(" ", 2)[0] for f in new]
    rows = rasters.whole_files(spark, paths, tiles.tile_glob(tiles.parse_locations(locations)) if locations != "all" else None)
    version = hashlib.sha256("\n".join(new).encode()).hexdigest()[:32]
    store.append_all(rasters.raster_chunks(rows, int(chunk_size), opener=opener), root, version=version, sources=new)


@job
def preprocess_rain(spark, source, output, t_res="16"):
    """Binary rain grids to stretched cell series."""
    _write(rain.stretched_cells(rain.read_rain(spark, source), t_res), output)


@job
def explode_rain(spark, cells, output, s_res="500", locations="all"):
    """Cell series to pixel series, 15 tasks a tile."""
    chosen = tiles.parse_locations(locations)
    _write(rain.explode_cells(spark.read.parquet(cells).repartition(15 * len(chosen)), s_res, chosen), output)


@job
def rain_pixels(spark, source, pixels_path, output, s_res="500", t_res="16", rejects=None):
    """Binary rain grids to series at the pixels of ``pixels_path``. Cells without a pixel are left out first; files that are
    no rain grids are named in ``rejects``, if given."""
    if rejects:
        rain.bad_files(spark, source).write.mode("overwrite").csv(rejects, sep="\t")
    found = rain.series_at(rain.read_rain(spark, source), spark.read.parquet(pixels_path), s_res, t_res)
    _write(found.select(*KEYS, "start_idx", F.col("series").alias("precl")), output)


@job
def rain_chunks(spark, source, pixels_path, root, s_res="500", chunk_size="24000", pedigree=None):
    """Binary rain grids to monthly chunks in the store."""
    chunks = rain.rain_chunks(rain.read_rain(spark, source), spark.read.parquet(pixels_path), s_res, int(chunk_size))
    store.append_all(chunks, root, pedigree)


@job
def preprocess_static(spark, dataset, source, pixels_path, root, s_res="500", drop="0", chunk_size="24000", rejects=None):
    """An ASCII layer at the pixels of ``pixels_path``, as chunks in the store: cover and coast by maximum, loss by sum. Lines
    with anything but whole numbers go to ``rejects``, if given."""
    lines = grids.index_lines(spark, source, int(drop)).select(F.concat_ws(" ", "row", "value").alias("value"))
    cells, bad = grids.grid_cells_trapped(lines)
    if rejects:
        bad.write.mode("overwrite").text(rejects)
    layer = grids.static_layer(cells, spark.read.parquet(pixels_path), s_res, dataset, "sum" if dataset == "hansen" else "max")
    store.append_all(grids.layer_chunks(layer, dataset, s_res, int(chunk_size)), root)


@job
def preprocess_ascii(spark, dataset, source, pixels_path, root, s_res="500", drop="0", chunk_size="24000", first_row="5"):
    """An ASCII layer that is already in sinusoidal pixels, as chunks in the store."""
    lines = grids.index_lines(spark, source, int(drop)).select(F.concat_ws(" ", "row", "value").alias("value"))
    layer = grids.absorb(grids.grid_cells(lines), spark.read.parquet(pixels_path), s_res, int(first_row))
    store.append_all(grids.layer_chunks(layer, dataset, s_res, int(chunk_size)), root)


@job
def explode_static(spark, root, dataset, output, s_res="500", chunk_size="24000"):
    """A layer's stored chunks to pixel rows; what the layer does not know is left out."""
    chunks = store.read(spark, root, dataset, s_res, "00").withColumn("s_res", F.lit(s_res))
    rows = series.blossom_chunks(chunks, ["s_res", "h", "v"], s_res, int(chunk_size))
    _write(rows.where(F.col("val") != int(NODATA)), output)


@job
def preprocess_fires(spark, source, output, end_date, s_res="500", t_res="16", first_date="2000-11-01", locations="all", rejects=None):
    """Fire text to running sums by pixel up to ``end_date``; lines that are no detection go to ``rejects``, if given."""
    good, bad = fires.parse_trapped(spark.read.text(source))
    if rejects:
        bad.write.mode("overwrite").text(rejects)
    found = fires.located(good, s_res, tiles.parse_locations(locations))
    _write(series.fire_series(series.fire_counts(found, [*KEYS, "date"]), KEYS, t_res, first_date, end_date), output)


@job
def modis_timeseries(spark, root, dataset, output, s_res="500", t_res="16", chunk_size="24000"):
    """Stored chunks to pixel series."""
    chunks = store.read(spark, root, dataset, s_res, t_res).withColumns({"dataset": F.lit(dataset), "s_res": F.lit(s_res)})
    _write(series.chunks_to_series(chunks, t_res, int(chunk_size)), output)


# --- the model ---


@job
def timeseries_filter(spark, ndvi, static, output, s_res="500", t_res="16"):
    p = run_params(s_res, t_res)
    _write(pixels.filter_covered(spark.read.parquet(ndvi), spark.read.parquet(static), p.vcf_limit), output)


@job
def adjust_series(spark, ndvi, precl, output, s_res="500", t_res="16", est_start=None):
    _write(pixels.dynamic_filter(spark.read.parquet(ndvi), spark.read.parquet(precl), run_params(s_res, t_res, est_start)), output)


@job
def trends_series(spark, dynamic, output, est_end, s_res="500", t_res="16", est_start=None):
    _write(trends.analyze_trends(spark.read.parquet(dynamic), run_params(s_res, t_res, est_start, est_end)), output)


@job
def trends_store(spark, trends_path, root, s_res="500", t_res="16", pedigree=None, version=None):
    store.append(spark.read.parquet(trends_path), root, "trends", s_res, t_res, pedigree, version)


@job
def merge_trends(spark, root, output, s_res="500", t_res="16"):
    _write(series.overlay_versions(store.read(spark, root, "trends", s_res, t_res), KEYS, ["short", "long", "t_stat", "break"]), output)


@job
def pixel_values(spark, dynamic, fires_path, output, est_end, s_res="500", t_res="16", est_start=None):
    p = run_params(s_res, t_res, est_start, est_end)
    _write(series.pixel_values(spark.read.parquet(dynamic), spark.read.parquet(fires_path), P.period_of(p.est_start, t_res), P.period_of(p.est_end, t_res)), output)


@job
def neighbor_values(spark, values, output, s_res="500", t_res="16", halo=""):
    _write(neighbors.neighbor_values(spark.read.parquet(values), run_params(s_res, t_res).window, bool(halo)), output)


@job
def beta_data(spark, values, static, output, s_res="500", t_res="16", est_start=None, regions=None):
    known = dims.read_ecoregions(spark, regions) if regions else None
    _write(pixels.training_rows(spark.read.parquet(values), spark.read.parquet(static), run_params(s_res, t_res, est_start), known), output)


@job
def gen_betas(spark, rows, output, s_res="500", t_res="16"):
    """Coefficients by ecoregion; groups of any size."""
    training = spark.read.parquet(rows).withColumn("x", classify.features())
    _write(classify.fit_distributed(training, ["s_res", "ecoregion"], run_params(s_res, t_res)), output)


@job
def estimate(spark, betas, values, static, output, s_res="500", t_res="16", regions=None):
    p = run_params(s_res, t_res)
    rows = pixels.estimable(spark.read.parquet(values), p.nodata).join(spark.read.parquet(static).select(*KEYS, "ecoid"), KEYS)
    known = dims.read_ecoregions(spark, regions) if regions else None
    _write(classify.estimate(pixels.final_ecoregion(rows, known, known is not None), spark.read.parquet(betas), p), output)


@job
def probs_store(spark, probs, root, s_res="500", t_res="16", pedigree=None, version=None):
    store.append(spark.read.parquet(probs), root, "probs", s_res, t_res, pedigree, version)


@job
def merge_probs(spark, root, output, s_res="500", t_res="16"):
    _write(series.overlay_versions(store.read(spark, root, "probs", s_res, t_res), KEYS, ["prob"]), output)


@job
def probs_admin(spark, probs, gadm2, static, output):
    _write(pixels.with_admin(spark.read.parquet(probs), spark.read.parquet(gadm2), spark.read.parquet(static)), output)


# --- exports, as tab-separated text ---


@job
def website(spark, probs, gadm, output, s_res="500", t_res="16", t_res_out="32", zoom="17", min_zoom="7", threshold="50"):
    p = run_params(s_res, t_res)
    store.write_text(exports.website(spark.read.parquet(probs), dims.read_admin_units(spark, gadm), s_res, int(zoom), int(min_zoom), t_res, t_res_out, int(threshold), p.discounts), output)


@job
def located_series(spark, probs, static, gadm, output, s_res="500", t_res="16"):
    store.write_text(exports.located_series(spark.read.parquet(probs), spark.read.parquet(static), dims.read_admin_units(spark, gadm), s_res, run_params(s_res, t_res).discounts), output)


@job
def download(spark, probs, gadm, output, s_res="500", t_res="16", threshold="50"):
    store.write_text(exports.download(spark.read.parquet(probs), dims.read_admin_units(spark, gadm), s_res, int(threshold), t_res, run_params(s_res, t_res).discounts), output)


@job
def labelled_series(spark, probs, static, output, s_res="500"):
    store.write_text(exports.labelled_series(spark.read.parquet(probs), spark.read.parquet(static), s_res), output)


@job
def api(spark, kind, probs, gadm, output, s_res="500", t_res="16", threshold="50"):
    """``long`` by country and year, ``first`` and ``latest`` by country, under output/api/pantropical/threshold."""
    query = {"long": exports.api_long, "first": exports.api_first, "latest": exports.api_latest}[kind]
    out = query(spark.read.parquet(probs), dims.read_admin_units(spark, gadm), s_res, t_res, int(threshold))
    store.write_text(out, f"{output}/api/pantropical/{threshold}", ["iso_extra", "year"] if kind == "long" else ["iso_extra"])


# --- the chain ---


@dataclass
class Step:
    name: str
    output: str | None
    needs: tuple[str, ...]
    run: Callable
    inputs: tuple[str, ...]
    params: dict
    temporary: bool
    fingerprint: str = ""


@dataclass
class Workflow:
    """Named steps, each after what it needs, those that need nothing of each other side by side.

    A step's fingerprint is made of its name and parameters, of the files of its inputs (their names, lengths and times), and
    of the fingerprints of the steps that it needs. It is kept under ``marks`` once the step has ended well. A step runs when
    its fingerprint is a new one or its output has gone: so a second run with a later period, or with new files, redoes what
    depends on them and nothing else. Outputs of ``temporary`` steps are removed when all has ended well; such a step runs
    again only if one that needs it does.
    """

    spark: SparkSession
    marks: str
    at_once: int = 4
    steps: dict[str, Step] = field(default_factory=dict)

    def step(self, name: str, output: str | None, needs: tuple[str, ...], run: Callable, inputs: tuple = (), params: dict | None = None, temporary: bool = False) -> None:
        if unknown := set(needs) - set(self.steps):
            raise ValueError(f"{name} needs unknown steps {sorted(unknown)}")
        self.steps[name] = Step(name, output, needs, run, tuple(x for x in inputs if x), params or {}, temporary)

    def _sign(self) -> None:
        for s in self.steps.values():  # in an order in which needs come first
            held = [s.name, s.params, [files.listing(self.spark, x) for x in s.inputs], [self.steps[n].fingerprint for n in s.needs]]
            s.fingerprint = hashlib.sha256(json.dumps(held, sort_keys=True).encode()).hexdigest()

    def stale(self) -> list[str]:
        """The steps that have to run, in order."""
        self._sign()
        there = {s.name: s.output is None or files.exists(self.spark, s.output) for s in self.steps.values()}
        out = {s.name for s in self.steps.values() if files.read(self.spark, f"{self.marks}/{s.name}") != s.fingerprint or not there[s.name] and not s.temporary}
        for s in self.steps.values():
            if set(s.needs) & out and not all(self.steps[n].temporary and n not in out for n in s.needs):
                out.add(s.name)
        for s in reversed(self.steps.values()):  # what a step needs and is not there any more
            if s.name in out:
                out |= {n for n in s.needs if not there[n]}
        return [n for n in self.steps if n in out]

    def _one(self, s: Step) -> None:
        s.run()
        files.write(self.spark, f"{self.marks}/{s.name}", s.fingerprint, replace=True)

    def run(self) -> list[str]:
        """Runs what is stale; the names of the steps that ran. The first failure ends the run once running steps have ended;
        what ended well is not run again."""
        todo = self.stale()
        left, running, failed = list(todo), {}, None
        with ThreadPoolExecutor(self.at_once) as pool:
            while (left and not failed) or running:
                busy = {*left, *running.values()}
                for name in [n for n in left if not failed and not busy & set(self.steps[n].needs)]:
                    running[pool.submit(self._one, self.steps[name])] = name
                    left.remove(name)
                for ended in wait(running, return_when=FIRST_COMPLETED).done:
                    running.pop(ended)
                    failed = failed or ended.exception()
        if failed:
            raise failed
        for s in self.steps.values():
            if s.temporary and s.output:
                files.delete(self.spark, s.output)
        return todo


@job
def ndvi_series(spark, root, output, s_res="500", t_res="16", chunk_size="24000", dataset="ndvi"):
    """Stored raster chunks to the pixel series that the model reads."""
    chunks = store.read(spark, root, dataset, s_res, t_res).withColumns({"dataset": F.lit(dataset), "s_res": F.lit(s_res)})
    rows = series.chunks_to_series(chunks, t_res, int(chunk_size))
    _write(rows.select(*KEYS, "start_idx", F.col("series").cast("array<double>").alias("ndvi")), output)


@job
def update(
    spark, work, ndvi, rain_series, static, gadm2, gadm, fires_path, betas, est_end, est_start=None, s_res="500", t_res="16",
    raster_source=None, rain_source=None, fires_source=None, regions=None, chunk_size="24000", locations="all", opener=rasters.open_hdf,
):
    """From rasters, rain grids and fire text to every export, each step a table under ``work``.

    ``ndvi``, ``rain_series``, ``fires_path`` and ``betas`` name finished tables; where one is empty it is made here, from
    ``raster_source``, ``rain_source``, ``fires_source`` and the training rows.
    """
    at = lambda name: f"{work}/{name}"
    r = {"s_res": s_res, "t_res": t_res}
    w = Workflow(spark, at("_steps"))

    def step(name: str, output: str | None, needs: tuple[str, ...], run: Callable, inputs: tuple = (), temporary: bool = False, **params) -> None:
        w.step(name, output, needs, run, inputs, r | params, temporary)

    def version(name: str) -> str:
        """Of a store: that of the step's fingerprint, so that a step that is run again adds nothing twice."""
        return f"{name}-{w.steps[name].fingerprint[:24]}"

    first: tuple[str, ...] = ()
    given = (ndvi,) if ndvi else ()
    if not ndvi:
        ndvi, first = at("ndvi"), ("ndvi",)
        step("rasters", at("chunks"), (), lambda: preprocess_modis(spark, raster_source, at("chunks"), locations, chunk_size, opener), (raster_source,), chunk_size=chunk_size, locations=locations)
        step("ndvi", ndvi, ("rasters",), lambda: ndvi_series(spark, at("chunks"), ndvi, chunk_size=chunk_size, **r))
    dry, dry_given = (), (rain_series,) if rain_series else ()
    if not rain_series:
        rain_series, dry = at("rain"), ("rain",)
        step("rain", rain_series, first, lambda: rain_pixels(spark, rain_source, ndvi, rain_series, rejects=at("rain-rejected"), **r), (rain_source, *given))
    hot: tuple[str, ...] = ()
    hot_given = (fires_path,) if fires_path else ()
    if not fires_path:
        fires_path, hot = at("fires"), ("fires",)
        step("fires", fires_path, (), lambda: preprocess_fires(spark, fires_source, fires_path, est_end, s_res, t_res, locations=locations, rejects=at("fires-rejected")), (fires_source,), est_end=est_end, locations=locations)
    step("filter", at("filtered"), first, lambda: timeseries_filter(spark, ndvi, static, at("filtered"), **r), (*given, static), temporary=True)
    step("adjust", at("adjusted"), ("filter", *dry), lambda: adjust_series(spark, at("filtered"), rain_series, at("adjusted"), est_start=est_start, **r), dry_given, est_start=est_start)
    step("trends", at("trends"), ("adjust",), lambda: trends_series(spark, at("adjusted"), at("trends"), est_end, est_start=est_start, **r), est_start=est_start, est_end=est_end)
    step("trends-store", at("store-trends"), ("trends",), lambda: trends_store(spark, at("trends"), at("store-trends"), version=version("trends-store"), **r))
    step("merge-trends", at("merged-trends"), ("trends-store",), lambda: merge_trends(spark, at("store-trends"), at("merged-trends"), **r))
    step("values", at("values"), ("merge-trends", *hot), lambda: pixel_values(spark, at("merged-trends"), fires_path, at("values"), est_end, est_start=est_start, **r), hot_given, est_start=est_start, est_end=est_end)
    step("neighbors", at("neighbors"), ("values",), lambda: neighbor_values(spark, at("values"), at("neighbors"), **r))
    learned: tuple[str, ...] = ()
    taught = (betas,) if betas else ()
    if not betas:
        betas, learned = at("betas"), ("betas",)
        step("training", at("training"), ("neighbors",), lambda: beta_data(spark, at("neighbors"), static, at("training"), est_start=est_start, regions=regions, **r), (static, regions), temporary=True, est_start=est_start)
        step("betas", betas, ("training",), lambda: gen_betas(spark, at("training"), betas, **r))
    step("estimate", at("estimated"), ("neighbors", *learned), lambda: estimate(spark, betas, at("neighbors"), static, at("estimated"), regions=regions, **r), (static, regions, *taught))
    step("probs-store", at("store-probs"), ("estimate",), lambda: probs_store(spark, at("estimated"), at("store-probs"), version=version("probs-store"), **r))
    step("merge-probs", at("merged-probs"), ("probs-store",), lambda: merge_probs(spark, at("store-probs"), at("merged-probs"), **r))
    step("admin", at("probs-admin"), ("merge-probs",), lambda: probs_admin(spark, at("merged-probs"), gadm2, static, at("probs-admin")), (gadm2, static))
    step("website", at("website"), ("admin",), lambda: website(spark, at("probs-admin"), gadm, at("website"), **r), (gadm,))
    step("download", at("download"), ("admin",), lambda: download(spark, at("probs-admin"), gadm, at("download"), **r), (gadm,))
    step("located-series", at("located-series"), ("admin",), lambda: located_series(spark, at("probs-admin"), static, gadm, at("located-series"), **r), (gadm, static))
    step("labelled-series", at("labelled_series"), ("admin",), lambda: labelled_series(spark, at("probs-admin"), static, at("labelled_series"), s_res=s_res), (static,))
    return w.run()


def read_config(spark, path: str) -> dict[str, str]:
    """Parameters of a run from a JSON file, whose groups of parameters are laid side by side."""
    out: dict[str, str] = {}
    for k, v in json.loads(files.read(spark, path)).items():
        out |= v if isinstance(v, dict) else {k: v}
    return {k: v if v is None else str(v) for k, v in out.items()}


@job
def run_config(spark, path, est_end=None):
    """The chain with the parameters of a JSON file; ``est_end`` takes the place of the file's, for the next period."""
    known = set(inspect.signature(update).parameters) - {"spark", "opener"}
    given = read_config(spark, path) | ({"est_end": est_end} if est_end else {})
    if unknown := set(given) - known:
        raise ValueError(f"unknown parameters {sorted(unknown)}")
    needed = {n: None for n in ("ndvi", "rain_series", "fires_path", "betas")}
    return update(spark, **(needed | given))


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="thicket")
    commands = parser.add_subparsers(dest="job", required=True)
    for name, f in JOBS.items():
        command = commands.add_parser(name.replace("_", "-"), help=(f.__doc__ or "").split("\n")[0])
        for p in list(inspect.signature(f).parameters.values())[1:]:
            required = p.default is inspect.Parameter.empty
            if p.name == "opener":  # a function, for callers in Python
                continue
            command.add_argument("--" + p.name.replace("_", "-"), dest=p.name, required=required, default=None if required else p.default)
    given = vars(parser.parse_args(args))
    f = JOBS[given.pop("job").replace("-", "_")]
    spark = share_package(SparkSession.builder.appName("thicket").getOrCreate())
    f(spark, **given)


if __name__ == "__main__":
    main()
