"""Structured Streaming into the store, and over it: arriving versions are committed once each; the newest of each period
is kept as state.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import periods as P
from ..operators.series import FIRE_FIELDS
from ..sources import store


def commit_batches(root: str, dataset: str, s_res: str, t_res: str, stream: str, pedigree=None):
    """For foreachBatch: commits a micro-batch under a version named by its stream and epoch, so one that is replayed after
    a failure is not added twice."""

    def add(batch: DataFrame, epoch: int) -> None:
        store.append(batch, root, dataset, s_res, t_res, pedigree, version=f"{stream}-{epoch}", stream=stream, epoch=epoch)

    return add


def stream_versions(spark: SparkSession, incoming: str, schema: str, root: str, dataset: str, s_res: str, t_res: str, checkpoint: str, pedigree=None) -> StreamingQuery:
    """Appends every new Parquet file under ``incoming`` to the store as a version. Ends when all files there are read.

    A stream is known by its checkpoint.
    """
    add = commit_batches(root, dataset, s_res, t_res, hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16], pedigree)
    source = spark.readStream.schema(schema).parquet(incoming)
    return source.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(add).start()


def newest_values(versions: DataFrame, keys: list[str], series: list[str], t_res: str, late: str = "90 days") -> DataFrame:
    """Of a stream of versions (keys, pedigree, start_idx, series), the value of each period that counts: ``keys, period,
    series..., pedigree``, the rules those of ``operators.series.overlay_versions``.

    State is by key and period, and holds the newest version's values alone, whatever order versions come in and however
    often. It goes once the watermark, ``late`` behind the last period seen, has passed the period's end: an append sink gets the
    final rows then, an update sink each change. Values that come later still are left out.
    """
    zipped = F.arrays_zip(*series)
    rows = versions.select(*keys, "pedigree", "start_idx", F.posexplode(zipped).alias("at", "z")).withColumn("period", F.col("start_idx") + F.col("at"))
    ends = (P.period_start(F.col("period") + 1, t_res).cast("timestamp") - F.expr("interval 1 second")).alias("ends")
    newest = rows.select(*keys, "period", ends, "pedigree", "start_idx", "z").withWatermark("ends", late)
    kept = newest.groupBy(*keys, "period", "ends").agg(F.max_by("z", F.struct("pedigree", "start_idx")).alias("z"), F.max("pedigree").alias("pedigree"))
    return kept.select(*keys, "period", *[F.col(f"z.{s}").alias(s) for s in series], "pedigree")


def fire_windows(fires: DataFrame, keys: list[str], t_res: str = "16", late: str = "30 days", time: str = "ts") -> DataFrame:
    """Fire counts by period over a stream with event time; what comes later than ``late`` is left out.

    State is by key and period. A period's row is final once the watermark has passed its last day, which an append
    sink waits for.
    """
    hot, sure = F.col("kelvin") >= 330, F.col("conf") >= 50
    counts = dict(zip(FIRE_FIELDS, (F.count_if(hot), F.count_if(sure), F.count_if(hot & sure), F.count("conf")), strict=True))
    period = P.period(time, t_res)
    last = (P.period_start(period + 1, t_res).cast("timestamp") - F.expr("interval 1 second")).alias("ends")
    return fires.withColumns({"period": period, "ends": last}).withWatermark("ends", late).groupBy(*keys, "period", "ends").agg(*[c.alias(n) for n, c in counts.items()]).select(*keys, "period", *FIRE_FIELDS)
