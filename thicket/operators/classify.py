"""Logistic regression by ecoregion, and probabilities from it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import stats as S
from ..schema import KEYS, NEIGHBOR_STATS, PIXEL_STATS, RunParams
from .series import FIRE_FIELDS, to_series

N_FEATURES = 21


def features(value: str = "val", neighbor: str = "neighbor") -> Column:
    """Constant, fires and statistics of the pixel, fires and statistics of its neighbours: 21 doubles."""
    v, n = F.col(value), F.col(neighbor)
    parts = [F.lit(1.0), *[v["fire"][f] for f in FIRE_FIELDS], *[v[s] for s in PIXEL_STATS], *[n["fire"][f] for f in FIRE_FIELDS], *[n[s] for s in NEIGHBOR_STATS]]
    return F.array(*[p.cast("double") for p in parts])


def fit(df: DataFrame, by: list[str], params: RunParams, label: str = "hansen", x: str = "x") -> DataFrame:
    """Coefficients by group, ``beta``, each group fitted in one task: for groups that fit in memory."""
    schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in by) + ", beta array<double>"
    ridge, threshold, most = params.ridge, params.threshold, params.max_iter

    def run(key, batch: pd.DataFrame) -> pd.DataFrame:
        beta = S.logistic_fit((batch[label] != 0).astype(float), np.stack(batch[x].to_numpy()), ridge, threshold, most)
        return pd.DataFrame([[*key, beta.tolist()]], columns=[*by, "beta"])

    return df.select(*by, label, x).groupBy(*by).applyInPandas(run, schema)


def fit_distributed(df: DataFrame, by: list[str], params: RunParams, label: str = "hansen", x: str = "x") -> DataFrame:
    """As ``fit`` for groups of any size: each Newton step sums score and information by task and group, and only these
    sums meet, one value a task and group. A null group is a group. ``df`` is read once a step, so give a stored table.

    A group has a number, by which tasks know it; the groups, and their coefficients, are on the driver.
    """
    spark = df.sparkSession
    types = [f"{c} {df.schema[c].dataType.simpleString()}" for c in by]
    groups = [tuple(r) for r in df.select(*by).distinct().collect()]
    known = spark.createDataFrame([(k, *g) for k, g in enumerate(groups)], ", ".join(["group__ int", *[f"k{i}__ {t.split(' ', 1)[1]}" for i, t in enumerate(types)]]))
    same = [F.col(c).eqNullSafe(F.col(f"k{i}__")) for i, c in enumerate(by)]
    numbered = df.join(known, same) if groups else df.withColumn("group__", F.lit(0))
    rows = numbered.select("group__", F.when(F.col(label) != 0, 1.0).otherwise(0.0).alias("y"), F.col(x).alias("x"))
    first = df.select(x).first()
    k = len(first[0]) if first else N_FEATURES
    betas, open_ = np.zeros((len(groups), k)), set(range(len(groups)))

    for _ in range(params.max_iter):
        if not open_:
            break
        now = {g: betas[g] for g in open_}

        def sums(batches: Iterator[pd.DataFrame], now=now) -> Iterator[pd.DataFrame]:
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for g, part in batch.groupby("group__"):
                    if g in now:
                        m = np.stack(part["x"].to_numpy())
                        p = S.logistic(m @ now[g])
                        got = np.concatenate([m.T @ (part["y"].to_numpy() - p), ((m * (p * (1 - p))[:, None]).T @ m).ravel()])
                        held[g] = held.get(g, 0.0) + got
            yield pd.DataFrame({"group__": list(held), "s": [v.tobytes() for v in held.values()]})

        def met(key, parts: pd.DataFrame) -> pd.DataFrame:
            whole = np.sum([np.frombuffer(v) for v in sorted(map(bytes, parts["s"]))], axis=0)  # in an order that reruns keep
            return pd.DataFrame({"group__": [key[0]], "s": [whole.tobytes()]})

        schema = "group__ int, s binary"
        totals = {r["group__"]: np.frombuffer(r["s"]) for r in rows.mapInPandas(sums, schema).groupBy("group__").applyInPandas(met, schema).collect()}
        for g in list(open_):
            step = S.newton_sums(totals[g][:k], totals[g][k:].reshape(k, k), params.ridge)
            betas[g] = betas[g] + step
            if np.linalg.norm(step) < params.threshold:
                open_.discard(g)
    return spark.createDataFrame([(*g, b.tolist()) for g, b in zip(groups, betas, strict=True)], ", ".join([*types, "beta array<double>"]))


def probability(beta: Column, x: Column) -> Column:
    """e**z / (e**z + 1), z the product of coefficients and features; NaN where e**z overflows."""
    z = A.dot(beta, x)
    return F.exp(z) / (F.exp(z) + 1)


def estimate(df: DataFrame, betas: DataFrame, params: RunParams, keys: list[str] = KEYS) -> DataFrame:
    """Probability series of each pixel from rows (keys, period, ecoregion, val, neighbor): ``start_idx, prob``.

    Periods without a row are nodata. An ecoregion without coefficients fails the job.
    """
    joined = df.withColumn("x", features()).join(betas.select(F.col("ecoregion").alias("eco__"), "beta"), F.col("ecoregion") == F.col("eco__"), "left")
    missing = F.raise_error(F.concat(F.lit("no coefficients for ecoregion "), F.coalesce(F.col("ecoregion").cast("string"), F.lit("null")))).cast("double")
    p = F.when(F.col("beta").isNull(), missing).otherwise(probability(F.col("beta"), F.col("x")))
    return to_series(joined.select(*keys, "period", p.alias("prob")), keys, "period", ["prob"], params.nodata)
