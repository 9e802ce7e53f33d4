"""Published examples of filters, series and probabilities: fixed values."""

import pytest
from pyspark.sql import functions as F

from thicket.functions import stats as S
from thicket.operators import classify, pixels
from thicket.schema import RunParams, fire, pixel_value

from .test_operators import KEYED, PX


def test_singular_series_have_no_statistics():
    assert S.long_stats([0]) is None and S.hansen_stat([0] * 100) is None


def test_filters():
    assert S.deseasonalize(3, [1, 2, 3, 4, 3, 2, 1, 2, 3, 4, 3, 2, 1]) == pytest.approx(
        [1.1846153846153844, 1.8846153846153846, 2.8846153846153846, 4.184615384615384, 2.8846153846153846, 1.8846153846153846, 1.1846153846153844]
        + [1.8846153846153846, 2.8846153846153846, 4.184615384615384, 2.8846153846153846, 1.8846153846153846, 1.1846153846153844]
    )
    assert S.interpolate(2, 4, 3) == pytest.approx([2.0, 2.6666667, 3.3333333]) and S.interpolate(2, 4, 2) == [2.0, 3.0]


@pytest.mark.parametrize(
    ("flags", "ends"),
    [([0] * 5, set()), ([1, 0, 0, 0, 1], set()), ([2, 0, 0, 0, 0], {0}), ([2, 0, 0, 0, 2], {0, 4}), ([2, 2, 0, 2, 2], {0, 1, 3, 4}), ([2] * 5, {0, 1, 2, 3, 4})],
)
def test_bad_ends(flags, ends):
    assert S.bad_ends({2, 3, 255}, flags) == ends


@pytest.mark.parametrize(
    ("flags", "values"),
    [([0] * 5, [0, 1, 2, 3, 4]), ([0, 2, 0, 0, 0], [0, 1, 2, 3, 4]), ([2, 0, 0, 0, 0], [2.5, 1, 2, 3, 4]), ([2, 0, 0, 0, 2], [2.0, 1, 2, 3, 2.0]), ([2, 2, 0, 0, 2], [2.5, 2.5, 2, 3, 2.5])],
)
def test_neutral_ends(flags, values):
    assert S.neutralize_ends({2, 3}, flags, [0, 1, 2, 3, 4]) == values


@pytest.mark.parametrize(
    ("values", "flags", "want"),
    [([1] * 3, [0] * 3, [1] * 3), ([1] * 3, [0, 1, 0], [1] * 3), ([1] * 3, [2, 2, 1], [1] * 3), ([1] * 3, [2] * 3, None), ([1, 2, 3], [1, 2, 1], [1, 2, 3]), ([10] * 10, [3] * 10, None)],
)
def test_reliable(values, flags, want):
    assert S.make_reliable({0, 1}, {2, 3, 255}, values, flags) == want


def test_apply_coefficients(spark):
    neighbor = F.struct(fire(F.lit(1), F.lit(0), F.lit(0), F.lit(1)).alias("fire"), F.lit(1).alias("neighbor_count"), *[F.lit(float(k)).alias(n) for k, n in enumerate(classify.NEIGHBOR_STATS, 1)])
    row = spark.range(1).select(pixel_value(fire(), *[F.lit(float(k)) for k in (1, 2, 3, 4)]).alias("val"), neighbor.alias("neighbor"))
    p = [classify.probability(F.array_repeat(F.lit(b), 21), classify.features()) for b in (0.5, 0.75)]
    assert row.select(*[x.alias(f"p{k}") for k, x in enumerate(p)]).first() == (pytest.approx(0.9999999999771026, abs=1e-13), pytest.approx(1.0))


@pytest.mark.parametrize(("by_region", "want"), [(False, 0.0953494648991095), (True, 0.16110894957658545)])
def test_estimate(spark, by_region, want):
    """Two periods with a hole between them, by ecoregion and by region."""
    stats = dict(zip(classify.NEIGHBOR_STATS, (-1.0, 2.0, -15.0, -2.0, -2.0, 6.0, -12.0, 8.0), strict=True))
    neighbor = F.struct(fire(F.lit(1), F.lit(0), F.lit(0), F.lit(1)).alias("fire"), F.lit(1).alias("neighbor_count"), *[F.lit(v).alias(n) for n, v in stats.items()])
    rows = spark.createDataFrame([(*PX, p, 10101) for p in (827, 829)], f"{KEYED}, period int, ecoid int").withColumns({"val": pixel_value(fire(), *[F.lit(float(k)) for k in (1, 2, 3, 4)]), "neighbor": neighbor})
    betas = spark.createDataFrame([(0, [0.5] * 21), (21, [0.55] * 21), (10101, [0.75] * 21)], "ecoregion int, beta array<double>")
    known = spark.createDataFrame([(10101, 21, 0.001278499893458342)], "ecoid int, regionid int, hit_share double")
    out = classify.estimate(pixels.final_ecoregion(rows, known, by_region), betas, RunParams()).first()
    assert out.start_idx == 827 and out.prob == pytest.approx([want, -9999.0, want])
