"""Column functions and kernels against published values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from thicket.functions import arrays as A
from thicket.functions import geo as G
from thicket.functions import periods as P
from thicket.functions import stats as S
from thicket.operators.trends import telescope
from thicket.sources import grids


def one(spark, *columns):
    row = spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()
    return list(row) if len(columns) > 1 else row[0]


def arr(*values):
    return F.array(*[F.lit(v) for v in values])


@pytest.mark.parametrize("date,res,period", [("2005-12-04", "32", 431), ("2003-12-31", "16", 781), ("2003-12-31", "8", 1563), ("2005-12-31", "16", 827), ("1970-01-01", "1", 0), ("1972-12-31", "1", 1095), ("1973-01-01", "1", 1095)])
def test_periods(spark, date, res, period):
    assert P.period_of(date, res) == period
    assert one(spark, P.period(F.lit(date), res)) == period
    assert one(spark, P.period_start(F.lit(period), res)) == P.start_of(period, res)


def test_period_arithmetic(spark):
    got = one(
        spark, P.period_span(F.lit(781), "16"), P.shift_resolution(F.lit(827), "16", "32"), P.within_dates("2000-01-01", "2001-01-01", F.lit("2001-01-01")),
        P.date_index("32", F.lit(360), F.lit(3), F.lit("2000-03-05")), P.date_index("32", F.lit(360), F.lit(3), F.lit("2000-04-05")),
        P.value_at("32", F.lit(360), arr(7, 8, 9), F.lit("2000-02-01")), P.value_at("32", F.lit(360), arr(7, 8, 9), F.lit("2009-02-01"), clamp=True),
        P.consecutive(arr(3, 1, 2)), P.consecutive(arr(1, 3)), P.intervals_overlap(F.lit(1), F.lit(3), F.lit(3), F.lit(5)),
        P.map_to_series(P.series_to_map(F.lit(5), arr(1.0, 2.0)), -1.0), F.size(P.monthly_millis(F.lit("2000-01-01"), F.lit("2000-12-01"))),
        P.temporal_subvec(F.lit(10), arr(1, 2, 3, 4), F.lit(11), F.lit(13)), P.ordinal(F.lit("2001-02-01")), P.convert(F.lit("20010203"), "yyyyMMdd", "yyyy-MM-dd"),
    )
    assert got == [13, 431, False, 2, None, 8, 9, True, False, True, [1.0, 2.0], 12, [2, 3], 31, "2001-02-03"]
    with pytest.raises(Exception, match="reversed"):
        one(spark, P.diff_in_days(F.lit("2001-01-02"), F.lit("2001-01-01")))
    with pytest.raises(ValueError):
        P.per_year("7")


def test_arrays(spark):
    got = one(
        spark, A.clean_probabilities(arr(0.1, 0.2, 0.3, 0.4, 0.5)), A.clean_probabilities(A.scale(arr(0.4, 0.5, 0.6), 0.5)),
        A.clean_probabilities(arr(-9999.0, 0.5, -9999.0)), A.fill_forward(arr(None, 1.0, None), None, 0.0), A.fill_forward(F.array().cast("array<double>"), None, 0.0),
        A.moving_average(arr(1, 2, 3, 4), 2), A.moving_average(arr(1), 2), A.trailing_average(arr(1.0, 2.0, 3.0, 4.0), 3),
        A.align((F.lit(0), arr(1, 2, 3, 4)), (F.lit(1), arr(2, 3, 4, 5))), A.align((F.lit(0), arr(1)), (F.lit(5), arr(2))),
        A.first_hit(arr(1, 5, 7), 5), A.first_hit(arr(1), 5), A.positions(arr(1, 5, 7), lambda x: x > 1), A.weighted_mean(arr(1.0, 3.0), arr(1.0, 3.0)),
        A.unweave(arr(1, 2, 3, 4)), A.prefixes(arr(1, 2), 1, 3), A.revolve(arr(1, 2, 3)), A.outer_product(arr(1, 2), arr(1, 2)), A.insert_into(0, 1, 4, arr(7)),
        A.pg_array(arr(1, 2)), A.from_pg_array(F.lit('"{1,2}"')), A.row_col(F.lit(7), 3, 3), A.row_col(F.lit(9), 3, 3), A.is_constant(F.array().cast("array<int>")), A.rest(arr(1, 2)),
        A.expand_sparse(F.array(F.struct(F.lit(3).alias("idx"), F.lit(9).alias("v"))), F.lit(2), F.lit(3), -1), A.running_sum(arr(1, 2, 3)), A.mask(arr(1, 0), arr(5, 6), lambda q: q == 1),
    )
    got = [r.asDict() if hasattr(r, "asDict") else r for r in got]
    assert got == [
        [10, 15, 20, 30, 40], [20, 22, 25], [0, 25, 33], [0.0, 1.0, 1.0], [], [1.5, 2.5, 3.5], [], [1.0, 1.5, 2.0, 3.0],
        {"start": 1, "s0": [2, 3, 4], "s1": [2, 3, 4]}, {"start": 5, "s0": [], "s1": []}, 1, None, [1, 2], 2.5,
        {"even": [1, 3], "odd": [2, 4]}, [[1], [1, 2], [1, 2, 2]], [[1, 2, 3], [2, 3, 1], [3, 1, 2]], [1, 2, 2, 4], [0, 7, 0, 0],
        '"{1,2}"', [1, 2], {"row": 2, "col": 1}, None, False, [2], [-1, 9, -1], [1.0, 3.0, 6.0], [None, 6],
    ]


def test_stretch(spark):
    a, b, c = one(spark, A.stretch(F.lit(384), arr(1, 2, 3), "32", "16"), A.stretch(F.lit(361), arr(10, 20, 30, 40), "32", "16"), A.stretch(F.lit(361), arr(10, 20, 30, 40), "32", "16", aligned=True))
    assert (a.start, a.series) == (736, [1.0, 1.0625, 2.0, 2.3125, 3.0])
    assert (b.start, b.series) == (691, [11.25, 20.0, 21.875, 30.0, 33.125, 40.0, 40.0])
    assert c.series[0] == 10.0


def test_projection(spark):
    p, q, t, cell, back = one(
        spark, G.latlon_to_pixel("1000", F.lit(42.4), F.lit(-115.1)), G.pixel_to_latlon("500", F.lit(28), F.lit(8), F.lit(0), F.lit(0)),
        G.latlon_to_tile(F.lit(41.850033), F.lit(-87.65005), 16), G.pixel_to_cell("500", grids.GRIDS["precl"], F.lit(8), F.lit(6), F.lit(0), F.lit(0)),
        G.latlon_to_pixel("1000", F.lit(29.89583), F.lit(-115.2290)),
    )
    assert p.line == 912 and tuple(back) == (8, 6, 12, 12)
    assert tuple(q) == (pytest.approx(9.99791666666666), pytest.approx(101.54412568476158))
    assert tuple(t) == (16811, 24364, 16) and tuple(cell) == (239, 489)
    assert one(spark, G.tile_string(F.lit(8), F.lit(6)), G.tile_string(F.lit(0), F.lit(0)), G.is_mappable(F.lit(90.0), F.lit(0.0))) == ["008006", None, False]
    assert [tuple(x) for x in one(spark, G.parent_tiles(F.lit(5), F.lit(9), F.lit(3), 1))] == [(1, 2, 1), (2, 4, 2), (5, 9, 3)]
    assert one(spark, G.parent_tiles(F.lit(5), F.lit(9), F.lit(3), 4)) == []
    assert G.pixels_at("5000") == 240 and G.chunk_dims("1000", 24000) == (1200, 20)
    assert tuple(one(spark, G.chunk_position("1000", 24000, F.lit(2), F.lit(1231)))) == (31, 41)


def test_grid_index(spark):
    at = G.index_rowcol("500", F.lit(1658947200))
    assert tuple(one(spark, at)) == (19200, 67200)
    assert one(spark, G.global_index("500", F.lit(19200), F.lit(67200)), G.window_index(10, 10, 5, 5, F.lit(12), F.lit(11)), G.window_index(10, 10, 5, 5, F.lit(9), F.lit(11))) == [1658947200, 11, None]


def test_pixel_from_tile(spark):
    """A pixel keeps the numbers it has in its own tile; one below and left of a tile is numbered on from its corner."""
    there = G.latlon_to_pixel("500", F.lit(-0.002083), F.lit(100.002083))
    own, above = one(spark, there, G.pixel_from_tile("500", F.lit(28), F.lit(8), there))
    assert tuple(own) == (28, 9, 0, 0) and tuple(above) == (28, 8, 0, 2400)
    assert tuple(one(spark, G.pixel_from_tile("500", F.lit(28), F.lit(9), there))) == tuple(own)
    assert tuple(one(spark, G.pixel_from_tile("500", F.lit(29), F.lit(10), there))) == (29, 10, -2400, -2400)


def test_logistic():
    assert S.logistic_fit([1, 0], [[1, 2], [4, 5]], 1e-8, 1e-6, 250) == pytest.approx([-49.06118492894668, 34.891861487354284], rel=1e-6)
    assert S.logistic_fit([1, 0], [[1, 2], [4, 5]], 1e-8, 1e-6, 250, accumulate=False)[0] == pytest.approx(-53.81, abs=0.01)


def test_trends_match_one_regression_at_a_time():
    rng = np.random.default_rng(3)
    y, rain = rng.normal(5000, 300, 120), np.concatenate([np.full(60, 3.0), rng.normal(3, 1, 60)])
    a = telescope(y, rain, 700, 750, 825, 10, 30)
    b = S.telescoping_trends(y, rain, 700, 750, 825)
    assert a["end"] == b["end"] and a["short"] == pytest.approx(b["short"])
    for name in ("long", "t_stat", "break"):
        assert a[name] == pytest.approx(b[name], rel=1e-6)


def test_singular_is_none():
    assert S.hansen_stat([0.0] * 40) is None
    x = np.column_stack([np.ones(10), np.ones(10)])
    assert S.trend_characteristics(np.arange(10.0), x) is None


def test_filters():
    y = np.tile([1.0, 5.0, 3.0], 8)
    assert S.deseasonalize(3, y) == pytest.approx(np.full(24, 3.0))
    assert S.harmonic_decomposition(3, 1, y) == pytest.approx(np.full(24, 3.0))
    line = np.arange(20.0)
    assert S.hp_filter(50.0, line) == pytest.approx(line)
    assert S.make_reliable({0, 1}, {2, 3}, [9, 2, 9, 4, 9], [2, 0, 2, 0, 2]) == [3.0, 2, 3.0, 4, 3.0]
    assert S.make_reliable({0}, {2}, [1, 2], [2, 2]) is None and S.make_reliable({0}, {2}, [1, 2], [0, 0]) == [1, 2]
    with pytest.raises(ValueError):
        S.deseasonalize(30, y)


def test_breaks():
    rng = np.random.default_rng(5)
    y = np.concatenate([rng.normal(100, 1, 120), rng.normal(80, 1, 80)])
    x = S.with_trend(200)
    assert len(S.recursive_residuals(y, x)) == 197
    at = S.break_index(y, x, 0.05, 0.05)
    assert 110 <= at <= 140 and S.critical_value(0.05, 0.05) == 3.6622
    assert S.downshift_magnitude(y, x, 0.05, 0.05) > 10
    flat = rng.normal(0, 1, 200)
    assert S.break_index(flat + 0.0, x, 0.5, 0.01) is None and math.isclose(S.mosum_statistic([-2.0, 1.0]), 2.0)


def test_maps_and_fires(spark):
    m = lambda k, v: F.create_map(F.lit(k), F.lit(v))
    assert one(spark, A.merge_maps(m("a", 1), m("b", 2)), A.maps_overlap(m("a", 1), m("a", 2))) == [{"a": 1, "b": 2}, True]
    with pytest.raises(Exception, match="share a key"):
        one(spark, A.merge_maps(m("a", 1), m("a", 2)))
    assert one(spark, A.trim_fires(F.lit(10), arr(1, 2, 3, 4), 11, 12)) == [2, 3]
    with pytest.raises(Exception, match="begin after"):
        one(spark, A.trim_fires(F.lit(12), arr(1, 2), 11, 12))


def test_positions_of_flags():
    assert S.bad_ends({2}, [2, 2, 0, 2, 0, 2]) == {0, 1, 5} and S.bad_ends({2}, [0]) == set()
    assert S.neutralize_ends({2}, [0, 0], [1, 2]) == [1, 2]
    assert S.interpolate(1, 3, 4) == [1.0, 1.5, 2.0, 2.5]
    assert S.windowed_trend(3, [1.0, 2.0, 3.0, 5.0]) == pytest.approx([1.0, 1.5]) and len(S.windowed_trend(9, [1.0])) == 0
