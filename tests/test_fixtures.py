"""Small series with known results."""

import math

import pytest
from conftest import hour
from pyspark.sql import functions as F

from isochron.operators.arima import arima, arima_metrics
from isochron.operators.differencing import difference, difference_stats
from isochron.operators.gaps import gap_report
from isochron.operators.lagging import autocorrelation, lag_series
from isochron.operators.smoothing import sma, sma_metrics, sma_text
from isochron.operators.stats import describe_series, series_stats, wide_stats

V = {"V": list(enumerate([1, 2, 4, 8, 16, 32]))}
G = {"G": list(zip([0, 1, 2, 5, 6, 7], [1, 2, 3, 4, 5, 6]))}


@pytest.fixture(scope="module")
def v(frame):
    return frame(V)


def column(df, name, *order):
    return [row[name] for row in df.orderBy(*(order or ["ts"])).collect()]


def test_stats(v):
    row = series_stats(v).first()
    assert (row["count"], row["min"], row["max"], row["mean"]) == (6, 1.0, 32.0, 10.5)
    assert row["variance"] == pytest.approx(703.5)
    assert row["std_dev"] == pytest.approx(26.523574, abs=1e-6)
    assert row["sample_variance"] == pytest.approx(703.5 / 5)
    assert (row["min_ts"], row["max_ts"]) == (hour(0), hour(5))


def test_strata(v):
    rows = {r["stratum"]: r for r in describe_series(v, 2, 2).collect()}
    assert rows[None]["count"] == 6
    assert (rows[0]["count"], rows[0]["min"], rows[0]["max"]) == (4, 1.0, 32.0)
    assert (rows[1]["count"], rows[1]["min"], rows[1]["max"]) == (2, 4.0, 8.0)
    wide = wide_stats(describe_series(v, 2, 2), 2).first()
    assert (wide["count"], wide["count_0"], wide["count_1"], wide["max_1"]) == (6, 4, 2, 8.0)


def test_one_stratum_is_overall_only(v):
    assert [r["stratum"] for r in describe_series(v, 1, 2).collect()] == [None]


def test_sma(v):
    points = sma(v, 3)
    assert column(points, "moving_avg") == pytest.approx([1, 1.5, 7 / 3, 14 / 3, 28 / 3, 56 / 3])
    assert column(points, "error") == pytest.approx([0, 0.5, 5 / 3, 10 / 3, 20 / 3, 40 / 3])
    m = sma_metrics(points).first()
    assert m["params"] == "windowSize=3"
    expected = {
        "mse": 39.393519, "maape": 0.304024, "aic_mse": -5.347203, "aic_maape": 4.381298,
        "bic_mse": -5.555443, "bic_maape": 4.173058,
    }
    assert {k: m[k] for k in expected} == pytest.approx(expected, abs=1e-6)


def test_sma_text(v):
    line = sma_text(sma(v, 3).filter(F.col("ts") == F.lit(hour(2)).cast("timestamp_ntz"))).first()["value"]
    assert line == "V\t2020-01-01 02:00:00: actual:  4.00  moving avg:  2.33  error  1.67  sq error  2.78"


def test_sma_of_one_row_has_no_error(v):
    assert column(sma(v, 1), "error") == [0.0] * 6


@pytest.mark.parametrize("bad", [0, "0", "1,0", "", "-3"])
def test_sma_rejects_bad_windows(v, bad):
    with pytest.raises(ValueError):
        sma(v, bad)


def test_constant_series_has_infinite_criteria(frame):
    m = sma_metrics(sma(frame({"C": [(0, 5), (1, 5), (2, 5)]}), 3)).first()
    assert m["mse"] == 0.0
    assert m["aic_mse"] == m["bic_mse"] == m["aic_maape"] == math.inf


def test_maape_edges(frame):
    from isochron.operators.metrics import model_metrics

    points = frame({"Z": [(0, 0)]}).select("series", F.lit(0.0).alias("actual"), F.lit(0.0).alias("error"))
    assert model_metrics(points, 1, "").first()["maape"] == 0.0
    points = points.withColumn("error", F.lit(3.0))
    assert model_metrics(points, 1, "").first()["maape"] == pytest.approx(math.pi / 2)


def test_lag_and_autocorrelation(v):
    assert column(lag_series(v, 1).filter("lag = 1"), "value") == [1, 2, 4, 8, 16]
    assert lag_series(v, 1).filter("lag = 1").agg(F.min("ts")).first()[0] == hour(1)
    raw = {r["lag"]: r for r in autocorrelation(v, 1).collect()}
    assert raw[0]["autocorrelation"] == 1.0
    assert raw[1]["autocorrelation"] == pytest.approx(0.499634, abs=1e-6)
    centred = {r["lag"]: r for r in autocorrelation(v, 1, centered=True).collect()}
    assert centred[1]["autocorrelation"] == pytest.approx(0.364961, abs=1e-6)
    assert centred[1]["autocovariance"] == pytest.approx(-67.458333, abs=1e-6)


def test_lag_over_gaps(frame):
    g = frame(G)
    by_time = {r["ts"]: r["value"] for r in lag_series(g, 3).filter("lag = 3").collect()}
    assert by_time == {hour(5): 1.0, hour(6): 2.0, hour(7): 3.0}
    by_time = {r["ts"]: r["value"] for r in lag_series(g, 1).filter("lag = 1").collect()}
    assert by_time[hour(5)] == 3.0


def test_lag_longer_than_series(v):
    assert {r["lag"] for r in lag_series(v, 100).collect()} == {0}
    assert {r["lag"]: r["autocorrelation"] for r in autocorrelation(v, 100).collect()} == {0: 1.0, 100: 0.0}


def test_lag_zero_is_identity(v):
    assert column(lag_series(v, 0), "value") == [1, 2, 4, 8, 16, 32]


def test_autocorrelation_of_zeros_is_null(frame):
    rows = autocorrelation(frame({"Z": [(0, 0), (1, 0)]}), 1).collect()
    assert [r["autocorrelation"] for r in rows] == [None, None]


def test_gap_report(frame):
    assert [tuple(r) for r in gap_report(frame(G)).collect()] == [("G", hour(3), hour(5))]
    assert gap_report(frame(V)).count() == 0


def level(df, n):
    return [(r["ts"].hour, r["value"]) for r in df.filter(F.col("level") == n).orderBy("ts").collect()]


def test_differences(v):
    steps = difference(v, "step,2")
    assert level(steps, 1) == [(2, 2.0), (3, 4.0), (4, 8.0), (5, 16.0)]
    assert level(steps, 2) == [(3, 2.0), (4, 4.0), (5, 8.0)]
    assert level(difference(v, "season,2"), 1) == [(4, 12.0), (5, 24.0)]
    assert level(difference(v, "step,0"), 0) == level(difference(v, ""), 0) == level(steps, 0)
    stats = {r["level"]: r["count"] for r in difference_stats(steps).collect()}
    assert stats == {0: 6, 1: 4, 2: 3}


@pytest.mark.parametrize("bad", ["hop,1", "step", "step,x", "season,0", "step,-1"])
def test_bad_differencing(v, bad):
    with pytest.raises(ValueError):
        difference(v, bad)


def test_arima(v):
    points = arima(v, d=0)
    assert column(points, "prediction") == pytest.approx([0.9, 1.35, 2.475, 4.8375, 9.61875])
    assert column(points, "error") == pytest.approx([1.1, 2.65, 5.525, 11.1625, 22.38125])
    m = arima_metrics(v, d=0).first()
    expected = {
        "mse": 132.855977, "maape": 0.582369, "aic_mse": -3.778531, "aic_maape": 7.081301,
        "bic_mse": -4.403253, "bic_maape": 6.45658,
    }
    assert {k: m[k] for k in expected} == pytest.approx(expected, abs=1e-6)
    assert m["params"] == (
        "arima_p=0.9;0.1 : arima_q=0.5 : arima_c=0.0 : arima_d=0 : differencing=step;0 : zero_transform=false"
    )


def test_arima_rejects_more_error_terms(v):
    with pytest.raises(ValueError):
        arima(v, p="0.5", q="0.1,0.2")


def test_one_reading(frame):
    one = frame({"O": [(0, 7)]})
    assert series_stats(one).first()["count"] == 1
    assert [r["level"] for r in difference(one, "step,2").collect()] == [0]
    assert arima(one, d=0).count() == 0
    m = arima_metrics(one, d=0).first()
    assert m["mse"] is None and m["aic_mse"] is None


def test_series_do_not_touch_each_other(frame):
    both = frame({**V, **G})
    for op in (
        lambda df: sma(df, "2,3"),
        lambda df: lag_series(df, "1,3"),
        lambda df: difference(df, "step,2"),
        lambda df: arima(df, d=1),
        lambda df: describe_series(df, 2, 2),
        lambda df: arima_metrics(df, d=0, centered=True),
    ):
        together = sorted(map(str, op(both).collect()))
        apart = sorted(map(str, op(frame(V)).collect() + op(frame(G)).collect()))
        assert together == apart
