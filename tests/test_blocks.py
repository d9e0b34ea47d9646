"""Operators over many small blocks give what a sequential pass over the series gives."""

import math
import random
from collections import defaultdict

import folds
import pytest
from conftest import hour
from pyspark.sql import functions as F

from isochron.operators import rows
from isochron.operators.arima import arima, arima_errors, arima_metrics, coefficients, memory
from isochron.operators.differencing import difference
from isochron.operators.gaps import gap_report
from isochron.operators.lagging import correlation, lag_rows, paired_lags
from isochron.operators.smoothing import sma
from isochron.operators.stats import with_stratum


def gappy(seed, n):
    """``n`` (hour, value) points with gaps, some of them years long."""
    rng = random.Random(seed)
    at, points = rng.randrange(50), []
    for _ in range(n):
        points.append((at, folds.float32(round(rng.uniform(-50, 50), 2))))
        at += rng.choice([1] * 12 + [2, 5, 40, 3000, 20000])
    return points


# One series holds most rows, as a hot key would.
SERIES = {"hot": gappy(1, 600), "a": gappy(2, 37), "b": gappy(3, 8), "one": gappy(4, 1)}


@pytest.fixture(scope="module")
def df(frame):
    return frame(SERIES).cache()


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(rows, "DAYS_PER_BLOCK", 3)


def by_series(frame, value, *extra):
    """``{series: {(ts, *extra): value}}``."""
    out = defaultdict(dict)
    for r in frame.collect():
        out[r["series"]][(r["ts"], *[r[e] for e in extra])] = r[value]
    return out


def expected(make):
    """Same shape, from ``make(hours, values) -> {(t, *extra): value}``."""
    out = {}
    for name, points in SERIES.items():
        hours, values = [h for h, _ in points], [v for _, v in points]
        found = make(hours, values)
        if found:
            out[name] = {(hour(hours[k[0]]), *k[1:]): v for k, v in found.items()}
    return out


def same(got, wanted):
    assert got.keys() == wanted.keys()
    for name in wanted:
        assert got[name] == pytest.approx(wanted[name], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("days", [1, 3, 400])
def test_row_numbers(df, days):
    got = by_series(rows.index_rows(df, days), "rn")
    same(got, expected(lambda hours, values: {(t,): t for t in range(len(values))}))


def test_series_facts(df):
    for r in rows.index_rows(df, 2).select("series", "n", "first_ts", "mean").distinct().collect():
        values = [v for _, v in SERIES[r["series"]]]
        assert r["n"] == len(values)
        assert r["first_ts"] == hour(SERIES[r["series"]][0][0])
        assert r["mean"] == pytest.approx(sum(values) / len(values))


def test_blocks_are_bounded(df):
    indexed = rows.index_rows(df, 3)
    size, halo = 8, 2
    largest = rows.row_blocks(indexed, halo, size).groupBy("series", "row_block").count().agg(F.max("count")).first()[0]
    assert largest == size + halo
    assert rows.row_blocks(indexed, halo, size).filter(~F.col("is_copy")).count() == df.count()


@pytest.mark.parametrize("block", [5, 16, 4096])
def test_sma(df, block):
    got = by_series(sma(df, "1,4,150", block), "moving_avg", "window_size")
    same(
        got,
        expected(
            lambda hours, values: {
                (t, n): m for n in (1, 4, 150) for t, m in enumerate(folds.moving_average(values, n))
            }
        ),
    )


@pytest.mark.parametrize("block", [5, 4096])
def test_steps(df, block):
    got = by_series(difference(df, "step,4", block), "value", "level")
    same(
        got,
        expected(
            lambda hours, values: {
                (t, i): v for i, level in folds.step_levels(values, 4).items() for t, v in level.items()
            }
        ),
    )


@pytest.mark.parametrize("width", [1, 2, 5, 12, 100])
def test_seasons(df, width):
    got = by_series(difference(df, f"season,{width}", 5).filter("level = 1"), "value")
    same(got, expected(lambda hours, values: {(t,): v for t, v in folds.season(values, width).items()}))


@pytest.mark.parametrize(("lags", "block"), [([0, 1, 2], 5), ([0, 1, 5, 48, 7000], 5), ([3, 48], 4096)])
def test_lags(df, lags, block):
    got = by_series(lag_rows(paired_lags(df, lags, rows_per_block=block)), "value", "lag")
    same(
        got,
        expected(
            lambda hours, values: {
                (t, h): v for h in {0, *lags} for t, v in folds.lagged(hours, values, h).items()
            }
        ),
    )


def test_two_rows_in_an_hour_are_refused(spark):
    half_hours = spark.sql(
        "SELECT 's' AS series, TIMESTAMP_NTZ '2020-01-01 00:00:00' + id * INTERVAL '30' MINUTE AS ts, 1D AS value FROM range(9)"
    )
    with pytest.raises(Exception, match="more than one row per hour"):
        paired_lags(half_hours, 1).collect()


@pytest.mark.parametrize(("centered", "block"), [(False, 5), (True, 5), (True, 4096)])
def test_autocorrelation(df, centered, block):
    pairs = paired_lags(df, "1,48", centered, rows_per_block=block)
    rows_found = {(r["series"], r["lag"]): r for r in correlation(pairs, centered).collect()}
    assert len(rows_found) == 3 * len(SERIES)
    for name, points in SERIES.items():
        hours, values = [h for h, _ in points], [v for _, v in points]
        mean = sum(values) / len(values)
        x = [v - mean if centered else v for v in values]
        energy = sum(v * v for v in x)
        for h in (0, 1, 48):
            product = sum(x[t] * v for t, v in folds.lagged(hours, x, h).items())
            r = rows_found[name, h]
            if energy:
                assert r["autocorrelation"] == pytest.approx(product / energy, abs=1e-9)
            else:
                assert r["autocorrelation"] is None
            if centered:
                assert r["autocovariance"] == pytest.approx(product / len(values) - mean * mean, abs=1e-6)


MODELS = [
    {"p": "0.9,0.1", "q": "none", "d": 0},
    {"p": "0.9,0.1", "q": "0.5", "d": 0},
    {"p": "0.9,0.1", "q": "0.5", "d": 1},
    {"p": "0.5,0.2,0.1", "q": "0.4,-0.3", "d": 2, "c": 0.7},
    {"p": "0.6,0.3,0.05", "q": "0.2,0.1,0.05", "d": 0, "c": -1.0},
    {"p": "0.9", "q": "0.98", "d": 1},
]


def modelled(values, model, centered=False):
    """Values of the modelled level, narrowed as between stored steps."""
    skipped = 0 if model["d"] == 0 else model["d"] + 1
    level = [v for _, v in sorted(folds.step_levels(values, model["d"])[model["d"]].items())]
    stored = [folds.float32(v) for v in level]
    if centered and level:
        mean = sum(level) / len(level)
        stored = [folds.float32(v - mean) for v in stored]
    return skipped, stored


@pytest.mark.parametrize("block", [1, 9, 4096])
@pytest.mark.parametrize("model", MODELS)
def test_arima(df, model, block):
    ar, ma = coefficients(model["p"]), coefficients(model["q"])

    def make(hours, values):
        skipped, y = modelled(values, model)
        errors = folds.arma_errors(y, ar, ma, model.get("c", 0.0))
        return {(t + skipped,): e for t, e in enumerate(errors) if e is not None}

    got = by_series(arima(df, rows_per_block=block, **model), "error")
    wanted = expected(make)
    assert got.keys() == wanted.keys()
    for name in wanted:
        assert got[name] == pytest.approx(wanted[name], rel=1e-7, abs=1e-7)


LONG = [(h + h // 700, math.sin(h / 9) * 10 + h % 7) for h in range(2500)]


@pytest.mark.parametrize("q", ["0.5", "0.4,-0.3", "0.9", "0.999", "1.0", "-0.97"])
def test_states_are_handed_on(spark, frame, q):
    """Blocks that warm up on the rows before them, and blocks that take over a state, give what one block gives."""
    model = {"p": "0.5,0.2", "q": q, "d": 1}
    forgets = memory(coefficients(q), 1024 // 4 - 3)
    assert (forgets is not None) == (q in ("0.5", "0.4,-0.3"))
    df = frame({"a": LONG, "b": LONG[:1024], "c": LONG[:1026], "d": LONG[:3]})
    got = {(r["series"], r["ts"]): r["error"] for r in arima(df, rows_per_block=1024, **model).collect()}
    for name, n in (("a", 2500), ("b", 1024), ("c", 1026), ("d", 3)):
        skipped, y = modelled([v for _, v in LONG[:n]], model)
        wanted = folds.arma_errors(y, [0.5, 0.2], coefficients(q))
        own = [got.pop((name, hour(LONG[t + skipped][0])), None) for t in range(len(y))]
        assert own[:1] == wanted[:1] and own[1:] == pytest.approx(wanted[1:], rel=1e-9, abs=1e-9)
    assert not got


def test_levels_run_once_where_states_are_handed_on(spark, frame):
    """Both uses of the zero-state errors read one exchange."""
    df = arima_errors(frame({"a": LONG}), q="0.999", rows_per_block=1024)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    assert "ReusedExchange" in final or final.count("MapInArrow") <= 3


@pytest.mark.parametrize("block", [9, 4096])
def test_centred_arima(df, block):
    model = {"p": "0.9,0.1", "q": "0.5", "d": 1}

    def make(hours, values):
        skipped, y = modelled(values, model, centered=True)
        return {(t + skipped,): e for t, e in enumerate(folds.arma_errors(y, [0.9, 0.1], [0.5])) if e is not None}

    got = by_series(arima(df, centered=True, rows_per_block=block, **model), "error")
    for name, wanted in expected(make).items():
        assert got[name] == pytest.approx(wanted, rel=1e-5, abs=1e-5)  # means differ in the last bit before narrowing


def test_arima_metrics(df):
    found = {r["series"]: r for r in arima_metrics(df, d=0, c=2.0, rows_per_block=9).collect()}
    for name, points in SERIES.items():
        values = [v for _, v in points]
        errors = folds.arma_errors(values, [0.9, 0.1], [0.5], 2.0)
        pairs = [(y, e) for y, e in zip(values, errors) if e is not None]
        if not pairs:
            assert found[name]["mse"] is None
            continue
        wanted = folds.metrics(pairs, len(values), 4)
        assert {k: found[name][k] for k in wanted} == pytest.approx(wanted, rel=1e-9)


def test_error_pass_keeps_every_row(df):
    assert arima_errors(df, d=0, rows_per_block=9).count() == df.count()


def test_strata(df):
    got = by_series(with_stratum(df, 3, 5), "stratum")
    same(got, expected(lambda hours, values: {(t,): (t // 5) % 3 for t in range(len(values))}))


def test_gaps(df):
    got = by_series(gap_report(df).withColumnRenamed("next_ts", "ts"), "missing_ts")
    wanted = expected(
        lambda hours, values: {
            (t,): hour(hours[t - 1] + 1) for t in range(1, len(hours)) if hours[t] != hours[t - 1] + 1
        }
    )
    assert got == wanted


def test_two_rows_of_one_hour_are_an_error(spark, frame):
    for build in (lambda df: sma(df, 3), gap_report, lambda df: difference(df, "step,1")):
        with pytest.raises(Exception, match="more than one row per hour in series a"):
            build(frame({"a": [(0, 1), (1, 2), (1, 3)]})).collect()


@pytest.mark.parametrize("size", range(31, 41))
def test_blocks_do_not_matter_to_long_windows(frame, size):
    values = [(h, 1e17 if h == 700 else h % 13 + 0.1) for h in range(1200)]
    small, large = (
        {r["ts"]: r["moving_avg"] for r in sma(frame({"a": values}), size, rows_per_block=n).collect()} for n in (256, 3072)
    )
    assert small == pytest.approx(large, rel=1e-12)
    ordered = [small[t] for t in sorted(small)]
    last = sum(v for _, v in values[-size:]) / size
    assert ordered[-1] == pytest.approx(last) and ordered[700 + size] < 14
