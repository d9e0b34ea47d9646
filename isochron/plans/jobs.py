"""The five analyses. Each takes stored readings and returns its result tables.

Analysis, differencing and moving average also take the ``counts`` that are kept with a readings table
(``sources.tables.read_counts``), and then read its rows once.

With ``out`` the point table is written first and the figures derived from it are computed from the
stored rows, so that nothing is computed twice and a lost executor costs no earlier step. Figures are also appended as
CSV below ``out/export``, one row for each model or lag.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from isochron import sinks
from isochron.functions.timekeys import DATETIME_FORMAT
from isochron.operators import arima as arima_ops
from isochron.operators.differencing import difference, difference_stats
from isochron.operators.lagging import correlation, lag_rows, paired_lags
from isochron.operators.metrics import model_metrics
from isochron.operators.smoothing import sma, sma_metrics, sweep_metrics
from isochron.operators.stats import describe_series
from isochron.sources.tables import match_series, time_range


class Result(NamedTuple):
    points: DataFrame
    figures: DataFrame


def readings(
    df: DataFrame, columns: str | Sequence[str] | None = None, start: str | None = None, stop: str | None = None
) -> DataFrame:
    """Rows to analyse: a time range and the series whose whole name matches."""
    df = time_range(df, start, stop)
    return match_series(df, columns) if columns else df


def _exported(figures: DataFrame, out: str) -> DataFrame:
    sinks.append_metrics_csv(figures, f"{out}/export")
    return figures


def analysis(
    df: DataFrame, num_strata: int = 1, strata_width: int = 1, out: str | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """Statistics; with ``out`` they are upserted there, and those of this run appended to ``out/export``."""
    stats = describe_series(df, num_strata, strata_width, counts)
    if not out:
        return stats
    stats = sinks.replace_table(stats, f"{out}/run")
    _exported(stats, out)
    return sinks.upsert_table(stats, out, ["series", "stratum"])


def transform(df: DataFrame, lags: str | Sequence[int] = "1", centered: bool = False, out: str | None = None) -> Result:
    pairs = paired_lags(df, lags, centered)
    if not out:
        return Result(lag_rows(pairs), correlation(pairs, centered))
    pairs = sinks.replace_table(pairs, f"{out}/pairs")
    return Result(
        sinks.upsert_table(lag_rows(pairs), f"{out}/points", ["series", "ts", "lag"]),
        _exported(sinks.upsert_table(correlation(pairs, centered), f"{out}/figures", ["series", "lag"]), out),
    )


def differencing(
    df: DataFrame, spec: str = "step,1", out: str | None = None, counts: DataFrame | None = None, skip_first: bool = True
) -> Result:
    levels = difference(df, spec, counts=counts, skip_first=skip_first)
    if out:
        levels = sinks.replace_table(levels, f"{out}/points")
    stats = difference_stats(levels)
    return Result(levels, _exported(sinks.replace_table(stats, f"{out}/figures"), out) if out else stats)


def moving_average(
    df: DataFrame,
    windows: str | Sequence[int] = "5",
    out: str | None = None,
    text: bool = False,
    fmt: str = DATETIME_FORMAT,
    counts: DataFrame | None = None,
) -> Result:
    """With ``text`` the points are also written as lines of text below ``out/text``, their times as ``fmt`` says."""
    points = sma(df, windows, counts=counts)
    if not out:
        return Result(points, sweep_metrics(df, windows, counts))
    points = sinks.replace_table(points, f"{out}/points")
    if text:
        sinks.write_sma_text(points, f"{out}/text", fmt)
    return Result(points, _exported(sinks.replace_table(sma_metrics(points), f"{out}/figures"), out))


def arima(df: DataFrame, out: str | None = None, **model) -> Result:
    errors = arima_ops.arima_errors(df, **model)
    if out:
        errors = sinks.replace_table(errors, f"{out}/errors")
    k, params = arima_ops.model_size_and_text(**model)
    metrics = model_metrics(errors, k, params)
    if not out:
        return Result(arima_ops.arima_points(errors), metrics)
    return Result(
        sinks.replace_table(arima_ops.arima_points(errors), f"{out}/points"),
        _exported(sinks.replace_table(metrics, f"{out}/figures"), out),
    )
