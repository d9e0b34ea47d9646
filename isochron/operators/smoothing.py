"""Simple moving average and its residuals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isochron.functions.specs import range_spec
from isochron.functions.timekeys import DATETIME_FORMAT, shown_time
from isochron.operators.metrics import error_sums, model_figures, model_metrics
from isochron.operators.rows import ROWS_PER_BLOCK, in_row_block, index_rows, row_blocks


def _doubled(rows: DataFrame, longest: int) -> DataFrame:
    """Add ``sum_1, sum_2, sum_4, ..``: the sums of that many rows up to each row, as far as there are rows.

    Each is the sum before it plus the one as many rows earlier. Nothing is subtracted, so a NaN, an infinity or a very
    large reading is gone with the row that leaves the window, whatever the window's size.
    """
    rows = rows.withColumn("sum_1", F.coalesce("value", F.lit(0.0)))
    size = 1
    while 2 * size <= longest:
        earlier = F.coalesce(F.lag(f"sum_{size}", size).over(in_row_block()), F.lit(0.0))
        rows = rows.withColumn(f"sum_{2 * size}", F.col(f"sum_{size}") + earlier)
        size *= 2
    return rows


def _moving_average(size: int) -> Column:
    """A window is laid out with sums of 1, 2, 4, .. rows, one for each binary digit of its size."""
    total, at = None, 0
    for bit in reversed(range(size.bit_length())):
        if size >> bit & 1:
            part = F.col(f"sum_{1 << bit}")
            part = F.coalesce(F.lag(part, at).over(in_row_block()), F.lit(0.0)) if at else part
            total = part if total is None else total + part
            at += 1 << bit
    readings = F.col("readings") - F.coalesce(F.lag("readings", size).over(in_row_block()), F.lit(0))
    return F.try_divide(total, readings)


def _sizes(windows: str | int | list[int]) -> list[int]:
    sizes = list(dict.fromkeys(range_spec(windows)))
    if not sizes or min(sizes) < 1:
        raise ValueError(f"window sizes must be at least 1: {windows!r}")
    return sizes


def moving_averages(
    df: DataFrame, sizes: list[int], rows_per_block: int = ROWS_PER_BLOCK, counts: DataFrame | None = None
) -> DataFrame:
    """``series, ts, value, ma_<size>..``: one row per reading; all sizes share one shuffle and one sort."""
    rows = row_blocks(index_rows(df, counts=counts).select("series", "ts", "value", "rn"), max(sizes) - 1, rows_per_block)
    so_far = in_row_block().rowsBetween(Window.unboundedPreceding, 0)
    rows = _doubled(rows.withColumn("readings", F.count("value").over(so_far)), max(sizes))
    averaged = rows.select("*", *[_moving_average(n).alias(f"ma_{n}") for n in sizes])
    return averaged.filter(~F.col("is_copy")).select("series", "ts", "value", *[f"ma_{n}" for n in sizes])


def sma(
    df: DataFrame,
    windows: str | int | list[int] = 5,
    rows_per_block: int = ROWS_PER_BLOCK,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Moving average over the last ``n`` rows (fewer during warm-up) for every window size asked for.

    ``counts`` are those of the rows where they are stored; see :func:`isochron.operators.rows.index_rows`. Output: ``series, ts, window_size, actual, moving_avg, error, sq_error``.
    """
    sizes = _sizes(windows)
    per_size = [F.struct(F.lit(n).alias("window_size"), F.col(f"ma_{n}").alias("moving_avg")) for n in sizes]
    error = F.col("value") - F.col("moving_avg")
    return (
        moving_averages(df, sizes, rows_per_block, counts)
        .select("series", "ts", "value", F.inline(F.array(*per_size)))
        .select(
            "series",
            "ts",
            "window_size",
            F.col("value").alias("actual"),
            "moving_avg",
            error.alias("error"),
            (error * error).alias("sq_error"),
        )
    )


def sma_metrics(points: DataFrame) -> DataFrame:
    """Metrics per series and window size of the output of :func:`sma`; one model parameter (k = 1)."""
    return model_metrics(points, 1, _named_size(), by=("series", "window_size"))


def sweep_metrics(df: DataFrame, windows: str | int | list[int] = "1-10", counts: DataFrame | None = None) -> DataFrame:
    """What :func:`sma_metrics` gives of :func:`sma`, without a row for each reading and size.

    The sums of every size are taken in one aggregation; only a row per series is then spread over the sizes.
    """
    sizes = _sizes(windows)
    sums = {n: error_sums(F.col("value"), F.col("value") - F.col(f"ma_{n}")) for n in sizes}
    found = moving_averages(df, sizes, counts=counts).groupBy("series").agg(
        *[c.alias(f"{name}_{n}") for n, own in sums.items() for name, c in own.items()]
    )
    per_size = [
        F.struct(F.lit(n).alias("window_size"), *[F.col(f"{name}_{n}").alias(name) for name in own]) for n, own in sums.items()
    ]
    return model_figures(found.select("series", F.inline(F.array(*per_size))), 1, _named_size(), ("series", "window_size"))


def _named_size() -> Column:
    return F.concat(F.lit("windowSize="), F.col("window_size"))


def sma_text(points: DataFrame, fmt: str = DATETIME_FORMAT) -> DataFrame:
    """Text line per point: ``name<TAB>time: actual: .. moving avg: .. error .. sq error ..``, the time as ``fmt`` says."""
    # Fixed value: the line format.
    line = "%s\t%s: actual: %5.2f  moving avg: %5.2f  error %5.2f  sq error %5.2f"
    return points.select(
        F.format_string(line, "series", shown_time(F.col("ts"), fmt), "actual", "moving_avg", "error", "sq_error").alias("value")
    )
