"""Time lag, mean-centring, autocorrelation and autocovariance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isochron.functions.specs import range_spec
from isochron.functions.timekeys import hours_after
from isochron.operators.rows import ROWS_PER_BLOCK, block_size, index_rows


def lag_list(lags: str | int | list[int]) -> list[int]:
    """The lags asked for, with lag 0 always among them."""
    asked = range_spec(lags)
    if any(h < 0 for h in asked):
        raise ValueError(f"lags must not be negative: {lags!r}")
    return sorted({0, *asked})


def center(df: DataFrame) -> DataFrame:
    """Subtract the series mean from every value."""
    return index_rows(df).select("series", "ts", (F.col("value") - F.col("mean")).alias("value"))


def _turns(lags: list[int]) -> tuple[Column, Column, Column]:
    """Whole hours of the previous row and of this one since the series' first, and whether a lag begins between them.

    A lag of h hours is a queue that starts to give values back once h hours have passed, so from then on it trails by a
    constant number of rows: the number of the first row that is h hours or more after the series' first one.
    """

    def hours_in(ts: str) -> Column:
        return F.floor(F.timestamp_diff("SECOND", F.col("first_ts"), F.col(ts)) / 3600).cast("int")

    before, now = hours_in("prev_ts"), hours_in("ts")
    asked = F.array(*map(F.lit, lags))
    turning = (before < max(lags)) & F.exists(asked, lambda h: (h > before) & (h <= now))
    return before, now, F.coalesce(turning, F.lit(False))


def paired_lags(
    df: DataFrame, lags: str | int | list[int] = 1, centered: bool = False, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Each value with its lagged partners: ``series, ts, mean, lag_0, lag_<h>..``.

    ``lag_0`` is the value itself and a partner is NULL where there is nothing to look back to. With
    ``centered`` all of them are less the mean of the series.

    The row at which a lag begins carries the lag's number of rows; it goes to every row block of its series (a row for
    each lag at most), and each row to its own block and, at the end of it, to the next. A block is gathered into one
    sorted array, and partners are taken from it by place.
    """
    hours = [h for h in lag_list(lags) if h > 0]
    rows = index_rows(df)
    x: Column = F.col("value") - F.col("mean") if centered else F.col("value")
    if not hours:
        return rows.select("series", "ts", "mean", x.alias("lag_0"))
    halo = max(hours)
    size = block_size(halo, rows_per_block)
    before, now, turning = _turns(hours)
    home, last = F.floor(F.col("rn") / size), F.floor((F.col("n") - 1) / size)
    reach = F.least(F.floor((F.col("rn") + halo) / size), last)
    rows = rows.select(
        "series", "mean", home.alias("home"), reach.alias("reach"), last.alias("last"), turning.alias("turning"),
        F.struct(F.col("rn"), F.col("ts"), x.alias("x")).alias("own"),
        F.struct(before.alias("before"), now.alias("now"), F.col("rn")).alias("turn"),
    )
    first, end = F.when(F.col("turning"), 0).otherwise(F.col("home")), F.when(F.col("turning"), F.col("last")).otherwise(F.col("reach"))
    placed = rows.withColumn("row_block", F.explode(F.sequence(first, end)))
    in_reach = F.col("row_block").between(F.col("home"), F.col("reach"))
    blocks = placed.groupBy("series", "row_block").agg(
        F.array_sort(F.collect_list(F.when(in_reach, F.col("own")))).alias("held"),
        F.collect_list(F.when(F.col("turning"), F.col("turn"))).alias("turns"),
        F.max("mean").alias("mean"),
    )
    # With at most one row per hour an offset never exceeds its lag; the halo relies on it.
    too_many = F.raise_error(F.concat(F.lit("more than one row per hour in series "), F.col("series"))).cast("bigint")

    def offset(h: int) -> Column:
        here = F.filter("turns", lambda t: (t["before"] < h) & (t["now"] >= h))
        rows = F.get(here, F.lit(0))["rn"]
        return F.when(rows <= h, rows).when(rows.isNotNull(), too_many).alias(f"rows_{h}")

    blocks = blocks.select("series", "row_block", "mean", "held", *map(offset, hours))

    def partners(row: Column) -> Column:
        place = row["rn"] - F.get("held", F.lit(0))["rn"]
        past = [F.get("held", (place - F.col(f"rows_{h}")).cast("int"))["x"].alias(f"lag_{h}") for h in hours]
        return F.struct(row["ts"].alias("ts"), row["x"].alias("lag_0"), *past)

    own = F.filter("held", lambda row: row["rn"] >= F.col("row_block") * size)
    met = blocks.select("series", "mean", F.inline(F.transform(own, partners)))
    return met.select("series", "ts", "mean", "lag_0", *[f"lag_{h}" for h in hours])


def _lags_of(pairs: DataFrame) -> list[int]:
    return [int(c.removeprefix("lag_")) for c in pairs.columns if c.startswith("lag_")]


def lag_rows(pairs: DataFrame) -> DataFrame:
    """Long form of :func:`paired_lags`: ``series, ts, lag, value``, without the empty ones."""
    per_lag = [F.struct(F.lit(h).alias("lag"), F.col(f"lag_{h}").alias("value")) for h in _lags_of(pairs)]
    return pairs.select("series", "ts", F.inline(F.array(*per_lag))).filter(F.col("value").isNotNull())


def lag_series(df: DataFrame, lags: str | int | list[int] = 1, centered: bool = False) -> DataFrame:
    """Value ``lag`` hours earlier, for lag 0 and those asked for (see ``_turns`` for gaps)."""
    return lag_rows(paired_lags(df, lags, centered))


def exact_lags(df: DataFrame, lags: str | int | list[int] = 1) -> DataFrame:
    """Value exactly ``lag`` hours earlier, for lag 0 and those asked for; nothing where that hour has no reading.

    Each row goes to the hours it is the past of, and meets the rows there in one shuffle on series and hour.
    """
    hours = lag_list(lags)
    places = F.array(*[F.struct(F.lit(h).alias("lag"), hours_after(F.col("ts"), h).alias("place")) for h in hours])
    met = df.select("series", "value", F.inline(places)).groupBy("series", F.col("place").alias("ts")).agg(
        *[F.max(F.when(F.col("lag") == h, F.col("value"))).alias(f"lag_{h}") for h in hours],
        F.bool_or(F.col("lag") == 0).alias("read"),
    )
    return lag_rows(met.filter("read").drop("read"))


def textbook_autocovariance(df: DataFrame, lags: str | int | list[int] = 1) -> DataFrame:
    """``series, lag, autocovariance``: the mean product of centred values, nothing being subtracted after that."""
    pairs = paired_lags(df, lags, centered=True)
    hours = _lags_of(pairs)
    sums = pairs.groupBy("series").agg(
        *[F.sum(F.col("lag_0") * F.col(f"lag_{h}")).alias(f"product_{h}") for h in hours], F.count(F.lit(1)).alias("n")
    )
    per_lag = F.array(
        *[F.struct(F.lit(h).alias("lag"), F.coalesce(f"product_{h}", F.lit(0.0)).alias("product")) for h in hours]
    )
    listed = sums.select("series", "n", F.inline(per_lag))
    return listed.select("series", "lag", (F.col("product") / F.col("n")).alias("autocovariance"))


def correlation(pairs: DataFrame, centered: bool = False) -> DataFrame:
    """Output: ``series, lag, autocorrelation`` and, if centred, ``autocovariance``.

    autocorrelation = sum(x_t * x_lagged) / sum(x_t^2), the lower sum over all rows;
    autocovariance = sum(x_t * x_lagged) / n - mean^2, the mean being that of the raw values.
    """
    hours = _lags_of(pairs)
    products = [F.sum(F.col("lag_0") * F.col(f"lag_{h}")).alias(f"product_{h}") for h in hours]
    sums = pairs.groupBy("series").agg(*products, F.count(F.lit(1)).alias("n"), F.max("mean").alias("mean"))
    per_lag = F.array(
        *[F.struct(F.lit(h).alias("lag"), F.coalesce(f"product_{h}", F.lit(0.0)).alias("product")) for h in hours]
    )
    listed = sums.select("series", "n", "mean", F.col("product_0").alias("energy"), F.inline(per_lag))
    # try_divide: an all-zero series has no autocorrelation
    figures = [F.try_divide(F.col("product"), F.col("energy")).alias("autocorrelation")]
    if centered:
        figures.append((F.col("product") / F.col("n") - F.col("mean") * F.col("mean")).alias("autocovariance"))
    return listed.select("series", "lag", *figures)


def autocorrelation(df: DataFrame, lags: str | int | list[int] = 1, centered: bool = False) -> DataFrame:
    """Autocorrelation of every series at lag 0 and the lags asked for; see :func:`correlation`."""
    return correlation(paired_lags(df, lags, centered), centered)
