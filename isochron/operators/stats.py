"""Descriptive statistics, overall and per stratum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isochron.operators.rows import index_rows

STAT_COLUMNS = ("count", "min", "max", "mean", "variance", "std_dev", "min_ts", "max_ts")
STATS = (*STAT_COLUMNS, "sample_variance", "sample_std_dev")


def stat_aggregates(value: str = "value", ts: str = "ts") -> list[Column]:
    """``variance`` is the sum of squared deviations and ``std_dev`` its root, never divided by n.

    The textbook figures are there too, as ``sample_variance`` and ``sample_std_dev``.
    """
    v = F.col(value)
    number = F.when(~F.isnan(v), v)
    m2 = F.regr_sxx(v, v)
    return [
        F.count(v).alias("count"),
        F.min(number).alias("min"),
        F.max(number).alias("max"),
        F.avg(v).alias("mean"),
        m2.alias("variance"),
        F.sqrt(m2).alias("std_dev"),
        F.min(ts).alias("min_ts"),
        F.max(ts).alias("max_ts"),
        F.var_samp(v).alias("sample_variance"),
        F.stddev_samp(v).alias("sample_std_dev"),
    ]


def series_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("series").agg(*stat_aggregates())


def with_stratum(df: DataFrame, num_strata: int, strata_width: int, counts: DataFrame | None = None) -> DataFrame:
    """Stratum of a row: ``floor(row number / width) mod num_strata``; ``counts`` are those of the rows where stored."""
    if num_strata < 1 or strata_width < 1:
        raise ValueError("num_strata and strata_width must be at least 1")
    stratum = F.pmod(F.floor(F.col("rn") / strata_width), F.lit(num_strata)).cast("int")
    return index_rows(df, counts=counts).select("series", "ts", "value", stratum.alias("stratum"))


def describe_series(
    df: DataFrame, num_strata: int = 1, strata_width: int = 1, counts: DataFrame | None = None
) -> DataFrame:
    """Statistics per series (``stratum`` NULL) and, for more than one stratum, per (series, stratum)."""
    if num_strata <= 1:
        return series_stats(df).withColumn("stratum", F.lit(None).cast("int"))
    strata = with_stratum(df, num_strata, strata_width, counts)
    return strata.groupingSets([["series"], ["series", "stratum"]], "series", "stratum").agg(*stat_aggregates())


def wide_stats(stats: DataFrame, num_strata: int) -> DataFrame:
    """One row per series: the overall columns, then each with suffix ``_<stratum>``."""
    names = [c for c in STAT_COLUMNS if c in stats.columns]

    def pick(name: str, stratum: int | None) -> Column:
        here = F.col("stratum").isNull() if stratum is None else F.col("stratum") == stratum
        return F.max(F.when(here, F.col(name))).alias(name if stratum is None else f"{name}_{stratum}")

    strata: list[int | None] = [None, *(range(num_strata) if num_strata > 1 else [])]
    return stats.groupBy("series").agg(*[pick(name, s) for s in strata for name in names])
