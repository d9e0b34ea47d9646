"""Reading stored tables and turning event or fact tables into the canonical frame."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.functions.timekeys import hour_floor, hour_key, ntz_literal
from isochron.functions.values import as_float32
from isochron.operators.rows import count_blocks, key_rows_by_month, leading_rows


def to_series(df: DataFrame, series: Column, ts: Column, value: Column, scale: int | None) -> DataFrame:
    """Canonical frame from raw measurements: those of one series and hour are added up.

    With a ``scale`` the sum is taken in decimals of that many places, so it does not depend on the order of rows; give
    the places that the measurements have, since further ones are rounded away. With None doubles are added as they are.
    Sums are pre-aggregated before the shuffle. The result has float32 precision.
    """
    exact = value.cast("double") if scale is None else value.cast(f"decimal(38,{scale})")
    return (
        df.select(series.cast("string").alias("series"), hour_floor(ts).alias("ts"), exact.alias("value"))
        .filter(F.col("series").isNotNull() & F.col("ts").isNotNull())
        .groupBy("series", "ts")
        .agg(as_float32(F.sum("value").cast("double")).alias("value"))
    )


def latest_per_hour(df: DataFrame, order: str) -> DataFrame:
    """One row per series and hour: the one with the highest ``order`` wins, as in a keyed store."""
    return (
        df.withColumn("ts", hour_floor(F.col("ts")))
        .groupBy("series", "ts")
        .agg(F.max_by("value", order).alias("value"))
    )


def time_range(df: DataFrame, start: str | None = None, stop: str | None = None, ts: str = "ts") -> DataFrame:
    """Rows from ``start`` (inclusive) to ``stop`` (exclusive); minutes and seconds of both are ignored."""
    for bound, is_start in ((start, True), (stop, False)):
        if bound is not None:
            limit = ntz_literal(bound[:13] + ":00:00" if len(bound) > 10 else bound)
            df = df.filter(F.col(ts) >= limit if is_start else F.col(ts) < limit)
    return df


def date_range(df: DataFrame, begin: str | None = None, end: str | None = None, ts: str = "ts") -> DataFrame:
    """Readings from ``begin`` to ``end``, both inclusive."""
    if begin is not None:
        df = df.filter(F.col(ts) >= ntz_literal(begin))
    if end is not None:
        df = df.filter(F.col(ts) <= ntz_literal(end))
    return df


def read_series(spark: SparkSession, path: str, start: str | None = None, stop: str | None = None) -> DataFrame:
    """Canonical frame stored as Parquet. The range reaches the scan as a pushed filter and, where the
    table is partitioned by month, leaves out the other months' folders."""
    df = spark.read.parquet(path)
    if "month" in df.columns:
        df = df.filter(F.col("month") >= start[:7]) if start else df
        df = df.filter(F.col("month") <= stop[:7]) if stop else df
        df = df.drop("month")
    return time_range(df, start, stop)


def literal_prefix(regex: str) -> str:
    """Characters that every match of the regex begins with, as far as they are plain to see."""
    if "|" in regex:
        return ""
    plain = re.match(r"\w*", regex)[0]
    return plain[:-1] if regex[len(plain) :][:1] in ("*", "?", "{") else plain


def match_series(df: DataFrame, regexes: str | list[str], name: str = "series") -> DataFrame:
    """Rows whose whole series name matches one of the regexes.

    Plain names become an ``IN`` and literal beginnings a ``startsWith``, which reach the scan and skip row groups of
    a table sorted by series; what is left of a regex is matched on the rows that remain.
    """
    listed = regexes.split(",") if isinstance(regexes, str) else regexes
    names = [r for r in listed if re.fullmatch(r"\w+", r)]
    others = [r for r in listed if r not in names]
    tests = [F.col(name).isin(*names)] if names else []
    for regex in others:
        prefix = literal_prefix(regex)
        whole = F.col(name).rlike(f"^(?:{regex})$")
        tests.append(F.col(name).startswith(prefix) & whole if prefix else whole)
    return df.filter(reduce(lambda a, b: a | b, tests))


def typed_cells(df: DataFrame, columns: dict[str, str], name: str = "series", regex: str = "") -> DataFrame:
    """``(row, col, value)`` of the chosen columns, for rows whose whole key matches the regex.

    Values keep their type through the cast and are given as text, since a column may hold any type.
    """
    rows = match_series(df, [regex], name) if regex else df
    typed = rows.select(
        F.col(name).alias("row"), *[F.col(c).cast(t).cast("string").alias(c) for c, t in columns.items()]
    )
    return typed.unpivot(["row"], list(columns), "col", "value")


def at_key(df: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """Point lookup by row key ``r-yyyyMMddHH``; the key becomes a pushed equality on the time."""
    stamp = key[2:]
    return df.filter(
        F.col(ts) == ntz_literal(f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]} {stamp[8:10]}:00:00")
    )


def with_key(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn("key", hour_key(F.col(ts)))


def first_rows(df: DataFrame, limit: int, counts: DataFrame | None = None) -> DataFrame:
    """The first ``limit`` rows of each series in time order (a cap per series, not on the whole)."""
    return leading_rows(df, limit, counts)


COUNTS_SCHEMA = "series string, block_rows long, block_min_ts timestamp_ntz, block_max_ts timestamp_ntz, block_sum double, month string"


def counts_path(path: str) -> str:
    """Where a readings table keeps its counts; Spark passes over folders that begin so when it reads the table."""
    return f"{path.rstrip('/')}/_counts"


def read_counts(spark: SparkSession, path: str, start: str | None = None, stop: str | None = None) -> DataFrame:
    """Counts by series and month of what :func:`read_series` gives for the same range, for the operators' ``counts``.

    They are stored with the readings. Only months that the range cuts into are counted anew.
    """
    stored = spark.read.schema(COUNTS_SCHEMA).parquet(counts_path(path))
    year, month = (F.split_part("month", F.lit("-"), F.lit(i)).cast("bigint") for i in (1, 2))
    cut = sorted({bound[:7] for bound in (start, stop) if bound})
    if start:
        stored = stored.filter(F.col("month") > start[:7])
    if stop:
        stored = stored.filter(F.col("month") < stop[:7])
    whole = stored.select("series", (year * 12 + month).alias("day_block"), "block_rows", "block_min_ts", "block_max_ts", "block_sum")
    if not cut:
        return whole
    edges = time_range(spark.read.parquet(path).filter(F.col("month").isin(cut)), start, stop)
    return whole.unionByName(count_blocks(key_rows_by_month(edges)))
