"""Between wide rows (one column per series) and long rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from isochron.functions.timekeys import DATETIME_FORMAT, hour_floor, reading_time
from isochron.functions.values import analytic_value, as_float32, decode_cell
from isochron.operators.filters import columns_matching


def unpivot_text(wide: DataFrame, regexes: str | Sequence[str] = ".*", ids: Sequence[str] = ("ts",)) -> DataFrame:
    """Long rows ``ids.., series, raw`` of the matching columns; the others are pruned from the scan."""
    chosen = columns_matching(wide.columns, regexes, never=("date", "key", *ids))
    cells = [F.col(f"`{c}`").cast("string").alias(c) for c in chosen]
    return wide.select(*ids, *cells).unpivot(list(ids), chosen, "series", "raw")


def wide_to_series(
    wide: DataFrame,
    regexes: str | Sequence[str] = ".*",
    type_rules: list[tuple[str, str]] | None = None,
    on_bad: str = "zero",
    fmt: str = DATETIME_FORMAT,
) -> DataFrame:
    """Canonical frame of a stored wide table.

    Numeric columns are taken as they are, others as text. The reading time is the ``date`` cell, written as ``fmt``
    says, else the row key. Empty cells are dropped; cells of a series no type rule matches are dropped; bad text follows
    ``on_bad``.
    """
    names = set(wide.columns)
    date_cell = F.col("date").cast("string") if "date" in names else F.lit(None).cast("string")
    if "ts" not in names:
        key = F.col("key") if "key" in names else F.lit(None).cast("string")
        if "key" in names:
            wide = wide.filter(~F.col("key").startswith("#"))
        wide = wide.withColumn("ts", reading_time(date_cell, key, fmt))
    chosen = columns_matching(wide.columns, regexes, never=("date", "key", "ts"))
    if not chosen:
        raise ValueError(f"no column matches {regexes!r}")
    if not type_rules and all(isinstance(wide.schema[c].dataType, NumericType) for c in chosen):
        numbers = wide.select("ts", *[as_float32(F.col(f"`{c}`")).alias(c) for c in chosen])
        return numbers.unpivot(["ts"], chosen, "series", "value").filter(F.col("value").isNotNull()).select(
            "series", "ts", "value"
        )
    cells = unpivot_text(wide, regexes).filter(F.col("raw").isNotNull() & (F.col("raw") != ""))
    raw = F.col("raw")
    value = decode_cell(F.col("series"), raw, type_rules, on_bad) if type_rules else analytic_value(raw, on_bad)
    decoded = cells.select("series", "ts", value.alias("value"))
    return decoded if on_bad == "null" and not type_rules else decoded.filter(F.col("value").isNotNull())


def to_wide(df: DataFrame, series: Sequence[str] | None = None) -> DataFrame:
    """One row per hour, one column per series. Give the series names to save the pass that finds them."""
    hourly = df.select(hour_floor(F.col("ts")).alias("ts"), "series", "value").groupBy("ts")
    return (hourly.pivot("series", list(series)) if series is not None else hourly.pivot("series")).agg(
        F.max("value")
    )


def merge_wide(old: DataFrame, new: DataFrame, key: str = "ts") -> DataFrame:
    """Upsert by hour: cells of ``new`` win where it has the row, all other cells stay."""
    columns = [*old.columns, *[c for c in new.columns if c not in old.columns]]

    def cell(name: str) -> Column:
        if name not in new.columns:
            return F.col(f"old.`{name}`")
        if name not in old.columns:
            return F.col(f"new.`{name}`")
        return F.coalesce(f"new.`{name}`", f"old.`{name}`").alias(name)

    joined = old.alias("old").join(new.alias("new"), F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    return joined.select(*[cell(c) for c in columns])


def upsert_rows(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new``, and those of ``old`` whose key ``new`` does not have. NULL keys match each other."""
    same_key = reduce(lambda a, b: a & b, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys])
    kept = old.alias("old").join(new.alias("new"), same_key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def lag_name(series: str = "series", lag: str = "lag") -> Column:
    """Column name of a lagged series: ``<series>_lag_<hours>``."""
    return F.concat_ws("_", series, F.lit("lag"), F.col(lag))


def level_name(kind: str, series: str = "series", level: str = "level") -> Column:
    """Column name of a differenced series: ``<series>_<kind>_<level>``."""
    return F.concat_ws("_", series, F.lit(kind), F.col(level))


# The patterns of a column name and of a file name.


def base_name(column: Column) -> Column:
    """Measure of a ``<measure>_<station>`` name; empty for a name of another form."""
    return F.regexp_extract(column, r"^(.*)_\d+$", 1)


def file_type(filename: Column) -> Column:
    """Leading letters of a ``<type><station>`` file name."""
    return F.regexp_extract(filename, r"^([A-Za-z]+)\d+", 1)
