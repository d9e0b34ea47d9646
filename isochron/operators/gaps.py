"""Gap detection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.functions.timekeys import hours_after
from isochron.operators.rows import in_row_block, index_rows, row_blocks


def gap_report(df: DataFrame) -> DataFrame:
    """First missing hour of each gap: ``series, missing_ts, next_ts``."""
    expected = hours_after(F.col("prev_ts"), 1)
    return (
        index_rows(df)
        .filter(F.col("prev_ts").isNotNull() & (F.col("ts") != expected))
        .select("series", expected.alias("missing_ts"), F.col("ts").alias("next_ts"))
    )


def line_gaps(lines: DataFrame) -> DataFrame:
    """Lines whose time is not one hour after that of the line before: ``series, rn, missing_ts, next_ts``.

    ``lines`` are rows ``series, rn, ts``, numbered without holes. Long files are compared block by block, the last line
    of each being copied into the next, so no task has to hold a whole file.
    """
    expected = hours_after(F.lag("ts").over(in_row_block()), 1)
    compared = row_blocks(lines, 1).withColumn("missing_ts", expected)
    apart = ~F.col("is_copy") & F.col("missing_ts").isNotNull() & (F.col("ts") != F.col("missing_ts"))
    return compared.filter(apart).select("series", "rn", "missing_ts", F.col("ts").alias("next_ts"))


def missing_hours(gaps: DataFrame) -> DataFrame:
    """Every hour of each gap, ``series, ts``, where the hours go forward."""
    last = hours_after(F.col("next_ts"), -1)
    ahead = gaps.filter(F.col("missing_ts") < F.col("next_ts"))
    return ahead.select("series", F.explode(F.sequence("missing_ts", last, F.expr("INTERVAL 1 HOUR"))).alias("ts"))
