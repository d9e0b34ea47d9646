"""Step and seasonal differencing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.functions.specs import differencing_spec
from isochron.operators.rows import ROWS_PER_BLOCK, in_row_block, index_rows, row_blocks
from isochron.operators.stats import STATS, stat_aggregates


def checked_spec(spec: str) -> tuple[str, int]:
    kind, n = differencing_spec(spec)
    if n < 0 or (kind == "season" and n < 1):
        raise ValueError(f"differencing needs a positive width: {spec!r}")
    return kind, n


def first_rows_skipped(kind: str, n: int, level: int, skip_first: bool = True) -> int:
    """Rows without a value at a level: with ``skip_first`` the first reading (or first season) is never a subtrahend."""
    if level == 0:
        return 0
    return n * (1 + skip_first) if kind == "season" else level + skip_first


def add_levels(blocked: DataFrame, kind: str, n: int) -> DataFrame:
    """Add ``level_0..level_k`` to row-blocked rows whose halo is at least ``n``.

    Levels are not masked yet; see :func:`first_rows_skipped`.
    """
    rows = blocked.withColumn("level_0", F.col("value"))
    if kind == "season":
        return rows.withColumn("level_1", F.col("value") - F.lag("value", n).over(in_row_block()))
    for i in range(1, n + 1):
        below = f"level_{i - 1}"
        rows = rows.withColumn(f"level_{i}", F.col(below) - F.lag(below).over(in_row_block()))
    return rows


def level_columns(
    df: DataFrame,
    kind: str,
    n: int,
    rows_per_block: int = ROWS_PER_BLOCK,
    counts: DataFrame | None = None,
    skip_first: bool = True,
) -> DataFrame:
    """``series, ts, level_0..``: one row per reading, a level being NULL on the rows it does not reach."""
    rows = row_blocks(index_rows(df, counts=counts).select("series", "ts", "value", "rn"), n, rows_per_block)
    reached = [
        F.when(F.col("rn") >= first_rows_skipped(kind, n, i, skip_first), F.col(f"level_{i}")).alias(f"level_{i}")
        for i in range((1 if kind == "season" else n) + 1)
    ]
    return add_levels(rows, kind, n).filter(~F.col("is_copy")).select("series", "ts", *reached)


def difference(
    df: DataFrame,
    spec: str = "step,1",
    rows_per_block: int = ROWS_PER_BLOCK,
    counts: DataFrame | None = None,
    skip_first: bool = True,
) -> DataFrame:
    """All levels of ``'step,N'`` (0..N) or ``'season,N'`` (0 and 1); empty or ``'step,0'`` passes through.

    ``counts`` are those of the rows where they are stored. Without ``skip_first`` a level begins at the first row that
    has something to be subtracted from it. Output: ``series, ts, level, value``.
    """
    kind, n = checked_spec(spec)
    if n == 0:
        return df.select("series", "ts", F.lit(0).alias("level"), "value")
    levels = level_columns(df, kind, n, rows_per_block, counts, skip_first)
    listed = [F.struct(F.lit(i).alias("level"), F.col(c).alias("value")) for i, c in enumerate(levels.columns[2:])]
    return levels.select("series", "ts", F.inline(F.array(*listed))).filter(F.col("value").isNotNull())


def difference_stats(levels: DataFrame) -> DataFrame:
    return levels.groupBy("series", "level").agg(*stat_aggregates())


def level_stats(df: DataFrame, spec: str = "step,1") -> DataFrame:
    """What :func:`difference_stats` gives of :func:`difference`, without a row for each reading and level."""
    kind, n = checked_spec(spec)
    if n == 0:
        return difference_stats(difference(df, spec))
    levels = level_columns(df, kind, n)
    names = levels.columns[2:]
    times = [F.when(F.col(c).isNotNull(), F.col("ts")).alias(f"ts_{c}") for c in names]
    rows = levels.select("series", *names, *times)
    figures = {c: dict(zip(STATS, stat_aggregates(c, f"ts_{c}"), strict=True)) for c in names}
    found = rows.groupBy("series").agg(*[a.alias(f"{name}_{c}") for c, own in figures.items() for name, a in own.items()])
    per_level = [
        F.struct(F.lit(i).alias("level"), *[F.col(f"{name}_{c}").alias(name) for name in own])
        for i, (c, own) in enumerate(figures.items())
    ]
    return found.select("series", F.inline(F.array(*per_level))).filter(F.col("count") > 0)
