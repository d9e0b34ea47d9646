"""Row numbers and bounded row blocks: the base of every order-dependent operator.

A plain ``Window.partitionBy("series")`` sends a whole series to one task. Here a
series is cut twice, so that no task ever has to hold more than a bounded piece
of it, however much of the data one series owns:

* *Day blocks* (``day_block``): a fixed number of calendar days. The canonical
  frame has one row per series and hour, so a block holds at most
  ``24 * DAYS_PER_BLOCK`` rows. Rows are numbered inside a block; the start of
  each block comes from a prefix sum over the block counts, a table with at most
  ~21,500 rows per series (years 1 to 9999). Stored readings have such counts by
  month (``sources.tables.read_counts``); given these, rows are not counted anew.
* *Row blocks* (``row_block``): exactly ``size`` consecutive rows. A look-back of
  ``halo`` rows is served by copying the last ``halo`` rows of a block into the
  next one, so a window inside the block sees what it would see in the series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Both sizes keep a block below the 4,096 rows that a window holds in plain memory.
DAYS_PER_BLOCK = 170
ROWS_PER_BLOCK = 3072
HALO_SHARE = 4  # a row block is at least this many times its halo


def in_row_block() -> WindowSpec:
    """Time order within a row block."""
    return Window.partitionBy("series", "row_block").orderBy("rn")


def _day_block(ts: Column, days: int) -> Column:
    return F.floor(F.unix_date(ts.cast("date")) / days)


def key_rows(df: DataFrame, days_per_block: int | None = None) -> DataFrame:
    days = days_per_block or DAYS_PER_BLOCK
    return df.select("series", "ts", "value", _day_block(F.col("ts"), days).alias("day_block"))


def key_rows_by_month(df: DataFrame) -> DataFrame:
    return df.select("series", "ts", "value", month_number(F.col("ts")).alias("day_block"))


def month_number(ts: Column) -> Column:
    return (F.year(ts) * 12 + F.month(ts)).cast("bigint")


def count_blocks(keyed: DataFrame) -> DataFrame:
    """Rows, bounds and sum of each (series, day block)."""
    return keyed.groupBy("series", "day_block").agg(
        F.count(F.lit(1)).alias("block_rows"),
        F.min("ts").alias("block_min_ts"),
        F.max("ts").alias("block_max_ts"),
        F.sum("value").alias("block_sum"),
    )


def series_blocks(counted: DataFrame) -> DataFrame:
    """One row per (series, day block) of :func:`count_blocks`: its first row number and the series-wide totals."""
    whole = Window.partitionBy("series")
    earlier = whole.orderBy("day_block").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(
        "series",
        "day_block",
        "block_rows",
        F.coalesce(F.sum("block_rows").over(earlier), F.lit(0)).alias("block_start"),
        F.max("block_max_ts").over(earlier).alias("prior_ts"),
        F.sum("block_rows").over(whole).alias("n"),
        F.min("block_min_ts").over(whole).alias("first_ts"),
        (F.sum("block_sum").over(whole) / F.sum("block_rows").over(whole)).alias("mean"),
    )


def number_rows(keyed: DataFrame, blocks: DataFrame, stored: bool = False) -> DataFrame:
    """Row number and time of the previous row for each row, with all columns of its block.

    Two rows of one series and hour are an error: their order, and so every result, would be arbitrary. With ``stored``
    counts it is one, too, if a block has not as many rows as they say.
    """
    twice = F.raise_error(F.concat(F.lit("more than one row per hour in series "), F.col("series")))
    once = lambda c: F.when(F.col("block_prev_ts") == F.col("ts"), twice).otherwise(c)
    block = Window.partitionBy("series", "day_block")
    numbered = keyed.withColumn("block_pos", F.row_number().over(block.orderBy("ts")) - 1).withColumn(
        "block_prev_ts", F.lag("ts").over(block.orderBy("ts"))
    )
    place = F.col("block_start") + F.col("block_pos")
    if stored:
        numbered = numbered.withColumn("found", F.count(F.lit(1)).over(block))
        stale = F.raise_error(F.concat(F.lit("stored counts do not fit the rows of series "), F.col("series")))
        place = F.when(F.col("found").eqNullSafe(F.col("block_rows")), place).otherwise(stale)
    return (
        numbered.join(blocks, ["series", "day_block"], "left" if stored else "inner")
        .withColumn("rn", once(place))
        .withColumn("prev_ts", once(F.coalesce("block_prev_ts", "prior_ts")))
        .drop("block_pos", "block_prev_ts", "block_start", "block_rows", "found", "prior_ts", "day_block")
    )


def index_rows(df: DataFrame, days_per_block: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Add the 0-based row number in time order and per-series facts to each row.

    Output: ``series, ts, value, rn, prev_ts, n, first_ts, mean``. Columns nobody reads are pruned
    by Catalyst, so asking for ``rn`` alone costs no sum or mean. With the ``counts`` of these rows by month, which a
    readings table keeps, the rows are read once; else once more, to be counted.
    """
    if counts is not None:
        return number_rows(key_rows_by_month(df), series_blocks(counts), stored=True)
    keyed = key_rows(df, days_per_block)
    return number_rows(keyed, series_blocks(count_blocks(keyed)))


def leading_rows(df: DataFrame, limit: int, counts: DataFrame | None = None) -> DataFrame:
    """The first ``limit`` rows of each series in time order; only blocks that hold some of them are sorted."""
    keyed = key_rows(df) if counts is None else key_rows_by_month(df)
    blocks = series_blocks(count_blocks(keyed) if counts is None else counts).filter(F.col("block_start") < limit)
    needed = keyed.join(blocks.select("series", "day_block", "block_start"), ["series", "day_block"])
    place = F.row_number().over(Window.partitionBy("series", "day_block").orderBy("ts"))
    return needed.withColumn("rn", F.col("block_start") + place - 1).filter(F.col("rn") < limit).select("series", "ts", "value")


def block_size(halo: int, rows_per_block: int = ROWS_PER_BLOCK) -> int:
    return max(rows_per_block, HALO_SHARE * halo)


def row_blocks(indexed: DataFrame, halo: int, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Assign rows to row blocks and copy each block's last ``halo`` rows into the next block.

    Copies carry ``is_copy = true`` and are to be dropped after the windows have run.
    """
    if halo < 0:
        raise ValueError("halo must not be negative")
    size = block_size(halo, rows_per_block)
    home = F.floor(F.col("rn") / size)
    if halo == 0:
        return indexed.withColumn("row_block", home).withColumn("is_copy", F.lit(False))
    reach = F.floor((F.col("rn") + halo) / size)
    return (
        indexed.withColumn("home_block", home)
        .withColumn("row_block", F.explode(F.sequence(F.col("home_block"), reach)))
        .withColumn("is_copy", F.col("row_block") != F.col("home_block"))
        .drop("home_block")
    )


def spread_over_blocks(per_series: DataFrame, last_block: str) -> DataFrame:
    """Repeat a per-series row for each row block 0..``last_block``.

    Joining such a table on (series, row_block) instead of series keeps a hot series split.
    """
    return per_series.withColumn("row_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(last_block)))).drop(
        last_block
    )
