"""Writing results."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron import monthly
from isochron.functions.timekeys import DATETIME_FORMAT, month_of
from isochron.operators.profile import PROFILE_COLUMNS
from isochron.operators.reshape import merge_wide, upsert_rows
from isochron.operators.rows import count_blocks
from isochron.operators.smoothing import sma_text
from isochron.sources.tables import counts_path

READINGS_SCHEMA = "series string, ts timestamp_ntz, value double, month string"


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a result table anew; what comes back reads the stored rows."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def read_table(spark: SparkSession, path: str, start: str | None = None, stop: str | None = None) -> DataFrame | None:
    """An upserted table, or ``None`` where there is none; with a range, the months that it touches."""
    return monthly.read(spark, path, start, stop)


def upsert_table(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Merge into a result table: rows of ``df`` win over stored ones with the same keys.

    A table keyed by time is kept by month, and only the months that ``df`` touches are rewritten; see
    :mod:`isochron.monthly`. For readings see :func:`upsert_readings`.
    """
    by = "ts" if "ts" in keys else None
    return monthly.upsert(df, path, lambda old, new: upsert_rows(old, new, keys), by, sort=keys)


def upsert_readings(df: DataFrame, path: str) -> DataFrame:
    """Merge canonical rows into the long readings table, which is partitioned by month.

    Only the months that ``df`` touches are read and rewritten. The new rows are computed once: they are stored beside
    the table first, and the merge reads them from there. The counts of these months by series are kept with the table;
    see :func:`isochron.sources.tables.read_counts`.
    """
    spark, files = df.sparkSession, monthly.Files(df.sparkSession, path)
    staged, months = None, None
    new = df.select("series", "ts", "value", month_of(F.col("ts")).alias("month"))
    if files.exists(path):
        old = spark.read.schema(READINGS_SCHEMA).parquet(path)
        staged = f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"  # of this writer alone
        new = replace_table(new, staged)
        # The months touched, as literals so that the scan skips the others: 12 a year at most.
        months = [row.month for row in new.select("month").distinct().collect()]
        touched = old.filter(F.col("month").isin(months))
        new = upsert_rows(touched.select(*new.columns), new, ["series", "ts"])
    # Rebalancing gives each month whole files of a good size and splits a month that is too large.
    laid_out = new.hint("rebalance", F.col("month")).sortWithinPartitions("month", "series", "ts")
    writer = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("month").parquet(path)
    table = spark.read.schema(READINGS_SCHEMA).parquet(path)
    everything = months is None or not files.exists(counts_path(path))
    written = table if everything else table.filter(F.col("month").isin(months))
    counted = count_blocks(written.select("series", F.col("month").alias("day_block"), "ts", "value"))
    # few rows: a file for each month
    kept = counted.withColumnRenamed("day_block", "month").hint("rebalance", F.col("month"))
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(counts_path(path))
    if staged:
        files.remove(staged)
    return table


def upsert_wide(df: DataFrame, path: str) -> DataFrame:
    """Merge wide rows (``ts`` and a column per series) into the wide table at ``path``, which is kept by month.

    Cells of ``df`` win, other cells stay, new columns are added. Months that ``df`` does not touch are neither read
    nor rewritten; a column they do not have reads as null, which the table's list of columns says without opening them.
    """
    return monthly.upsert(df, path, merge_wide, "ts", sort=["ts"])


def read_wide(spark: SparkSession, path: str, start: str | None = None, stop: str | None = None) -> DataFrame | None:
    """The wide table with the columns of all months; with a range, only the rows of the months that it touches."""
    return monthly.read(spark, path, start, stop)


def write_sma_text(points: DataFrame, path: str, fmt: str = DATETIME_FORMAT) -> None:
    sma_text(points, fmt).write.mode("overwrite").text(path)


HEADER_FILE = "000000-header.csv"


def append_csv(rows: DataFrame, path: str) -> None:
    """Append rows, in their order by all columns, to the CSV file whose pieces lie in the folder ``path``.

    The pieces in the order of their names are the file (``cat path/*.csv``): the header is a piece of its own, written
    where the file is new, and the pieces of an append come after those of the appends before it. Rows go from tasks to
    pieces, so an export may be of any size; :func:`read_csv` reads it.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    files = monthly.Files(spark, path)
    draft = f"{path}/.draft-{uuid.uuid4().hex}"
    rows.orderBy(*rows.columns).write.csv(draft)
    header = ",".join(rows.columns)
    try:
        files.write_new(f"{path}/{HEADER_FILE}", header + "\n")
    except FileExistsError:
        found = spark.read.text(f"{path}/{HEADER_FILE}").first()["value"]
        if found != header:
            files.remove(draft)
            raise ValueError(f"{path} has the columns {found}, not {header}") from None
    number = max((int(n.split("-")[0]) for n in files.names(path) if n[:6].isdigit()), default=0) + 1
    for i, name in enumerate(sorted(n for n in files.names(draft) if n.startswith("part-"))):
        files.move(f"{draft}/{name}", f"{path}/{number:06d}-{i:05d}-{uuid.uuid4().hex[:8]}.csv")
    files.remove(draft)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """What :func:`append_csv` has written at ``path``; ``schema`` gives the columns' types."""
    return spark.read.schema(schema).option("pathGlobFilter", "[0-9]*-[0-9]*.csv").csv(path)


def append_metrics_csv(metrics: DataFrame, path: str) -> None:
    """Append rows as CSV, columns in alphabetical order after the series."""
    append_csv(metrics_csv(metrics), path)


def metrics_csv(metrics: DataFrame) -> DataFrame:
    return metrics.select("series", *sorted(c for c in metrics.columns if c != "series"))


def append_profile_csv(profile: DataFrame, path: str) -> None:
    append_csv(profile.select(*PROFILE_COLUMNS), path)


def write_summary(coverage: DataFrame, availability: DataFrame, holders: DataFrame, ids: DataFrame, path: str) -> None:
    """Summary report as JSON lines: coverage per type, columns per type, holders of partial columns, stations per type."""
    ids.write.mode("overwrite").json(f"{path}/stations")
    coverage.write.mode("overwrite").json(f"{path}/coverage")
    availability.write.mode("overwrite").json(f"{path}/columns")
    holders.write.mode("overwrite").json(f"{path}/partial_columns")
