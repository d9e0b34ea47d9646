"""Data quality and coverage of station files and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isochron.functions.values import DECIMAL_MEASURES, WHOLE_MEASURES
from isochron.operators.gaps import gap_report, line_gaps

# Texts that count as a missing cell.
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

COLUMN_SEPARATOR = ";"
GAP_SEPARATOR = "|"

# Fixed value: the columns of the profile file, in order.
PROFILE_COLUMNS = (
    "station_id", "station_name", "filename", "min_date", "max_date", "columns", "type",
    "col_na_count", "col_null_count", "col_empty_count", "missing_lines",
)


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows ``column, na_count, null_count, empty_count`` for the columns of a table, in one pass."""
    names = list(columns or df.columns)

    def counts(name: str) -> Column:
        cell = F.col(f"`{name}`")
        nulls = F.count_if(cell.isNull())
        return F.struct(
            F.lit(name).alias("column"),
            nulls.alias("na_count"),
            nulls.alias("null_count"),
            F.count_if(cell.cast("string") == "").alias("empty_count"),
        )

    return df.agg(F.array(*[counts(n) for n in names]).alias("counts")).select(F.inline("counts"))


def na_to_null(raw: Column, measure: Column) -> Column:
    """Missing-cell texts become NULL, except in the measures where a blank reads as 0."""
    numeric = measure.isin(*DECIMAL_MEASURES, *WHOLE_MEASURES)
    return F.when(~numeric & raw.isin(*NA_TEXTS), F.lit(None)).otherwise(raw)


def profile_stations(cells: DataFrame) -> DataFrame:
    """One row per station file: coverage, columns, and missing-cell counts per column.

    ``cells`` are rows ``station, file_type, ts, position, measure, series, raw``. Counts are reduced
    per column first; only the few columns of a file are then gathered into its row.
    """
    raw = na_to_null(F.col("raw"), F.col("measure"))
    per_column = cells.groupBy("station", "file_type", "position", "measure", "series").agg(
        F.count_if(raw.isNull()).alias("na"),
        F.count_if(raw == "").alias("empty"),
        F.min("ts").alias("min_ts"),
        F.max("ts").alias("max_ts"),
    )
    columns = F.array_sort(F.collect_list(F.struct("position", "measure", "series", "na", "empty")))
    files = per_column.groupBy("station", "file_type").agg(
        F.min("min_ts").alias("min_date"), F.max("max_ts").alias("max_date"), columns.alias("cols")
    )

    def listed(item) -> Column:
        return F.array_join(F.transform("cols", item), COLUMN_SEPARATOR)

    def counted(field: str) -> Column:
        each = listed(lambda c: F.concat(c["series"], F.lit("="), c[field].cast("string")))
        return F.concat(F.lit("date=0" + COLUMN_SEPARATOR), each)  # a reading always has its date

    return files.select(
        F.col("station").alias("station_id"),
        F.concat("file_type", F.col("station").cast("string")).alias("filename"),
        "min_date",
        "max_date",
        F.concat(F.lit("date" + COLUMN_SEPARATOR), listed(lambda c: c["measure"])).alias("columns"),
        F.col("file_type").alias("type"),
        counted("na").alias("col_na_count"),
        counted("na").alias("col_null_count"),
        counted("empty").alias("col_empty_count"),
    )


def station_gaps(cells: DataFrame) -> DataFrame:
    """Gaps per station file: ``station, file_type, line_no, missing_ts, next_ts``.

    A gap is a line whose time is not one hour after that of the line before, so a repeated or an earlier hour is one,
    too. Cells without line numbers are compared in the order of time, each time once, and there is no ``line_no``.
    """
    name = F.concat("file_type", F.col("station").cast("string")).alias("series")
    facts = [
        F.regexp_extract("series", r"(\d+)$", 1).cast("int").alias("station"),
        F.regexp_extract("series", r"^([A-Za-z]+)", 1).alias("file_type"),
    ]
    if "line_no" not in cells.columns:
        times = cells.select("station", "file_type", "ts").distinct()
        gaps = gap_report(times.select(name, "ts", F.lit(0.0).alias("value")))
        return gaps.select(*facts, "missing_ts", "next_ts")
    lines = cells.filter(F.col("position") == 1).select(name, F.col("line_no").alias("rn"), "ts")  # each line has one such cell
    return line_gaps(lines).select(*facts, F.col("rn").alias("line_no"), "missing_ts", "next_ts")


def profile_rows(profile: DataFrame, gaps: DataFrame, stations: DataFrame) -> DataFrame:
    """Profile in the layout of its file: station name added, gaps as one text per station file, in its line order.

    The text grows with the gaps of one file; use :func:`station_gaps` where they are many.
    """
    place = [c for c in ("line_no", "missing_ts") if c in gaps.columns]
    ordered = F.array_sort(F.collect_list(F.struct(*place)))
    texts = F.transform(ordered, lambda gap: F.substring(gap["missing_ts"].cast("string"), 1, 19))
    missing = gaps.groupBy(F.col("station").alias("station_id"), F.col("file_type").alias("type")).agg(
        F.array_join(texts, GAP_SEPARATOR).alias("missing_lines")
    )
    names = stations.select(F.col("station").alias("station_id"), F.col("name").alias("station_name"))
    joined = profile.join(names, "station_id").join(missing, ["station_id", "type"], "left")
    return joined.withColumn("missing_lines", F.coalesce("missing_lines", F.lit(""))).select(*PROFILE_COLUMNS)


def coverage_summary(profile: DataFrame) -> DataFrame:
    """Per file type: first and last starts and ends, the span all stations cover, and its size.

    ``estimated_rows`` is 24 times the days of the common span, for hourly files only.
    """
    per_type = profile.groupBy("type").agg(
        F.count(F.lit(1)).alias("n_stations"),
        F.min("min_date").alias("earliest_start"),
        F.max("min_date").alias("latest_start"),
        F.min("max_date").alias("earliest_end"),
        F.max("max_date").alias("latest_end"),
    )
    # Whole days of the span, rounded down as a day count of a time span is.
    start, end = F.col("latest_start"), F.col("earliest_end")
    whole = F.datediff(end, start)
    time_of_day = [F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t) for t in (start, end)]
    days = whole - F.when(time_of_day[1] < time_of_day[0], 1).otherwise(0)
    return per_type.select(
        "*",
        F.col("latest_start").alias("common_start"),
        F.col("earliest_end").alias("common_end"),
        F.when(F.col("type") == "hly", days * 24).alias("estimated_rows"),
    )


def station_ids(profile: DataFrame) -> DataFrame:
    """Rows ``type, station_id``: the stations that have a file of a type."""
    return profile.select("type", "station_id").distinct()


def column_holders(profile: DataFrame) -> DataFrame:
    """Rows ``type, column, station_id``: which station has which column."""
    return profile.select("type", F.explode(F.split("columns", COLUMN_SEPARATOR)).alias("column"), "station_id").distinct()


def column_availability(profile: DataFrame) -> DataFrame:
    """Per type and column: the number of stations that have it, and whether all of them do."""
    totals = profile.groupBy("type").agg(F.count_distinct("station_id").alias("n_stations"))
    holders = column_holders(profile).groupBy("type", "column").agg(F.count(F.lit(1)).alias("n_having"))
    return holders.join(totals, "type").select(
        "type", "column", "n_having", "n_stations", (F.col("n_having") == F.col("n_stations")).alias("is_common")
    )


def partial_column_holders(profile: DataFrame) -> DataFrame:
    """The stations that have a column which not all stations of the type have."""
    partial = column_availability(profile).filter(~F.col("is_common")).select("type", "column")
    return column_holders(profile).join(partial, ["type", "column"], "left_semi")
