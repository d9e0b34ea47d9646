"""Loading and profiling station files."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron import sinks
from isochron.functions.values import analytic_value
from isochron.operators.filters import series_with_prefix
from isochron.operators.profile import (
    column_availability,
    coverage_summary,
    partial_column_holders,
    profile_rows,
    profile_stations,
    station_gaps,
    station_ids,
)
from isochron.sources.station_files import file_lines, line_cells, list_files, preferred_files
from isochron.sources.tables import date_range, latest_per_hour


class StationProfile(NamedTuple):
    profile: DataFrame
    gaps: DataFrame
    coverage: DataFrame
    availability: DataFrame
    partial_holders: DataFrame


def station_cells(
    spark: SparkSession, folders: str | Sequence[str], stations: DataFrame, max_rows: int | None = None
) -> DataFrame:
    """Cells of the chosen stations' files; of several ``folders``, a station's file is taken from the first that has one.

    Files of other stations are not opened.
    """
    files = list_files(spark, folders).join(stations.select("station"), "station", "left_semi")
    return line_cells(file_lines(preferred_files(files), max_rows=max_rows))


def load_readings(
    cells: DataFrame,
    prefixes: Sequence[str] = (),
    begin: str | None = None,
    end: str | None = None,
    on_bad: str = "zero",
) -> DataFrame:
    """Canonical frame of the wanted measures and dates; the last line of an hour wins."""
    wanted = date_range(cells, begin, end).filter(F.col("raw").isNotNull() & (F.col("raw") != ""))
    if prefixes:
        wanted = series_with_prefix(wanted, prefixes, "series")
    rows = wanted.select("series", "ts", "line_no", analytic_value(F.col("raw"), on_bad).alias("value"))
    latest = latest_per_hour(rows, "line_no")
    return latest if on_bad == "null" else latest.filter(F.col("value").isNotNull())


def profile(cells: DataFrame, stations: DataFrame, out: str | None = None) -> StationProfile:
    """With ``out`` the cells are stored first, so that the files are unzipped once for all results; so are the figures
    of each file. The profile is appended as CSV below ``out/profile`` and the summary written below ``out/summary``.
    """
    if out:
        cells = sinks.replace_table(cells, f"{out}/cells")
    files = profile_stations(cells)
    if out:
        files = sinks.replace_table(files, f"{out}/files")
    gaps = station_gaps(cells)
    found = StationProfile(
        profile_rows(files, gaps, stations),
        gaps,
        coverage_summary(files),
        column_availability(files),
        partial_column_holders(files),
    )
    if out:
        sinks.append_profile_csv(found.profile, f"{out}/profile")
        sinks.write_summary(
            found.coverage, found.availability, found.partial_holders, station_ids(files), f"{out}/summary"
        )
    return found
