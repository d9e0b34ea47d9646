"""Station metadata."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.functions.specs import year_spec

# The columns of the station file, in order, the year that stands for "still open", and the title by
# which the header line is known.
STATION_SCHEMA = (
    "county STRING, station INT, name STRING, height DOUBLE, easting DOUBLE, northing DOUBLE, "
    "latitude DOUBLE, longitude DOUBLE, open_year INT, close_year INT"
)
NOT_CLOSED = 9999
STATION_TITLE = "Station Number"


class Correction(NamedTuple):
    """Replace ``wrong`` by ``right`` in a column of the named station."""

    name: str
    column: str
    wrong: int
    right: int


# Fixed value: the known error of the station file.
KNOWN_CORRECTIONS = (Correction("CASTLEMAGNER", "close_year", 0, 2002),)


def corrected(stations: DataFrame, corrections: Sequence[Correction] = KNOWN_CORRECTIONS) -> DataFrame:
    """Year left empty means still open; apply the corrections; strip commas from names."""
    out = stations.withColumn("close_year", F.coalesce("close_year", F.lit(NOT_CLOSED)))
    for fix in corrections:
        hit = (F.col("name") == fix.name) & (F.col(fix.column) == fix.wrong)
        out = out.withColumn(fix.column, F.when(hit, fix.right).otherwise(F.col(fix.column)))
    return out.withColumn("name", F.translate("name", ",", ""))


class CheckedStations(NamedTuple):
    """Stations, and what was wrong with the file: ``file, line, column, reason``, one row for each fault."""

    stations: DataFrame
    faults: DataFrame


def read_stations(spark: SparkSession, path: str, corrections: Sequence[Correction] = KNOWN_CORRECTIONS) -> DataFrame:
    """Read the station file: a title row, a header row, one row per station; see :func:`read_stations_checked`."""
    return read_stations_checked(spark, path, corrections).stations


def read_stations_checked(
    spark: SparkSession, path: str, corrections: Sequence[Correction] = KNOWN_CORRECTIONS
) -> CheckedStations:
    """Stations of the file, and its faults.

    The title is the line without a separator, the header that with the title of the station column. A row without a
    usable station number is left out, other cells that are no numbers read as missing; both are faults, and so is a row
    that has not as many cells as there are columns.
    """
    columns = [tuple(c.split()) for c in STATION_SCHEMA.split(", ")]
    as_text = ", ".join(f"{name} STRING" for name, _ in columns)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    lines = lines.filter((F.trim("value") != "") & F.col("value").contains(","))
    cells = lines.select("file", "value", F.from_csv("value", as_text).alias("row"))
    rows = cells.select("file", "value", "row.*").filter(~F.trim("station").eqNullSafe(STATION_TITLE))
    parsed = {name: F.trim(name).try_cast(kind) for name, kind in columns}
    parsed["station"] = F.when(F.trim("station").rlike(r"^\d+$"), parsed["station"])
    faults = []
    for name, kind in columns:
        if kind != "STRING":
            given = F.coalesce(F.trim(name), F.lit(""))
            broken = parsed[name].isNull() & ((given != "") | F.lit(name == "station"))
            whole = F.when(given.rlike(r"^\d+$"), "number too large").otherwise(F.when(given == "", "missing").otherwise("not a number"))
            faults.append(F.when(broken, F.struct(F.lit(name).alias("column"), whole.alias("reason"))))
    length = F.size(F.split("value", ',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1))
    uneven = F.when(length < len(columns), "too few cells").when(length > len(columns), "too many cells")
    faults.append(F.when(uneven.isNotNull(), F.struct(F.lit("").alias("column"), uneven.alias("reason"))))
    listed = F.filter(F.array(*faults), lambda fault: fault.isNotNull())
    found = rows.select("file", F.col("value").alias("line"), F.inline(listed))
    usable = rows.filter(parsed["station"].isNotNull())
    return CheckedStations(corrected(usable.select(*[c.alias(name) for name, c in parsed.items()]), corrections), found)


def choose_stations(
    stations: DataFrame,
    county: str | None = None,
    open_year: int | str | None = None,
    close_year: int | str | None = None,
    number: int | Sequence[int] | None = None,
) -> DataFrame:
    """Stations by county, by opening and closing year (``1990``, ``'<1990'`` ..) and by number."""
    tests: list[Column | None] = [
        F.col("county") == county if county not in (None, "none") else None,
        year_spec(open_year, F.col("open_year")),
        year_spec(close_year, F.col("close_year")),
    ]
    if isinstance(number, int):
        tests.append(F.col("station") == number)
    elif number is not None and number != "none":
        tests.append(F.col("station").isin(*number))
    for test in tests:
        if test is not None:
            stations = stations.filter(test)
    return stations


def station_readings(stations: DataFrame, readings: DataFrame, key: str = "station") -> DataFrame:
    """Readings of the chosen stations; Spark broadcasts the stations where their size allows it."""
    return readings.join(stations, key, "inner")


def stations_without_data(stations: DataFrame, readings: DataFrame, key: str = "station") -> DataFrame:
    return stations.join(readings.select(key), key, "left_anti")
