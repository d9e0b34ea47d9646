"""Queries over stations, stored cells and station files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.frames import DAILY, HOURLY, STATS_SQL, daily, hourly, rounded_stats, table
from catalog.series_queries import EVENT_TYPES
from isochron.functions.timekeys import hour_floor, hour_key, reading_time
from isochron.functions.values import analytic_value, blank_to_zero, decode_cell, parse_type_map
from isochron.operators.filters import (
    Condition,
    drop_station_columns,
    keep_where,
    series_with_prefix,
    without_stat_rows,
)
from isochron.operators.profile import (
    column_availability,
    column_profile,
    coverage_summary,
    partial_column_holders,
    profile_rows,
    profile_stations,
    station_gaps,
)
from isochron.operators.reshape import base_name, file_type, merge_wide, to_wide, unpivot_text, upsert_rows, wide_to_series
from isochron.operators.stats import series_stats
from isochron.plans.stations import load_readings
from isochron.sources.station_files import (
    DAILY_COLUMNS,
    HOURLY_COLUMNS,
    file_lines,
    file_tasks,
    fixed_rows,
    line_cells,
    measure_type,
    preferred_files,
)
from isochron.sources.stations import Correction, choose_stations, corrected, station_readings, stations_without_data
from isochron.sources.tables import at_key, date_range, first_rows, latest_per_hour, match_series, time_range, typed_cells, with_key

Query = Callable[[SparkSession, str], DataFrame]

queries: dict[str, Query] = {}
oracles: dict[str, str] = {}


def register(name: str, query: Query, sql: str) -> None:
    queries[name] = query
    oracles[name] = sql


# --- stations -------------------------------------------------------------------------------------
# Every customer is a station: county = nation, open to close year = years of its orders. A station
# whose last year is that of the whole table still has an empty close year, that is, is open.


def raw_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    years = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min(F.year("o_orderdate")).alias("open_year"), F.max(F.year("o_orderdate")).alias("last_year")
    )
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(years, "c_custkey", "left")
    return joined.select(
        F.col("n_name").alias("county"),
        F.col("c_custkey").cast("int").alias("station"),
        F.concat("c_name", F.lit(", "), "c_mktsegment").alias("name"),
        F.col("c_acctbal").alias("height"),
        "open_year",
        F.when(F.col("last_year") < 2001, F.col("last_year")).alias("close_year"),
    )


CORRECTIONS = (Correction("Customer#000000007, BUILDING", "close_year", 9999, 2002),)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corrected(raw_stations(spark, sf_dir), CORRECTIONS)


STATIONS = """years AS (SELECT o_custkey, min(year(o_orderdate)) AS o, max(year(o_orderdate)) AS l FROM orders GROUP BY 1),
stations AS (
  SELECT n_name AS county, CAST(c_custkey AS INTEGER) AS station,
         replace(c_name || ', ' || c_mktsegment, ',', '') AS name, c_acctbal AS height, CAST(o AS INTEGER) AS open_year,
         CAST(CASE WHEN c_name || ', ' || c_mktsegment = 'Customer#000000007, BUILDING'
                    AND coalesce(CASE WHEN l < 2001 THEN l END, 9999) = 9999 THEN 2002
              ELSE coalesce(CASE WHEN l < 2001 THEN l END, 9999) END AS INTEGER) AS close_year
  FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN years ON o_custkey = c_custkey)"""


def station_filter(name: str, query: Callable[[DataFrame], DataFrame], where: str) -> None:
    register(
        name,
        lambda spark, sf_dir: query(stations(spark, sf_dir)),
        f"WITH {STATIONS} SELECT * FROM stations WHERE {where}",
    )


station_filter("station_scan", lambda s: s, "TRUE")
station_filter("station_filter_eq", lambda s: keep_where(s, Condition("county", "=", "NATION_3")), "county = 'NATION_3'")
station_filter(
    "station_filter_cmp",
    lambda s: keep_where(
        s,
        [Condition("height", ">", 0.0), Condition("height", "<=", 5000.0), Condition("open_year", ">=", 1995),
         Condition("close_year", "<", 9999)],
    ),
    "height > 0 AND height <= 5000 AND open_year >= 1995 AND close_year < 9999",
)
station_filter(
    "station_filter_list",
    lambda s: keep_where(
        s,
        [Condition("open_year", "=", [1995, 1996]), Condition("height", "<", [9000.0, 7000.0]),
         Condition("height", ">=", [-500.0, 100.0])],
    ),
    "open_year IN (1995, 1996) AND height < 7000 AND height >= 100",
)
station_filter("station_filter_in", lambda s: keep_where(s, Condition("county", "in", ["NATION_1", "NATION_2"])),
               "county IN ('NATION_1', 'NATION_2')")
station_filter("station_filter_max", lambda s: keep_where(s, Condition("height", "=", "max")),
               "height = (SELECT max(height) FROM stations)")
station_filter("station_filter_above_min", lambda s: keep_where(s, Condition("open_year", ">", "min")),
               "open_year > (SELECT min(open_year) FROM stations)")
station_filter("station_filter_none", lambda s: keep_where(s, Condition("height", None)), "TRUE")
station_filter(
    "station_choice",
    lambda s: choose_stations(s, open_year="<=1996", close_year=9999),
    "open_year <= 1996 AND close_year = 9999",
)
station_filter(
    "station_choice_county",
    lambda s: choose_stations(s, county="NATION_5", open_year=">1995", close_year="none"),
    "county = 'NATION_5' AND open_year > 1995",
)


def order_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows ``station, ts, value``: what a customer ordered per day."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").cast("int").alias("station"), hour_floor(F.col("o_orderdate")).alias("ts"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value"))
    )


ORDER_READINGS = """order_readings AS (
  SELECT CAST(o_custkey AS INTEGER) AS station, date_trunc('hour', o_orderdate) AS ts,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY 1, 2)"""

register(
    "station_join",
    lambda spark, sf_dir: station_readings(
        choose_stations(stations(spark, sf_dir), close_year=9999).select("station", "county", "name"),
        order_readings(spark, sf_dir),
    ),
    f"""WITH {STATIONS}, {ORDER_READINGS}
SELECT station, ts, value, county, name FROM order_readings JOIN stations USING (station) WHERE close_year = 9999""",
)
register(
    "station_no_data",
    lambda spark, sf_dir: stations_without_data(
        stations(spark, sf_dir), time_range(order_readings(spark, sf_dir), start="2001-01-01 00:00:00")
    ),
    f"""WITH {STATIONS}, {ORDER_READINGS}
SELECT * FROM stations WHERE station NOT IN (SELECT station FROM order_readings WHERE ts >= TIMESTAMP '2001-01-01')""",
)

# --- scans ----------------------------------------------------------------------------------------

register(
    "time_range",
    lambda spark, sf_dir: time_range(hourly(spark, sf_dir), "2024-01-05 06:30:00", "2024-01-20 12:59:59"),
    f"""WITH {HOURLY} SELECT * FROM hourly
WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'""",
)
register(
    "date_range",
    lambda spark, sf_dir: date_range(hourly(spark, sf_dir), "2024-01-05", "2024-01-20"),
    f"""WITH {HOURLY} SELECT * FROM hourly
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'""",
)
register("full_scan", hourly, f"WITH {HOURLY} SELECT * FROM hourly")
register("full_scan_daily", daily, f"WITH {DAILY} SELECT * FROM daily")
register(
    "typed_scan",
    lambda spark, sf_dir: typed_cells(
        series_stats(hourly(spark, sf_dir)), {"count": "bigint", "min_ts": "string"}, regex="[a-s].*"
    ),
    f"""WITH {HOURLY}, s AS (SELECT series, count(*) AS n, min(ts) AS a FROM hourly
                          WHERE regexp_full_match(series, '[a-s].*') GROUP BY series)
SELECT series AS "row", 'count' AS col, CAST(n AS VARCHAR) AS value FROM s
UNION ALL SELECT series, 'min_ts', CAST(a AS VARCHAR) FROM s""",
)
register(
    "point_lookup",
    lambda spark, sf_dir: with_key(at_key(hourly(spark, sf_dir), "r-2024010815")),
    f"WITH {HOURLY} SELECT *, 'r-2024010815' AS \"key\" FROM hourly WHERE ts = TIMESTAMP '2024-01-08 15:00:00'",
)
register(
    "first_rows_per_series",
    lambda spark, sf_dir: first_rows(daily(spark, sf_dir), 100),
    f"""WITH {DAILY}
SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY series ORDER BY ts) <= 100""",
)
register(
    "series_by_regex",
    lambda spark, sf_dir: match_series(hourly(spark, sf_dir), "cl.*,view"),
    f"WITH {HOURLY} SELECT * FROM hourly WHERE regexp_full_match(series, 'cl.*|view')",
)
register(
    "series_by_prefix",
    lambda spark, sf_dir: series_with_prefix(hourly(spark, sf_dir), ["c", "pur"]),
    f"WITH {HOURLY} SELECT * FROM hourly WHERE starts_with(series, 'c') OR starts_with(series, 'pur')",
)
register(
    "hour_keys",
    lambda spark, sf_dir: table(spark, sf_dir, "events").select(
        "event_id", hour_floor(F.col("ts")).alias("ts"), hour_key(F.col("ts")).alias("key")
    ),
    """SELECT event_id, date_trunc('hour', ts) AS ts, strftime(ts, 'r-%Y%m%d%H') AS "key" FROM events""",
)


def times_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third row has no date cell and takes its time from the key."""
    events = table(spark, sf_dir, "events")
    date_cell = F.when(F.col("event_id") % 3 != 0, F.substring(F.col("ts").cast("string"), 1, 19))
    return events.select("event_id", reading_time(date_cell, hour_key(F.col("ts"))).alias("ts"))


register(
    "reading_times",
    times_of_rows,
    """SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN date_trunc('second', ts) ELSE date_trunc('hour', ts) END AS ts
FROM events""",
)

# --- casts ----------------------------------------------------------------------------------------


def messy_text() -> Column:
    """Reading as text, in every seventh row each empty, not a number, or padded."""
    kind = F.col("event_id") % 7
    number = F.col("value").cast("string")
    return (
        F.when(kind == 0, "").when(kind == 1, "abc").when(kind == 2, "nan").when(kind == 3, "  ")
        .when(kind == 4, F.concat(F.lit(" "), number, F.lit(" "))).otherwise(number)
    )


def bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "events").select("event_id", messy_text().alias("raw")).filter(F.col("raw") != "")
    return cells.select(
        "event_id",
        analytic_value(F.col("raw"), "zero").alias("value"),
        analytic_value(F.col("raw"), "null").alias("value_or_null"),
    )


register(
    "bad_value_cast",
    bad_values,
    """SELECT event_id, CASE WHEN event_id % 7 IN (1, 2, 3) THEN 0 ELSE CAST(CAST(value AS FLOAT) AS DOUBLE) END AS value,
  CASE WHEN event_id % 7 NOT IN (1, 2, 3) THEN CAST(CAST(value AS FLOAT) AS DOUBLE) END AS value_or_null
FROM events WHERE event_id % 7 <> 0""",
)


def blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    measure = F.when(F.col("event_type") == "click", "rain").when(F.col("event_type") == "view", "rhum").otherwise(
        F.col("event_type")
    )
    return table(spark, sf_dir, "events").select("event_id", blank_to_zero(messy_text(), measure).alias("raw"))


register(
    "blank_to_zero",
    blanks,
    """SELECT event_id, CASE event_id % 7 WHEN 0 THEN b WHEN 1 THEN 'abc' WHEN 2 THEN 'nan'
  WHEN 3 THEN CASE WHEN num THEN '0' ELSE '  ' END WHEN 4 THEN ' ' || CAST(value AS VARCHAR) || ' '
  ELSE CAST(value AS VARCHAR) END AS raw
FROM (SELECT *, event_type IN ('click', 'view') AS num, CASE WHEN event_type IN ('click', 'view') THEN '0' ELSE '' END AS b
      FROM events)""",
)


def typed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = parse_type_map("str(click|view),dbl(err.*),int(sign.*)")
    raw = F.floor("value").cast("string")
    decoded = table(spark, sf_dir, "events").select(
        "event_id", decode_cell(F.col("event_type"), raw, rules).alias("value")
    )
    return decoded.filter(F.col("value").isNotNull())


register(
    "typed_by_name",
    typed_values,
    "SELECT event_id, CAST(floor(value) AS DOUBLE) AS value FROM events WHERE event_type <> 'purchase'",
)

# --- wide and long --------------------------------------------------------------------------------


def _wide_columns(source: str) -> str:
    return ", ".join(f"max(CASE WHEN series = '{e}' THEN value END) AS {e}" for e in EVENT_TYPES) + f" FROM {source}"


register(
    "wide_pivot",
    lambda spark, sf_dir: to_wide(hourly(spark, sf_dir), EVENT_TYPES),
    f"WITH {HOURLY} SELECT ts, {_wide_columns('hourly')} GROUP BY ts",
)
register(
    "wide_unpivot",
    lambda spark, sf_dir: wide_to_series(to_wide(hourly(spark, sf_dir), EVENT_TYPES), "cl.*,view,s.+"),
    f"WITH {HOURLY} SELECT * FROM hourly WHERE series IN ('click', 'view', 'signup')",
)
register(
    "wide_unpivot_lines",
    lambda spark, sf_dir: unpivot_text(
        table(spark, sf_dir, "lineitem"), "l_(quantity|extendedprice|discount|tax)", ("l_orderkey", "l_linenumber")
    ).select("l_orderkey", "l_linenumber", "series", analytic_value(F.col("raw")).alias("value")),
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{c}' AS series, CAST(CAST({c} AS FLOAT) AS DOUBLE) AS value FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
)


def stored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored wide table with keys, date cells that may be missing, and statistics rows."""
    wide = with_key(to_wide(hourly(spark, sf_dir), EVENT_TYPES))
    readings = wide.select(
        "key",
        F.when(F.hour("ts") % 2 == 0, F.substring(F.col("ts").cast("string"), 1, 19)).alias("date"),
        *[F.col(e).cast("string").alias(e) for e in EVENT_TYPES],
    )
    stats = series_stats(hourly(spark, sf_dir)).select(
        F.concat(F.lit("#"), "series").alias("key"), F.col("mean").cast("string").alias("click")
    )
    return readings.unionByName(stats, allowMissingColumns=True)


register(
    "stored_wide_to_series",
    lambda spark, sf_dir: wide_to_series(stored_rows(spark, sf_dir), ".*"),
    f"WITH {HOURLY} SELECT * FROM hourly",
)
register(
    "wide_other_dates",
    lambda spark, sf_dir: wide_to_series(
        to_wide(hourly(spark, sf_dir), EVENT_TYPES)
        .withColumn("date", F.expr("format_string('%02d/%02d/%04d %02dh', day(ts), month(ts), year(ts), hour(ts))"))
        .drop("ts"),
        "cl.*,view",
        fmt="dd/MM/yyyy HH'h'",
    ),
    f"WITH {HOURLY} SELECT * FROM hourly WHERE series IN ('click', 'view')",
)
register(
    "without_stat_rows",
    lambda spark, sf_dir: without_stat_rows(stored_rows(spark, sf_dir)).select("key"),
    f"WITH {HOURLY} SELECT DISTINCT strftime(ts, 'r-%Y%m%d%H') AS \"key\" FROM hourly",
)
register(
    "column_choice",
    lambda spark, sf_dir: drop_station_columns(
        to_wide(hourly(spark, sf_dir), EVENT_TYPES).select(
            "ts", F.col("click").alias("rain_7"), F.col("view").alias("temp_7"), F.col("error").alias("wetb_8")
        ),
        7,
        ["rain"],
    ),
    f"""WITH {HOURLY} SELECT ts, max(CASE WHEN series = 'click' THEN value END) AS rain_7,
  max(CASE WHEN series = 'error' THEN value END) AS wetb_8 FROM hourly GROUP BY ts""",
)
register(
    "last_write_wins",
    lambda spark, sf_dir: latest_per_hour(
        table(spark, sf_dir, "events").select(F.col("event_type").alias("series"), "ts", "value", "event_id"), "event_id"
    ),
    """SELECT event_type AS series, date_trunc('hour', ts) AS ts, max_by(value, event_id) AS value
FROM events GROUP BY 1, 2""",
)


def merged_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows bring two columns, one of them new to the table, for part of the hours."""
    readings = hourly(spark, sf_dir)
    old = to_wide(time_range(readings, stop="2024-01-20 00:00:00"), ["click", "error"])
    new = to_wide(time_range(readings, start="2024-01-10 00:00:00"), ["error", "view"])
    return merge_wide(old, new.withColumn("error", F.col("error") + 1000.0))


register(
    "upsert_merge",
    merged_wide,
    f"""WITH {HOURLY},
old AS (SELECT ts, max(CASE WHEN series = 'click' THEN value END) AS click,
               max(CASE WHEN series = 'error' THEN value END) AS error
        FROM hourly WHERE ts < TIMESTAMP '2024-01-20' GROUP BY ts),
new AS (SELECT ts, max(CASE WHEN series = 'error' THEN value END) + 1000.0 AS error,
               max(CASE WHEN series = 'view' THEN value END) AS view
        FROM hourly WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY ts)
SELECT coalesce(new.ts, old.ts) AS ts, old.click, coalesce(new.error, old.error) AS error, new.view
FROM old FULL JOIN new ON old.ts = new.ts""",
)
register(
    "result_upsert",
    lambda spark, sf_dir: rounded_stats(
        upsert_rows(
            series_stats(hourly(spark, sf_dir)),
            series_stats(match_series(time_range(hourly(spark, sf_dir), start="2024-01-15 00:00:00"), "view,c.*")),
            ["series"],
        )
    ),
    f"""WITH {HOURLY}
SELECT series, {STATS_SQL} FROM hourly
WHERE series NOT IN ('view', 'click') OR ts >= TIMESTAMP '2024-01-15' GROUP BY series""",
)

# --- profiles -------------------------------------------------------------------------------------
# Every customer is a station; its orders are cells, the measure being the order priority. Odd stations
# have hourly, even ones daily files. Orders whose status is P are cells without a value.

MEASURES = ("urgent", "high", "medium", "notspecified", "low")


def order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    measure = F.regexp_replace(F.lower("o_orderpriority"), "[^a-z]", "")
    station = F.col("o_custkey").cast("int")
    return table(spark, sf_dir, "orders").select(
        station.alias("station"),
        F.when(station % 2 == 1, "hly").otherwise("dly").alias("file_type"),
        hour_floor(F.col("o_orderdate")).alias("ts"),
        F.array_position(F.array(*map(F.lit, MEASURES)), measure).cast("int").alias("position"),
        measure.alias("measure"),
        F.concat_ws("_", measure, station).alias("series"),
        F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.col("o_totalprice").cast("string")).alias("raw"),
    )


ORDER_CELLS = """cells AS (
  SELECT CAST(o_custkey AS INTEGER) AS station, CASE WHEN o_custkey % 2 = 1 THEN 'hly' ELSE 'dly' END AS file_type,
         o_orderdate AS ts, regexp_replace(lower(o_orderpriority), '[^a-z]', '', 'g') AS measure,
         o_orderstatus = 'P' AS missing FROM orders),
per_column AS (
  SELECT station, file_type, measure,
         list_position(['urgent', 'high', 'medium', 'notspecified', 'low'], measure) AS p,
         count(*) FILTER (WHERE missing) AS na, min(ts) AS a, max(ts) AS b FROM cells GROUP BY 1, 2, 3),
profile AS (
  SELECT station AS station_id, file_type || station AS filename, min(a) AS min_date, max(b) AS max_date,
         'date;' || string_agg(measure, ';' ORDER BY p) AS columns, file_type AS type,
         'date=0;' || string_agg(measure || '_' || station || '=' || na, ';' ORDER BY p) AS col_na_count,
         'date=0;' || string_agg(measure || '_' || station || '=0', ';' ORDER BY p) AS col_empty_count
  FROM per_column GROUP BY station, file_type),
gaps AS (
  SELECT * FROM (
    SELECT station, file_type, lag(ts) OVER (PARTITION BY station ORDER BY ts) + INTERVAL 1 HOUR AS missing_ts,
           ts AS next_ts FROM (SELECT DISTINCT station, file_type, ts FROM cells))
  WHERE missing_ts <> next_ts)"""

register(
    "station_profile",
    lambda spark, sf_dir: profile_rows(
        profile_stations(order_cells(spark, sf_dir)),
        station_gaps(order_cells(spark, sf_dir)),
        stations(spark, sf_dir),
    ),
    f"""WITH {STATIONS}, {ORDER_CELLS},
m AS (SELECT station, string_agg(strftime(missing_ts, '%Y-%m-%d %H:%M:%S'), '|' ORDER BY missing_ts) AS lines
      FROM gaps GROUP BY station)
SELECT station_id, name AS station_name, filename, min_date, max_date, columns, type, col_na_count,
       col_na_count AS col_null_count, col_empty_count, coalesce(lines, '') AS missing_lines
FROM profile JOIN stations ON station = station_id LEFT JOIN m ON m.station = station_id""",
)
register(
    "station_gap_report",
    lambda spark, sf_dir: station_gaps(order_cells(spark, sf_dir)),
    f"WITH {ORDER_CELLS} SELECT * FROM gaps",
)
register(
    "coverage_summary",
    lambda spark, sf_dir: coverage_summary(profile_stations(order_cells(spark, sf_dir))),
    f"""WITH {ORDER_CELLS},
t AS (SELECT type, count(*) AS n_stations, min(min_date) AS earliest_start, max(min_date) AS latest_start,
             min(max_date) AS earliest_end, max(max_date) AS latest_end FROM profile GROUP BY type)
SELECT *, latest_start AS common_start, earliest_end AS common_end,
  CASE WHEN type = 'hly' THEN CAST(floor((epoch(earliest_end) - epoch(latest_start)) / 86400) AS BIGINT) * 24 END
    AS estimated_rows FROM t""",
)
AVAILABILITY = """held AS (SELECT DISTINCT type, unnest(string_split(columns, ';')) AS "column", station_id FROM profile),
totals AS (SELECT type, count(*) AS n_stations FROM profile GROUP BY type),
available AS (
  SELECT h.type, h."column", count(*) AS n_having, t.n_stations, count(*) = t.n_stations AS is_common
  FROM held h JOIN totals t USING (type) GROUP BY h.type, h."column", t.n_stations)"""
register(
    "column_availability",
    lambda spark, sf_dir: column_availability(profile_stations(order_cells(spark, sf_dir))),
    f"WITH {ORDER_CELLS}, {AVAILABILITY} SELECT * FROM available",
)
register(
    "partial_columns",
    lambda spark, sf_dir: partial_column_holders(profile_stations(order_cells(spark, sf_dir))),
    f"""WITH {ORDER_CELLS}, {AVAILABILITY}
SELECT held.* FROM held JOIN available USING (type, "column") WHERE NOT is_common""",
)
register(
    "column_profile",
    lambda spark, sf_dir: column_profile(
        to_wide(hourly(spark, sf_dir), EVENT_TYPES).withColumn("text", F.when(F.hour("ts") == 3, "").otherwise("x"))
    ),
    f"""WITH {HOURLY}, w AS (SELECT ts, {_wide_columns("hourly")} GROUP BY ts)
{" UNION ALL ".join(
    f'''SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS na_count,
    count(*) FILTER (WHERE {c} IS NULL) AS null_count, 0 AS empty_count FROM w''' for c in ("ts", *EVENT_TYPES)
)}
UNION ALL SELECT 'text', 0, 0, count(*) FILTER (WHERE hour(ts) = 3) FROM w""",
)
register(
    "column_names",
    lambda spark, sf_dir: order_cells(spark, sf_dir)
    .select("series", F.concat("file_type", F.col("station").cast("string")).alias("filename"))
    .distinct()
    .select("series", base_name(F.col("series")).alias("measure"), "filename", file_type(F.col("filename")).alias("type")),
    f"""WITH {ORDER_CELLS}
SELECT DISTINCT measure || '_' || station AS series, measure, file_type || station AS filename, file_type AS type FROM cells""",
)

# --- station files --------------------------------------------------------------------------------
# One zipped file per supplier, written from its daily shipments. Each supplier has a daily file; those
# with an even number also have an hourly one, which then is preferred.

_FILE_SCHEMA = "path string, file_type string, station int, content binary"
_PREAMBLE = ["Station Name: supplier", "", "date:  -  Date and Time (utc)", "rain:  -  Precipitation Amount (mm)"]


def zip_of(kind: str, station: int, text: str) -> bytes:
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(f"{kind}{station}.csv", text)
    return packed.getvalue()


def zip_files(texts: DataFrame) -> DataFrame:
    """A zipped file for each row ``station, file_type, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stations, kinds = batch["station"].to_pylist(), batch["file_type"].to_pylist()
            paths = [f"{k}{s}.zip" for k, s in zip(kinds, stations, strict=True)]
            packed = [zip_of(k, s, t.as_py()) for k, s, t in zip(kinds, stations, batch["text"], strict=True)]
            columns = [pa.array(paths, pa.string()), batch["file_type"], batch["station"], pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "file_type", "station", "content"])

    return texts.select("station", "file_type", "text").mapInArrow(run, _FILE_SCHEMA)


def _start(kind: str, fixed_layout: bool, legend: int) -> tuple[str, str]:
    """What stands above the lines of a file, and what ends each line."""
    if not fixed_layout:
        return "\n".join([*_PREAMBLE, *["Legend"] * legend, "date,ind,rain,ind,temp", ""]), ""
    columns = HOURLY_COLUMNS if kind == "hly" else DAILY_COLUMNS
    return "\n".join([*["Legend"] * (23 if kind == "hly" else 9), ",".join(columns), ""]), "," * (len(columns) - 3)


def supplier_files(spark: SparkSession, sf_dir: str, fixed_layout: bool = False, legend: int = 0) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    days = lines.groupBy(F.col("l_suppkey").cast("int").alias("station"), F.col("l_shipdate").alias("ts")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity"), F.count(F.lit(1)).alias("n")
    )
    # With a number: adaptive execution sees how short the days are, and not how long it takes to zip the files.
    days = days.repartition(file_tasks(spark), "station")
    cells = [F.coalesce(F.substring(F.col("ts").cast("string"), 1, 19), F.lit("")), F.lit("0")]
    cells.append(F.coalesce(F.col("quantity").cast("string"), F.lit("")))
    if not fixed_layout:
        cells.append(F.when(F.col("n") > 1, F.col("n").cast("string")).otherwise(""))
        cells.append(F.when(F.col("n") > 2, F.lit("  ")).otherwise(F.col("n").cast("string")))
    # A file holds one line per calendar day, so its size does not grow with the table. Lines begin with their time.
    ordered = F.sort_array(F.collect_list(F.concat_ws(",", *cells)))
    bodies = days.groupBy("station").agg(F.concat(F.array_join(ordered, "\n"), F.lit("\n")).alias("body"))
    kinds = F.when(F.col("station") % 2 == 0, F.array(F.lit("hly"), F.lit("dly"))).otherwise(F.array(F.lit("dly")))
    text = {}
    for kind in ("hly", "dly"):
        above, end = _start(kind, fixed_layout, legend)
        text[kind] = F.concat(F.lit(above), F.replace("body", F.lit("\n"), F.lit(end + "\n")) if end else F.col("body"))
    files = bodies.select("station", "body", F.explode(kinds).alias("file_type"))
    return zip_files(files.withColumn("text", F.when(F.col("file_type") == "hly", text["hly"]).otherwise(text["dly"])))


SUPPLIER_DAYS = """days AS (
  SELECT CAST(l_suppkey AS INTEGER) AS station, l_shipdate AS ts, sum(CAST(l_quantity AS DECIMAL(18,2))) AS quantity,
         count(*) AS n FROM lineitem GROUP BY 1, 2)"""


def file_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by name alone, as listed from the parts suppliers ship."""
    stations = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("int").alias("station")).distinct()
    kinds = F.when(F.col("station") % 2 == 0, F.array(F.lit("hly"), F.lit("dly"))).otherwise(F.array(F.lit("dly")))
    return preferred_files(stations.select("station", F.explode(kinds).alias("file_type")))


register(
    "source_fallback",
    file_choice,
    """SELECT DISTINCT CAST(l_suppkey AS INTEGER) AS station, CASE WHEN l_suppkey % 2 = 0 THEN 'hly' ELSE 'dly' END AS file_type
FROM lineitem""",
)
register(
    "zip_cells",
    lambda spark, sf_dir: line_cells(file_lines(preferred_files(supplier_files(spark, sf_dir)))).drop("line_no"),
    f"""WITH {SUPPLIER_DAYS},
c AS (SELECT station, CASE WHEN station % 2 = 0 THEN 'hly' ELSE 'dly' END AS file_type, ts,
        unnest([1, 2, 3, 4]) AS position, unnest(['ind_rain', 'rain', 'ind_temp', 'temp']) AS measure,
        unnest(['0', CAST(quantity AS VARCHAR), CASE WHEN n > 1 THEN CAST(n AS VARCHAR) ELSE '' END,
                CASE WHEN n > 2 THEN '0' ELSE CAST(n AS VARCHAR) END]) AS raw FROM days)
SELECT station, file_type, ts, CAST(position AS INTEGER) AS position, measure, measure || '_' || station AS series, raw FROM c""",
)
register(
    "zip_load",
    lambda spark, sf_dir: load_readings(
        line_cells(file_lines(preferred_files(supplier_files(spark, sf_dir)))), ["rain", "ind_t"], "1996-01-01", "2000-12-31"
    ),
    f"""WITH {SUPPLIER_DAYS},
c AS (SELECT 'rain_' || station AS series, ts, CAST(CAST(CAST(quantity AS DOUBLE) AS FLOAT) AS DOUBLE) AS value FROM days
      UNION ALL SELECT 'ind_temp_' || station, ts, n FROM days WHERE n > 1)
SELECT * FROM c WHERE ts BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31'""",
)
register(
    "zip_long_legend",
    lambda spark, sf_dir: file_lines(preferred_files(supplier_files(spark, sf_dir, legend=150)))
    .groupBy("station", "file_type", "header")
    .agg(F.count(F.lit(1)).alias("n")),
    f"""WITH {SUPPLIER_DAYS}
SELECT station, CASE WHEN station % 2 = 0 THEN 'hly' ELSE 'dly' END AS file_type, 'date,ind,rain,ind,temp' AS header,
  count(*) AS n FROM days GROUP BY station""",
)


def fixed_files(spark: SparkSession, sf_dir: str, file_type: str) -> DataFrame:
    """Files of one type, chosen before they are opened."""
    return supplier_files(spark, sf_dir, fixed_layout=True).filter(F.col("file_type") == file_type)


register(
    "zip_fixed_layout",
    lambda spark, sf_dir: load_readings(
        line_cells(file_lines(fixed_files(spark, sf_dir, "dly"), fixed_layout=True)), ["rain"]
    ),
    f"""WITH {SUPPLIER_DAYS}
SELECT 'rain_' || station AS series, ts, CAST(CAST(CAST(quantity AS DOUBLE) AS FLOAT) AS DOUBLE) AS value FROM days""",
)


def _fixed_sql(columns: tuple[str, ...], where: str) -> str:
    """Rows of the standard layout: only the first three columns are filled."""
    zero = {"vappr": "0::DOUBLE", "rhum": "0", "wddir": "0", "irain": "0", "rain": "CAST(quantity AS DOUBLE)"}
    types = {"double": "DOUBLE", "int": "INTEGER", "string": "VARCHAR"}
    cells = [f"{zero.get(c, f'CAST(NULL AS {types[measure_type(c)]})')} AS {c}" for c in columns if c != "date"]
    blank = [c.replace("CAST(NULL AS VARCHAR)", "''") for c in cells]
    return f"WITH {SUPPLIER_DAYS} SELECT station, ts AS \"date\", {', '.join(blank)} FROM days WHERE {where}"


for _kind, _columns, _where in (("hly", HOURLY_COLUMNS, "station % 2 = 0"), ("dly", DAILY_COLUMNS, "true")):
    register(
        "zip_fixed_rows" if _kind == "hly" else "zip_fixed_daily_rows",
        lambda spark, sf_dir, kind=_kind: fixed_rows(file_lines(fixed_files(spark, sf_dir, kind), fixed_layout=True), kind),
        _fixed_sql(_columns, _where),
    )
register(
    "zip_row_cap",
    lambda spark, sf_dir: file_lines(preferred_files(supplier_files(spark, sf_dir)), max_rows=50)
    .groupBy("station", "file_type")
    .agg(F.count(F.lit(1)).alias("n"), F.max("line_no").alias("last")),
    f"""WITH {SUPPLIER_DAYS}
SELECT station, CASE WHEN station % 2 = 0 THEN 'hly' ELSE 'dly' END AS file_type, least(count(*), 50) AS n,
  least(count(*), 50) - 1 AS "last" FROM days GROUP BY station""",
)
