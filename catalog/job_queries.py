"""The jobs as a user runs them: results are written, and what is compared is read back from the written files."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import series_queries as series
from catalog import station_queries as station
from catalog.frames import DAILY, HOURLY, METRIC_COLUMNS, STATS_SQL, daily, hourly, r, rounded, rounded_stats
from isochron import sinks
from isochron.operators.profile import PROFILE_COLUMNS
from isochron.operators.reshape import to_wide
from isochron.operators.smoothing import sma, sma_metrics
from isochron.operators.stats import describe_series
from isochron.plans import jobs
from isochron.plans.stations import profile
from isochron.sources.stations import STATION_SCHEMA, read_stations
from isochron.sources.tables import first_rows, read_counts, read_series, time_range

queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
oracles: dict[str, str] = {}


def job(sql: str) -> Callable:
    def register(f: Callable[[SparkSession, str, str], DataFrame]) -> Callable:
        queries[f.__name__] = lambda spark, sf_dir: f(spark, sf_dir, folder(spark, f.__name__))
        oracles[f.__name__] = sql
        return f

    return register


def folder(spark: SparkSession, name: str) -> str:
    """A new output folder where driver and executors can both write."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/jobs/{name}-{uuid.uuid4().hex}"


@job(series.oracles["strata_stats"])
def job_analysis(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    jobs.analysis(hourly(spark, sf_dir), 4, 24, out)
    return rounded_stats(sinks.read_table(spark, out))


@job(series.oracles["sma_metrics"])
def job_moving_average(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    found = jobs.moving_average(hourly(spark, sf_dir), "5", out)
    stored = sinks.read_csv(spark, f"{out}/export", sinks.metrics_csv(found.figures).schema)
    return rounded(stored, METRIC_COLUMNS).select(*found.figures.columns)


@job(f"""WITH {HOURLY} SELECT series || chr(9) || strftime(ts, '%Y-%m-%d %H:%M:%S') || ': actual: '
  || {series._two_decimals("value")} AS value, 5 AS figures FROM hourly""")
def job_moving_average_text(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """Every line up to its averages, which engines round differently in the last place; and how many parts it has."""
    jobs.moving_average(hourly(spark, sf_dir), "5", out, text=True)
    lines = spark.read.text(f"{out}/text")
    parts = F.size(F.split("value", r"\s(?:moving avg:|error|sq error|actual:)\s"))
    return lines.select(F.substring_index("value", "  moving avg:", 1).alias("value"), parts.alias("figures"))


@job(series.oracles["strata_stats"])
def job_analysis_export(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """The figures of the analysis as its CSV file has them."""
    found = jobs.analysis(hourly(spark, sf_dir), 4, 24, out)
    return rounded_stats(sinks.read_csv(spark, f"{out}/export", sinks.metrics_csv(found).schema))


@job(f"WITH {series.sma_sql('hourly', [3, 5])} {series.SMA_METRICS_SQL}")
def metrics_appended(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """Two runs append to one export: one header, and the rows of the second run after those of the first."""
    rows = hourly(spark, sf_dir)
    for size in (3, 5):
        sinks.append_metrics_csv(sma_metrics(sma(rows, size)), out)
    lines = spark.read.text(out)
    if lines.where("value LIKE 'series,%'").count() != 1:
        raise AssertionError("an export has one header")
    schema = sinks.metrics_csv(sma_metrics(sma(rows, 3))).schema
    return rounded(sinks.read_csv(spark, out, schema), METRIC_COLUMNS)


@job(series.oracles["lag_points"])
def job_transform(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    jobs.transform(hourly(spark, sf_dir), "1,24", out=out)
    return sinks.read_table(spark, f"{out}/points")


@job(series.oracles["autocorr_raw"])
def job_transform_figures(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """The figures of the lags as their CSV file has them."""
    found = jobs.transform(hourly(spark, sf_dir), "1,24", out=out)
    return rounded(sinks.read_csv(spark, f"{out}/export", sinks.metrics_csv(found.figures).schema), ["autocorrelation"])


def stored_readings(spark: SparkSession, sf_dir: str, out: str) -> tuple[DataFrame, DataFrame]:
    """A range of the daily readings, from a table that was written in two goes, and their stored counts."""
    rows = daily(spark, sf_dir)
    sinks.upsert_readings(rows.where("ts < TIMESTAMP_NTZ '1996-08-15 00:00:00'"), out)
    sinks.upsert_readings(rows.where("ts >= TIMESTAMP_NTZ '1996-07-20 00:00:00'"), out)
    return read_series(spark, out, *STORED_RANGE), read_counts(spark, out, *STORED_RANGE)


STORED_RANGE = ("1993-02-11 00:00:00", "1999-05-05 00:00:00")
STORED = f"""{DAILY.replace('daily AS', 'all_days AS')},
daily AS (SELECT * FROM all_days WHERE ts >= TIMESTAMP '{STORED_RANGE[0]}' AND ts < TIMESTAMP '{STORED_RANGE[1]}')"""


@job(f"""WITH {series.sma_sql("daily", [5]).replace(DAILY, STORED)}
SELECT series, ts, window_size, {r("moving_avg", "moving_avg")} FROM p""")
def sma_of_stored(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """A moving average numbered by the counts that are kept with the readings."""
    rows, counts = stored_readings(spark, sf_dir, out)
    return rounded(sma(rows, 5, counts=counts), ["moving_avg"]).select("series", "ts", "window_size", "moving_avg")


@job(f"WITH {STORED} SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY series ORDER BY ts) <= 40")
def first_rows_of_stored(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    rows, counts = stored_readings(spark, sf_dir, out)
    return first_rows(rows, 40, counts)


@job(f"""WITH {series.numbered("daily").replace(DAILY, STORED)}, s AS (SELECT series, ts, value, CAST((t // 30) % 8 AS INTEGER) AS stratum FROM n)
SELECT series, stratum, {STATS_SQL} FROM s GROUP BY GROUPING SETS ((series), (series, stratum))""")
def strata_of_stored(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    rows, counts = stored_readings(spark, sf_dir, out)
    return rounded_stats(describe_series(rows, 8, 30, counts))


TWO_MONTHS = ("1995-03-01 00:00:00", "1995-05-01 00:00:00")


@job(f"""WITH {DAILY} SELECT series, ts, 0 AS lag,
  CASE WHEN ts >= TIMESTAMP '{TWO_MONTHS[0]}' AND ts < TIMESTAMP '{TWO_MONTHS[1]}' THEN value * 2 ELSE value END AS value
FROM daily""")
def points_upserted_by_month(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """Two runs of a job, the second over two months with other values: files of other months keep their names."""
    rows = daily(spark, sf_dir)
    jobs.transform(rows, "0", out=out)
    before = set(sinks.read_table(spark, f"{out}/points").inputFiles())
    jobs.transform(time_range(rows, *TWO_MONTHS).withColumn("value", F.col("value") * 2), "0", out=out)
    points = sinks.read_table(spark, f"{out}/points")
    changed = {f.split("month=")[1][:7] for f in before ^ set(points.inputFiles())}
    if not changed <= {"1995-03", "1995-04"}:
        raise AssertionError(f"files of months that nobody wrote to have changed: {sorted(changed)}")
    return points


@job(series.oracles["diff_stats_step2"])
def job_differencing(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    found = jobs.differencing(hourly(spark, sf_dir), "step,2", out)
    return rounded(rounded_stats(found.figures), ["min", "max"])


@job(series.oracles["arima_metrics_full"])
def job_arima(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    return rounded(jobs.arima(hourly(spark, sf_dir), out, p="0.9,0.1", q="0.5", d=1, c=0.0, centered=False).figures, METRIC_COLUMNS)


@job(station.oracles["station_scan"])
def station_file(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """The stations written as a station file, with its title and header lines, and read back from there."""
    names = [c.split()[0] for c in STATION_SCHEMA.split(", ")]
    rows = station.raw_stations(spark, sf_dir)
    cells = [F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string") for c in names]
    lines = rows.select(F.to_csv(F.struct(*[c.alias(n) for c, n in zip(cells, names, strict=True)])).alias("value"))
    top = spark.createDataFrame([("Station details: extracted",), ("County,Station Number," + ",".join(names[2:]),)], "value string")
    top.unionByName(lines).write.text(out)
    return read_stations(spark, out, station.CORRECTIONS).select(*rows.columns)


@job(f"""WITH {HOURLY} SELECT ts, max(CASE WHEN series = 'click' THEN value END) AS click,
  max(CASE WHEN series = 'view' THEN value + 1 END) AS view FROM hourly
WHERE series IN ('click', 'view') GROUP BY ts""")
def wide_table_upsert(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """Two writes: the second brings a column that is new, one that is changed, and keeps the rest."""
    rows = hourly(spark, sf_dir)
    both = to_wide(rows.where("series IN ('click', 'view')"), ["click", "view"])
    sinks.upsert_wide(both.select("ts", (F.col("click") - 5).alias("click"), "view"), out)
    sinks.upsert_wide(both.select("ts", "click", (F.col("view") + 1).alias("view")), out)
    return sinks.read_wide(spark, out).select("ts", "click", "view")


@job(station.oracles["station_profile"])
def job_profile(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """The profile as its CSV file has it."""
    found = profile(station.order_cells(spark, sf_dir), station.stations(spark, sf_dir), out)
    stored = sinks.read_csv(spark, f"{out}/profile", found.profile.select(*PROFILE_COLUMNS).schema)
    return stored.fillna("", ["missing_lines"])


SUMMARY_COLUMNS = ("n_stations", "earliest_start", "latest_start", "earliest_end", "latest_end", "common_start", "common_end", "estimated_rows")


@job(f"""WITH {station.ORDER_CELLS}, {station.AVAILABILITY},
t AS (SELECT type, count(*) AS n_stations, min(min_date) AS earliest_start, max(min_date) AS latest_start,
             min(max_date) AS earliest_end, max(max_date) AS latest_end FROM profile GROUP BY type),
c AS (SELECT *, latest_start AS common_start, earliest_end AS common_end,
  CASE WHEN type = 'hly' THEN CAST(floor((epoch(earliest_end) - epoch(latest_start)) / 86400) AS BIGINT) * 24 END AS estimated_rows
  FROM t)
{" UNION ALL ".join(
    f"SELECT 'coverage' AS part, type, '{c}' AS item, substr(CAST({c} AS VARCHAR), 1, 19) AS value FROM c" for c in SUMMARY_COLUMNS
)}
UNION ALL SELECT 'columns', type, "column", n_having || ' of ' || n_stations || ' ' || CAST(is_common AS VARCHAR) FROM available
UNION ALL SELECT 'holders', held.type, held."column", CAST(station_id AS VARCHAR)
  FROM held JOIN available USING (type, "column") WHERE NOT is_common
UNION ALL SELECT DISTINCT 'stations', type, '', CAST(station_id AS VARCHAR) FROM profile""")
def job_profile_summary(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """All parts of the written summary, each figure as text."""
    found = profile(station.order_cells(spark, sf_dir), station.stations(spark, sf_dir), out)

    def part(name: str, schema, item, value) -> DataFrame:
        rows = spark.read.schema(schema).json(f"{out}/summary/{name}")
        return rows.select("type", item.alias("item"), value.alias("value"))

    of = F.concat(F.col("n_having"), F.lit(" of "), F.col("n_stations"), F.lit(" "), F.col("is_common"))
    figures = [part("coverage", found.coverage.schema, F.lit(c), F.substring(F.col(c).cast("string"), 1, 19)) for c in SUMMARY_COLUMNS]
    parts = {
        "coverage": reduce(DataFrame.unionByName, figures),
        "columns": part("columns", found.availability.schema, F.col("column"), of),
        "holders": part("partial_columns", found.partial_holders.schema, F.col("column"), F.col("station_id").cast("string")),
        "stations": part("stations", "type string, station_id int", F.lit(""), F.col("station_id").cast("string")),
    }
    listed = [rows.select(F.lit(name).alias("part"), "type", "item", "value") for name, rows in parts.items()]
    return reduce(DataFrame.unionByName, listed)
