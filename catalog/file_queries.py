"""Station files as they lie in folders: written there by tasks, listed, chosen, opened and read."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog import station_queries as station
from catalog.frames import table
from catalog.job_queries import job, oracles, queries  # noqa: F401  # entries are registered there
from isochron.operators.profile import station_gaps
from isochron.plans.stations import profile, station_cells
from isochron.sources.station_files import unknown_files
from isochron.sources.stations import STATION_SCHEMA, STATION_TITLE, read_stations_checked


def write_files(files: DataFrame, folder: str) -> str:
    """Files ``path, content`` written below a folder, each by the task that holds it; gives the folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))
        system.create_dir(root, recursive=True)  # where tasks have a file system of their own
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with system.open_output_stream(f"{root}/{path.as_py()}") as stream:
                    stream.write(content.as_buffer())
            yield batch.select(["path"])

    files.select("path", "content").mapInArrow(run, "path string").write.mode("overwrite").format("noop").save()
    return folder


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("station"), F.col("s_name").alias("name"))


@job(f"""WITH {station.SUPPLIER_DAYS},
c AS (SELECT station, CASE WHEN station % 3 = 0 OR station % 2 = 1 THEN 'dly' ELSE 'hly' END AS file_type, ts,
        unnest([1, 2, 3, 4]) AS position, unnest(['ind_rain', 'rain', 'ind_temp', 'temp']) AS measure,
        unnest(['0', CAST(quantity AS VARCHAR), CASE WHEN n > 1 THEN CAST(n AS VARCHAR) ELSE '' END,
                CASE WHEN n > 2 THEN '0' ELSE CAST(n AS VARCHAR) END]) AS raw FROM days WHERE station % 5 <> 0)
SELECT station, file_type, ts, CAST(position AS INTEGER) AS position, measure, measure || '_' || station AS series, raw FROM c""")
def station_sources(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """Cells of chosen stations from two folders and one that is not there.

    The first folder has the daily files of every third station only, and they win over the hourly ones of the second.
    Files of stations that are not chosen are no zips, so that opening one would fail.
    """
    files = station.supplier_files(spark, sf_dir)
    closed = F.when(F.col("station") % 5 == 0, F.lit(b"no zip")).otherwise(F.col("content")).alias("content")
    files = files.select("path", "file_type", "station", closed)
    first = write_files(files.where("station % 3 = 0 AND file_type = 'dly'"), f"{out}/near")
    second = write_files(files, f"{out}/far")
    chosen = suppliers(spark, sf_dir).where("station % 5 <> 0")
    return station_cells(spark, [f"{out}/absent", first, second], chosen).drop("line_no")


HOURS = "TIMESTAMP '2020-01-01 00:00:00' + to_hours(datediff('day', DATE '1992-01-01', CAST(ts AS DATE)))"

FILE_ORDER = f"""{station.SUPPLIER_DAYS},
k AS (SELECT station, {HOURS} AS ts, row_number() OVER (PARTITION BY station ORDER BY ts) AS n FROM days),
lines AS (SELECT station, ts, 10 * n + CASE WHEN n % 11 = 5 THEN 11 ELSE 0 END AS place FROM k WHERE n % 10 <> 0
          UNION ALL SELECT station, ts, 10 * n + 5 FROM k WHERE n % 7 = 3),
numbered AS (SELECT station, ts, row_number() OVER (PARTITION BY station ORDER BY place) - 1 AS line_no,
               lag(ts) OVER (PARTITION BY station ORDER BY place) + INTERVAL 1 HOUR AS missing_ts FROM lines),
gaps AS (SELECT * FROM numbered WHERE missing_ts <> ts)"""


def disordered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per supplier, an hour for each day with shipments: some lines are missing, doubled, or stand too late."""
    days = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("station"), F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")).alias("hour")
    ).distinct()
    numbered = days.withColumn("n", F.row_number().over(Window.partitionBy("station").orderBy("hour")))  # days of one supplier
    here = F.when(F.col("n") % 10 != 0, 10 * F.col("n") + F.when(F.col("n") % 11 == 5, 11).otherwise(0))
    again = F.when(F.col("n") % 7 == 3, 10 * F.col("n") + 5)
    moment = F.expr("TIMESTAMP_NTZ '2020-01-01 00:00:00' + make_dt_interval(0, hour, 0, 0)")
    lines = numbered.select("station", moment.alias("ts"), F.explode(F.array(here, again)).alias("place")).where("place IS NOT NULL")
    rows = F.sort_array(F.collect_list(F.struct("place", F.concat(F.substring(F.col("ts").cast("string"), 1, 19), F.lit(",0,1.5")).alias("line"))))
    files = lines.groupBy("station").agg(F.array_join(rows["line"], "\n").alias("body"))
    text = F.concat(F.lit("Station Name: supplier\n\ndate,ind,rain\n"), "body", F.lit("\n"))
    return station.zip_files(files.select("station", F.lit("hly").alias("file_type"), text.alias("text")))


@job(f"WITH {FILE_ORDER} SELECT station, 'hly' AS file_type, line_no, missing_ts, ts AS next_ts FROM gaps")
def gaps_in_file_order(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    folder = write_files(disordered_files(spark, sf_dir), f"{out}/files")
    return station_gaps(station_cells(spark, folder, suppliers(spark, sf_dir)))


@job(f"""WITH {FILE_ORDER}
SELECT station AS station_id, coalesce(string_agg(strftime(missing_ts, '%Y-%m-%d %H:%M:%S'), '|' ORDER BY line_no)
  FILTER (WHERE missing_ts <> ts), '') AS missing_lines FROM numbered GROUP BY station""")
def profile_in_file_order(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """Gap texts of a profile, repeated and backward hours among them, in the order of the lines."""
    folder = write_files(disordered_files(spark, sf_dir), f"{out}/files")
    chosen = suppliers(spark, sf_dir)
    return profile(station_cells(spark, folder, chosen), chosen, f"{out}/profile").profile.select("station_id", "missing_lines")


BROKEN = "CASE WHEN station % 50 = 3 THEN station || 'x' WHEN station % 50 = 4 THEN station || '00000000000' ELSE CAST(station AS VARCHAR) END"


@job(f"""WITH {station.STATIONS}, l AS (SELECT county, station, {BROKEN} AS number, height FROM stations),
w AS (SELECT *, CASE WHEN station % 50 = 5 THEN 'tall' ELSE CAST(height AS VARCHAR) END AS h FROM l)
SELECT 'station' AS "column", CASE WHEN station % 50 = 3 THEN 'not a number' ELSE 'number too large' END AS reason,
  number || ' ' || county AS what FROM w WHERE station % 50 IN (3, 4)
UNION ALL SELECT 'height', 'not a number', number || ' ' || county FROM w WHERE station % 50 = 5
UNION ALL SELECT '', 'too few cells', number || ' ' || county FROM w WHERE station % 50 = 6
UNION ALL SELECT 'usable', '', CAST(count(*) AS VARCHAR) FROM w WHERE station % 50 NOT IN (3, 4)
UNION ALL SELECT 'file', CASE WHEN station % 2 = 0 THEN 'neither a type nor a station in the name' ELSE 'station number is too large' END,
  CASE WHEN station % 2 = 0 THEN 'abc' || station || '.zip' ELSE 'hly' || station || '00000000000.zip' END
  FROM (SELECT CAST(s_suppkey AS INTEGER) AS station FROM supplier) WHERE station % 20 IN (1, 2)""")
def station_quarantine(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """What is wrong with a station file, how many stations are left, and zips that are no readings files by name."""
    names = [c.split()[0] for c in STATION_SCHEMA.split(", ")]
    rows = station.stations(spark, sf_dir)
    number = F.expr(BROKEN.replace("VARCHAR", "STRING"))
    height = F.when(F.col("station") % 50 == 5, "tall").otherwise(F.col("height").cast("string"))
    cells = [F.lit(None).cast("string").alias(n) if n not in rows.columns else F.col(n).cast("string").alias(n) for n in names]
    cells[1], cells[3] = number.alias("station"), height.alias("height")
    whole, short = F.to_csv(F.struct(*cells)), F.to_csv(F.struct(*cells[:6]))
    lines = rows.select(F.when(F.col("station") % 50 == 6, short).otherwise(whole).alias("value"))
    top = spark.createDataFrame([("Station details: extracted",), (f"County,{STATION_TITLE}," + ",".join(names[2:]),)], "value string")
    top.unionByName(lines).write.text(f"{out}/stations")
    found = read_stations_checked(spark, f"{out}/stations", station.CORRECTIONS)
    what = F.concat_ws(" ", F.split_part("line", F.lit(","), F.lit(2)), F.split_part("line", F.lit(","), F.lit(1)))
    faults = found.faults.select("column", "reason", what.alias("what"))
    usable = found.stations.agg(F.count("*").cast("string").alias("what")).select(F.lit("usable").alias("column"), F.lit("").alias("reason"), "what")
    odd = suppliers(spark, sf_dir).where("station % 20 IN (1, 2)")
    name = F.expr("CASE WHEN station % 2 = 0 THEN 'abc' || station ELSE 'hly' || station || '00000000000' END || '.zip'")
    folder = write_files(odd.select(name.alias("path"), F.lit(b"empty").alias("content")), f"{out}/files")
    files = unknown_files(spark, folder).select(
        F.lit("file").alias("column"), "reason", F.regexp_extract("path", r"([^/]*)$", 1).alias("what")
    )
    return faults.unionByName(usable).unionByName(files)
