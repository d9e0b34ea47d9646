"""Time the main jobs on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

As in real use the readings are loaded into a stored table once (``load_*``); the jobs then scan it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.frames import daily, hourly, table
from catalog.series_queries import EVENT_TYPES
from catalog.station_queries import order_cells, stations, supplier_files
from isochron import sinks
from isochron.functions.values import analytic_value
from isochron.operators.arima import arima, arima_metrics
from isochron.operators.differencing import difference, level_stats
from isochron.operators.gaps import gap_report
from isochron.operators.lagging import autocorrelation, lag_series
from isochron.operators.profile import column_availability, coverage_summary, profile_stations, station_gaps
from isochron.operators.reshape import merge_wide, to_wide, unpivot_text
from isochron.operators.smoothing import sma, sweep_metrics
from isochron.operators.stats import describe_series, series_stats
from isochron.plans.stations import load_readings
from isochron.session import local_session
from isochron.sources.station_files import file_lines, line_cells, preferred_files
from isochron.sources.stations import choose_stations, station_readings
from isochron.sources.tables import first_rows, read_counts, read_series, time_range


RUNS = 3


def output_folder(spark: SparkSession) -> str:
    """``$BENCH_OUT``, else below the cluster's shared folder, else below the warehouse."""
    root = os.environ.get("BENCH_OUT") or spark.conf.get("spark.checkpoint.dir", None)
    return f"{root or spark.conf.get('spark.sql.warehouse.dir')}/bench-{time.time_ns()}"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    stored = output_folder(spark)
    seconds: dict[str, float] = {}

    def timed(name: str, action: Callable[[], object]) -> None:
        if len(sys.argv) > 1 and name not in sys.argv[1:] and not name.startswith("load"):
            return
        took = []
        for _ in range(RUNS):  # the first run also warms up
            started = time.perf_counter()
            action()
            took.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(took), 3)

    def run(name: str, build: Callable[[], DataFrame]) -> None:
        timed(name, lambda: build().write.format("noop").mode("overwrite").save())

    def load(name: str, readings: Callable[[SparkSession, str], DataFrame]) -> str:
        """The readings loaded into fresh folders, as often as other jobs run; gives the last one."""
        folders: list[str] = []

        def once() -> None:
            folders.append(f"{stored}/{name}-{len(folders)}")
            sinks.upsert_readings(readings(spark, sf_dir), folders[-1])

        timed(f"load_{name}", once)
        files[name] = len(spark.read.parquet(folders[-1]).inputFiles())
        return folders[-1]

    files: dict[str, int] = {}
    table(spark, sf_dir, "lineitem").count()  # JVM and file listing are up
    days_at, hours_at = load("daily", daily), load("hourly", hourly)
    days, hours = read_series(spark, days_at), read_series(spark, hours_at)
    counts = read_counts(spark, days_at)
    sinks.replace_table(supplier_files(spark, sf_dir), f"{stored}/files")
    zips = spark.read.parquet(f"{stored}/files")
    lineitem = table(spark, sf_dir, "lineitem")
    orders = order_cells(spark, sf_dir)

    run("sma", lambda: sma(days, "5"))
    run("sma_stored_counts", lambda: sma(days, "5", counts=counts))
    run("sma_metrics", lambda: sweep_metrics(days, "5"))
    run("sma_sweep_metrics", lambda: sweep_metrics(days, "1-10"))
    run("sma_long_window", lambda: sma(days, "365"))
    run("series_stats", lambda: series_stats(days))
    run("strata_stats", lambda: describe_series(days, 8, 30))
    run("lag", lambda: lag_series(days, "24,168"))
    run("autocorrelation", lambda: autocorrelation(days, "24,168", centered=True))
    run("diff_step", lambda: difference(days, "step,2"))
    run("diff_season", lambda: difference(days, "season,30"))
    run("diff_stats", lambda: level_stats(days, "step,2"))
    run("arima_ar", lambda: arima(days, q="none"))
    run("arima", lambda: arima(days))
    run("arima_metrics", lambda: arima_metrics(days))
    run("arima_centred", lambda: arima(hours, centered=True))
    run("gap_report", lambda: gap_report(days))
    run("first_rows", lambda: first_rows(days, 100, counts))
    run("time_range_stats", lambda: series_stats(time_range(days, "1997-01-01 00:00:00", "1998-01-01 00:00:00")))
    run("wide_pivot", lambda: to_wide(hours, EVENT_TYPES))
    run("wide_merge", lambda: merge_wide(to_wide(hours, EVENT_TYPES[:3]), to_wide(hours, EVENT_TYPES[2:])))
    run(
        "unpivot",
        lambda: unpivot_text(
            lineitem, "l_(quantity|extendedprice|discount|tax)", ("l_orderkey", "l_linenumber")
        ).select("l_orderkey", "series", analytic_value(F.col("raw")).alias("value")),
    )
    run(
        "station_join",
        lambda: station_readings(choose_stations(stations(spark, sf_dir), close_year=9999), orders),
    )
    run("station_profile", lambda: profile_stations(orders))
    run("station_gaps", lambda: station_gaps(orders))
    run("coverage_summary", lambda: coverage_summary(profile_stations(orders)))
    run("column_availability", lambda: column_availability(profile_stations(orders)))
    run("zip_load", lambda: load_readings(line_cells(file_lines(preferred_files(zips)))))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "files": files,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
