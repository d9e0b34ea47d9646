"""Canonical frames over the given tables, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.sources.tables import to_series


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per event type, hourly sums, with gaps."""
    events = table(spark, sf_dir, "events")
    return to_series(events, F.col("event_type"), F.col("ts"), F.col("value"), 2)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per supplier, quantity shipped per day."""
    lines = table(spark, sf_dir, "lineitem")
    return to_series(lines, F.col("l_suppkey"), F.col("l_shipdate"), F.col("l_quantity"), 2)


HOURLY = """hourly AS (
  SELECT event_type AS series, date_trunc('hour', ts) AS ts,
         CAST(CAST(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS FLOAT) AS DOUBLE) AS value
  FROM events GROUP BY 1, 2)"""

DAILY = """daily AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS series, CAST(date_trunc('hour', l_shipdate) AS TIMESTAMP) AS ts,
         CAST(CAST(CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS FLOAT) AS DOUBLE) AS value
  FROM lineitem GROUP BY 1, 2)"""

SQL_OF = {"hourly": HOURLY, "daily": DAILY}


def numbered(source: str) -> str:
    """CTE ``n``: rows of a source with their 0-based number t in the series."""
    return f"""{SQL_OF[source]},
n AS (
  SELECT series, ts, value, row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS t,
         min(ts) OVER (PARTITION BY series) AS first_ts, avg(value) OVER (PARTITION BY series) AS mean
  FROM {source})"""


# Short decimals can be exact rounding ties, which the last bit of a sum would then decide. Both sides
# move values off such ties by the same amount, far below the digits compared.
OFF_TIE = "1.37e-8"


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison; the SQL side rounds the same columns."""
    return df.withColumns({c: off_tie_round(c, digits) for c in columns})


def off_tie_round(name: str, digits: int) -> Column:
    return F.round(F.col(name) + float(OFF_TIE), digits)


def r(expression: str, name: str, digits: int = 6) -> str:
    """Rounded SQL column; adding 0 turns a negative zero positive."""
    return f"round(({expression}) + {OFF_TIE}::DOUBLE, {digits}) + 0.0 AS {name}"


STAT_DIGITS = {"mean": 6, "variance": 4, "std_dev": 6, "sample_variance": 4, "sample_std_dev": 6}


def rounded_stats(df: DataFrame) -> DataFrame:
    return df.withColumns({c: off_tie_round(c, d) for c, d in STAT_DIGITS.items() if c in df.columns})


STATS_SQL = f"""count(*) AS "count", min(value) AS "min", max(value) AS "max", {r("avg(value)", "mean")},
  {r("var_pop(value) * count(*)", "variance", 4)}, {r("sqrt(var_pop(value) * count(*))", "std_dev")},
  min(ts) AS min_ts, max(ts) AS max_ts,
  {r("var_samp(value)", "sample_variance", 4)}, {r("stddev_samp(value)", "sample_std_dev")}"""


def metrics_sql(k: int, by: str, params: str, source: str) -> str:
    """Metrics over rows (actual, error) of ``source``; NULL errors count in n only."""

    def ln(x: str) -> str:
        return f"CASE WHEN {x} = 0 THEN '-infinity'::DOUBLE ELSE ln({x}) END"

    return f"""SELECT {by}, {r("mse", "mse")}, {r("maape", "maape")},
  {r(f"2.0 * {k} - 2.0 * {ln('mse')}", "aic_mse")}, {r(f"2.0 * {k} - 2.0 * {ln('maape')}", "aic_maape")},
  {r(f"ln(n) * {k} - 2.0 * {ln('mse')}", "bic_mse")}, {r(f"ln(n) * {k} - 2.0 * {ln('maape')}", "bic_maape")},
  {params} AS params
FROM (SELECT {by}, count(*) AS n, avg(error * error) AS mse, avg(atan2(abs(error), abs(actual))) AS maape
      FROM {source} GROUP BY {by})"""


METRIC_COLUMNS = ("mse", "maape", "aic_mse", "aic_maape", "bic_mse", "bic_maape")
