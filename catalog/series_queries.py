"""Queries over series: statistics, moving averages, lags, differences, predictions."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.frames import (
    METRIC_COLUMNS,
    OFF_TIE,
    SQL_OF,
    STATS_SQL,
    daily,
    hourly,
    metrics_sql,
    numbered,
    off_tie_round,
    r,
    rounded,
    rounded_stats,
    table,
)
from isochron.operators.arima import arima, arima_metrics
from isochron.operators.differencing import difference, level_stats
from isochron.operators.gaps import gap_report
from isochron.operators.lagging import autocorrelation, center, exact_lags, lag_series, textbook_autocovariance
from isochron.operators.reshape import lag_name, level_name, to_wide
from isochron.operators.smoothing import sma, sma_text, sweep_metrics
from isochron.operators.stats import describe_series, series_stats, wide_stats, with_stratum
from isochron.sinks import metrics_csv
from isochron.sources.tables import to_series

Query = Callable[[SparkSession, str], DataFrame]
FRAMES = {"hourly": hourly, "daily": daily}

queries: dict[str, Query] = {}
oracles: dict[str, str] = {}


def register(name: str, query: Query, sql: str) -> None:
    queries[name] = query
    oracles[name] = sql


def on(source: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(FRAMES[source](spark, sf_dir))


# --- moving average -------------------------------------------------------------------------------


def sma_sql(source: str, sizes: list[int]) -> str:
    """CTE ``p``: moving-average points of each window size."""
    parts = " UNION ALL ".join(
        f"""SELECT series, ts, {n} AS window_size, value AS actual,
            avg(value) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS moving_avg
            FROM {source}"""
        for n in sizes
    )
    return f"""{SQL_OF[source]}, w AS ({parts}),
p AS (SELECT *, actual - moving_avg AS error, (actual - moving_avg) * (actual - moving_avg) AS sq_error FROM w)"""


SMA_POINTS = ["moving_avg", "error", "sq_error"]
SMA_POINTS_SQL = f"""SELECT series, ts, window_size, actual, {r("moving_avg", "moving_avg")},
  {r("error", "error")}, {r("sq_error", "sq_error", 4)} FROM p"""
SMA_METRICS_SQL = metrics_sql(1, "series, window_size", "'windowSize=' || window_size", "p")


def sma_points(df: DataFrame, windows: str) -> DataFrame:
    return rounded(rounded(sma(df, windows), ["moving_avg", "error"]), ["sq_error"], 4)


def sma_model(df: DataFrame, windows: str) -> DataFrame:
    return rounded(sweep_metrics(df, windows), METRIC_COLUMNS)


for source, windows, sizes, suffix in (
    ("hourly", "5", [5], ""),
    ("hourly", "1-10", list(range(1, 11)), "_sweep"),
    ("daily", "3,7", [3, 7], "_daily"),
    ("daily", "200", [200], "_long_window"),
    ("hourly", "33", [33], "_33"),
):
    register(
        f"sma_points{suffix}",
        on(source, partial(sma_points, windows=windows)),
        f"WITH {sma_sql(source, sizes)} {SMA_POINTS_SQL}",
    )
    register(
        f"sma_metrics{suffix}",
        on(source, partial(sma_model, windows=windows)),
        f"WITH {sma_sql(source, sizes)} {SMA_METRICS_SQL}",
    )

# NaN, infinite and very large readings planted by the hour they were taken in. Averages that hold one are
# compared by kind; those after it must not show it any more.
HOUR = "CAST(epoch(ts) AS BIGINT) // 3600 % 97"
PLANTED = f"""planted AS (SELECT series, ts, CASE WHEN {HOUR} = 5 THEN 'NaN'::DOUBLE WHEN {HOUR} = 40 THEN 'Infinity'::DOUBLE
  WHEN {HOUR} = 70 THEN 1e17 ELSE value END AS value FROM hourly)"""


def planted(df: DataFrame) -> DataFrame:
    hour = F.pmod(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600, F.lit(97)).cast("int")
    odd = F.when(hour == 5, float("nan")).when(hour == 40, float("inf")).when(hour == 70, 1e17)
    return df.withColumn("value", F.coalesce(odd, "value"))


def sma_kinds(df: DataFrame) -> DataFrame:
    average = F.col("moving_avg")
    kind = F.when(F.isnan(average), "nan").when(average == float("inf"), "inf").when(average > 1e9, "large")
    points = sma(planted(df), "4,40").select("series", "ts", "window_size", kind.alias("kind"), "moving_avg")
    plain = F.when(F.col("kind").isNull(), off_tie_round("moving_avg", 6))
    return points.withColumn("moving_avg", plain)


register(
    "sma_nan_spike",
    on("hourly", sma_kinds),
    f"""WITH {SQL_OF["hourly"]}, {PLANTED},
w AS ({" UNION ALL ".join(
    f'SELECT series, ts, {n} AS window_size, bool_or(isnan(value)) OVER x AS is_nan, bool_or(isinf(value)) OVER x AS is_inf, '
    'bool_or(value = 1e17) OVER x AS is_large, '
    'avg(CASE WHEN isfinite(value) AND value < 1e17 THEN value END) OVER x AS m FROM planted WINDOW x AS '
    f'(PARTITION BY series ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)' for n in (4, 40))})
SELECT series, ts, window_size, CASE WHEN is_nan THEN 'nan' WHEN is_inf THEN 'inf' WHEN is_large THEN 'large' END AS kind,
  CASE WHEN NOT (is_nan OR is_inf OR is_large) THEN {r("m", "moving_avg").rsplit(" AS ", 1)[0]} END AS moving_avg FROM w""",
)

register(
    "series_three_decimals",
    lambda spark, sf_dir: to_series(
        table(spark, sf_dir, "lineitem"), F.col("l_returnflag"), F.col("l_shipdate"), F.col("l_quantity") * F.lit(0.125), 3
    ),
    """SELECT l_returnflag AS series, CAST(date_trunc('hour', l_shipdate) AS TIMESTAMP) AS ts,
  CAST(CAST(CAST(sum(CAST(l_quantity * 0.125 AS DECIMAL(38,3))) AS DOUBLE) AS FLOAT) AS DOUBLE) AS value
FROM lineitem GROUP BY 1, 2""",
)
register(
    "metrics_export",
    on("hourly", lambda df: metrics_csv(sma_model(df, "3,5"))),
    f"WITH {sma_sql('hourly', [3, 5])} {SMA_METRICS_SQL}",
)


def _two_decimals(x: str) -> str:
    """``%5.2f`` rounding the shortest decimal form half up, as the JVM does."""
    text = f"CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,2)) AS VARCHAR)"
    signed = f"CASE WHEN {x} < 0 AND {text} = '0.00' THEN '-0.00' ELSE {text} END"
    return f"(repeat(' ', greatest(0, 5 - length({signed}))) || {signed})"


# Figures are rounded to 6 places before they are printed, since engines differ in the last bit.
register(
    "sma_text",
    on("hourly", lambda df: sma_text(rounded(sma(df, 5), SMA_POINTS))),
    f"""WITH {sma_sql("hourly", [5])},
q AS (SELECT series, ts, actual, {r("moving_avg", "m")}, {r("error", "e")}, {r("sq_error", "s")} FROM p)
SELECT series || chr(9) || strftime(ts, '%Y-%m-%d %H:%M:%S') || ': actual: ' || {_two_decimals("actual")}
  || '  moving avg: ' || {_two_decimals("m")} || '  error ' || {_two_decimals("e")}
  || '  sq error ' || {_two_decimals("s")} AS value FROM q""",
)

# --- statistics -----------------------------------------------------------------------------------

for source in ("hourly", "daily"):
    suffix = "" if source == "hourly" else "_daily"
    register(
        f"series_stats{suffix}",
        on(source, lambda df: rounded_stats(series_stats(df))),
        f"WITH {SQL_OF[source]} SELECT series, {STATS_SQL} FROM {source} GROUP BY series",
    )

for source, strata, width, suffix in (("hourly", 4, 24, ""), ("daily", 8, 30, "_daily")):
    stratum = f"CAST((t // {width}) % {strata} AS INTEGER) AS stratum"
    register(
        f"strata_stats{suffix}",
        on(source, lambda df, s=strata, w=width: rounded_stats(describe_series(df, s, w))),
        f"""WITH {numbered(source)}, s AS (SELECT series, ts, value, {stratum} FROM n)
SELECT series, stratum, {STATS_SQL} FROM s GROUP BY GROUPING SETS ((series), (series, stratum))""",
    )
    register(
        f"stratum_of_row{suffix}",
        on(source, lambda df, s=strata, w=width: with_stratum(df, s, w)),
        f"WITH {numbered(source)} SELECT series, ts, value, {stratum} FROM n",
    )


def strata_columns(df: DataFrame) -> DataFrame:
    wide = wide_stats(rounded_stats(describe_series(df, 3, 24)), 3)
    return wide.select("series", *[c for c in wide.columns if c != "series"])


def _strata_columns_sql() -> str:
    columns = []
    for i in (None, 0, 1, 2):
        here, end = ("stratum IS NULL", "") if i is None else (f"stratum = {i}", f"_{i}")
        for name in ("count", "min", "max", "mean", "variance", "std_dev", "min_ts", "max_ts"):
            columns.append(f'max(CASE WHEN {here} THEN "{name}" END) AS "{name}{end}"')
    return f"""WITH {numbered("hourly")}, s AS (SELECT series, ts, value, (t // 24) % 3 AS stratum FROM n),
g AS (SELECT series, stratum, {STATS_SQL} FROM s GROUP BY GROUPING SETS ((series), (series, stratum)))
SELECT series, {", ".join(columns)} FROM g GROUP BY series"""


register("strata_wide", on("hourly", strata_columns), _strata_columns_sql())

# --- lag, centring, autocorrelation ---------------------------------------------------------------


def lag_sql(source: str, lags: list[int], centered: bool) -> str:
    """CTE ``pairs``: x and its lagged partner."""
    listed = ", ".join(f"({h})" for h in sorted({0, *lags}))
    less = " - mean" if centered else ""
    return f"""{numbered(source)}, l(lag) AS (VALUES {listed}),
m AS (SELECT series, lag, count(*) FILTER (WHERE ts < first_ts + lag * INTERVAL 1 HOUR) AS m
      FROM n, l GROUP BY series, lag),
x AS (SELECT series, ts, t, value{less} AS x FROM n),
pairs AS (SELECT a.series, a.ts, m.lag, a.x, b.x AS lag_value
          FROM x a JOIN m ON m.series = a.series JOIN x b ON b.series = a.series AND b.t = a.t - m.m)"""


def _correlation_sql(source: str, lags: list[int], centered: bool) -> str:
    cov = f""", {r("coalesce(prod, 0) / n - mean * mean", "autocovariance")}""" if centered else ""
    return f"""WITH {lag_sql(source, lags, centered)},
b AS (SELECT series, sum(x * x) AS energy, count(*) AS n FROM x GROUP BY series),
avgs AS (SELECT series, avg(value) AS mean FROM n GROUP BY series),
s AS (SELECT series, lag, sum(x * lag_value) AS prod FROM pairs GROUP BY series, lag)
SELECT m.series, m.lag, {r("coalesce(prod, 0) / energy", "autocorrelation")}{cov}
FROM m JOIN b USING (series) JOIN avgs USING (series) LEFT JOIN s ON s.series = m.series AND s.lag = m.lag"""


for source, lags, text, suffix in (
    ("hourly", [1, 24], "1,24", ""),
    ("hourly", list(range(1, 11)), "1-10", "_range"),
    ("daily", [24, 168], "24,168", "_daily"),
):
    register(
        f"lag_points{suffix}",
        on(source, partial(lag_series, lags=text)),
        f"WITH {lag_sql(source, lags, False)} SELECT series, ts, lag, lag_value AS value FROM pairs",
    )
    register(
        f"lag_centered{suffix}",
        on(source, lambda df, t=text: rounded(lag_series(df, t, centered=True), ["value"])),
        f"WITH {lag_sql(source, lags, True)} SELECT series, ts, lag, {r('lag_value', 'value')} FROM pairs",
    )
    register(
        f"autocorr_raw{suffix}",
        on(source, lambda df, t=text: rounded(autocorrelation(df, t), ["autocorrelation"])),
        _correlation_sql(source, lags, False),
    )
    register(
        f"autocorr_centered{suffix}",
        on(
            source,
            lambda df, t=text: rounded(autocorrelation(df, t, centered=True), ["autocorrelation", "autocovariance"]),
        ),
        _correlation_sql(source, lags, True),
    )

register(
    "mean_centred",
    on("daily", lambda df: rounded(center(df), ["value"])),
    f"WITH {numbered('daily')} SELECT series, ts, {r('value - mean', 'value')} FROM n",
)


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def lag_wide(df: DataFrame) -> DataFrame:
    named = lag_series(df, "1").select(lag_name().alias("series"), "ts", "value")
    return to_wide(named, [f"{e}_lag_{h}" for e in EVENT_TYPES for h in (0, 1)])


register(
    "lag_wide",
    on("hourly", lag_wide),
    f"WITH {lag_sql('hourly', [1], False)} SELECT ts, "
    + ", ".join(
        f"max(CASE WHEN series = '{e}' AND lag = {h} THEN lag_value END) AS {e}_lag_{h}"
        for e in EVENT_TYPES
        for h in (0, 1)
    )
    + " FROM pairs GROUP BY ts",
)

register(
    "lag_exact",
    on("hourly", partial(exact_lags, lags="1,24")),
    f"""WITH {SQL_OF["hourly"]}, l(lag) AS (VALUES (0), (1), (24))
SELECT a.series, a.ts, l.lag, b.value FROM hourly a, l JOIN hourly b ON b.series = a.series AND b.ts = a.ts - l.lag * INTERVAL 1 HOUR""",
)
register(
    "autocov_textbook",
    on("daily", lambda df: rounded(textbook_autocovariance(df, "24,168"), ["autocovariance"])),
    f"""WITH {lag_sql("daily", [24, 168], True)},
c AS (SELECT series, count(*) AS n FROM x GROUP BY series),
s AS (SELECT series, lag, sum(x * lag_value) AS prod FROM pairs GROUP BY series, lag)
SELECT m.series, m.lag, {r("coalesce(prod, 0) / n", "autocovariance")}
FROM m JOIN c USING (series) LEFT JOIN s ON s.series = m.series AND s.lag = m.lag""",
)

# --- differencing ---------------------------------------------------------------------------------


def diff_sql(source: str, kind: str, n: int) -> str:
    """CTE ``levels``: every level of a differencing."""
    by = "PARTITION BY series ORDER BY t"
    if kind == "season":
        return f"""{numbered(source)},
d AS (SELECT series, ts, t, value, value - lag(value, {n}) OVER ({by}) AS v FROM n),
levels AS (SELECT series, ts, 0 AS level, value FROM d
           UNION ALL SELECT series, ts, 1 AS level, v AS value FROM d WHERE t >= {2 * n})"""
    steps = ["d0 AS (SELECT series, ts, t, value FROM n)"]
    for i in range(1, n + 1):
        steps.append(
            f"d{i} AS (SELECT series, ts, t, value - lag(value) OVER ({by}) AS value FROM d{i - 1})"
        )
    unions = " UNION ALL ".join(
        f"SELECT series, ts, {i} AS level, value FROM d{i} WHERE t >= {i + 1 if i else 0}" for i in range(n + 1)
    )
    return f"{numbered(source)}, {', '.join(steps)}, levels AS ({unions})"


for source, spec, suffix in (
    ("hourly", "step,1", "step1"),
    ("hourly", "step,2", "step2"),
    ("hourly", "season,24", "season24"),
    ("daily", "step,3", "step3_daily"),
    ("daily", "season,30", "season30_daily"),
):
    kind, size = spec.split(",")
    register(
        f"diff_{suffix}",
        on(source, lambda df, s=spec: rounded(difference(df, s), ["value"])),
        f"WITH {diff_sql(source, kind, int(size))} SELECT series, ts, level, {r('value', 'value')} FROM levels",
    )
    register(
        f"diff_stats_{suffix}",
        on(
            source,
            lambda df, s=spec: rounded(rounded_stats(level_stats(df, s)), ["min", "max"]),
        ),
        f"""WITH {diff_sql(source, kind, int(size))},
g AS (SELECT series, level, {STATS_SQL} FROM levels GROUP BY series, level)
SELECT * REPLACE ({r('"min"', '"min"')}, {r('"max"', '"max"')}) FROM g""",
    )

register(
    "diff_pass_through",
    on("hourly", lambda df: difference(df, "step,0")),
    f"WITH {SQL_OF['hourly']} SELECT series, ts, 0 AS level, value FROM hourly",
)


for spec, where in (("step,2", "level <= 2 AND t >= level"), ("season,24", "t >= 24 * level")):
    kind, size = spec.split(",")
    register(
        f"diff_all_{kind}",
        on("hourly", lambda df, s=spec: rounded(difference(df, s, skip_first=False), ["value"])),
        f"""WITH {numbered("hourly")},
v AS (SELECT series, ts, t, value, lag(value) OVER w AS a, lag(value, 2) OVER w AS b, lag(value, 24) OVER w AS y FROM n
      WINDOW w AS (PARTITION BY series ORDER BY t)),
levels AS (SELECT series, ts, t, 0 AS level, value FROM v UNION ALL
           SELECT series, ts, t, 1, {"value - a" if kind == "step" else "value - y"} FROM v
           {"UNION ALL SELECT series, ts, t, 2, value - a - (a - b) FROM v" if kind == "step" else ""})
SELECT series, ts, level, {r("value", "value")} FROM levels WHERE {where}""",
    )


def diff_wide(df: DataFrame) -> DataFrame:
    named = difference(df, "season,24").select(level_name("season").alias("series"), "ts", off_tie_round("value", 6).alias("value"))
    return to_wide(named, [f"{e}_season_{i}" for e in EVENT_TYPES for i in (0, 1)])


register(
    "diff_wide",
    on("hourly", diff_wide),
    f"WITH {diff_sql('hourly', 'season', 24)} SELECT ts, "
    + ", ".join(
        f"max(CASE WHEN series = '{e}' AND level = {i} THEN round(value + {OFF_TIE}::DOUBLE, 6) + 0.0 END) AS {e}_season_{i}"
        for e in EVENT_TYPES
        for i in (0, 1)
    )
    + " FROM levels GROUP BY ts",
)

# --- AR/MA prediction -----------------------------------------------------------------------------


def arima_sql(
    source: str, ar: list[float], ma: list[float], d: int, c: float = 0.0, centered: bool = False
) -> str:
    """CTE ``e``: actual and error per modelled row, k being its number; the error of k = 0 is NULL."""

    def f32(x: str) -> str:
        return f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"

    by = "PARTITION BY series ORDER BY k"
    y = f32("value")
    if centered:
        y = f32(f"{f32('value')} - avg(value) OVER (PARTITION BY series)")
    past = " + ".join(f"{phi} * coalesce(lag(y, {i + 1}) OVER ({by}), 0)" for i, phi in enumerate(ar)) or "0"
    base = f"""{diff_sql(source, "step", d)},
y AS (SELECT series, ts, row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS k, {y} AS y
      FROM levels WHERE level = {d}),
u AS (SELECT series, ts, k, y, CASE WHEN k > 0 THEN y - ({c} + {past}) END AS u FROM y)"""
    if not ma:
        return f"{base}, e AS (SELECT series, ts, k, y AS actual, u AS error FROM u)"
    kept = ", ".join(f"e{j}" for j in range(len(ma)))
    own = " + ".join(f"{theta} * rec.e{j}" for j, theta in enumerate(ma))
    shifted = "".join(f", rec.e{j}" for j in range(len(ma) - 1))
    zeros = ", ".join("0.0::DOUBLE" for _ in ma)
    return f"""{base},
rec(series, k, {kept}) AS (
  SELECT series, k, {zeros} FROM u WHERE k = 0
  UNION ALL
  SELECT u.series, u.k, u.u + {own}{shifted} FROM rec JOIN u ON u.series = rec.series AND u.k = rec.k + 1),
e AS (SELECT u.series, u.ts, u.k, u.y AS actual, CASE WHEN u.k > 0 THEN rec.e0 END AS error
      FROM u JOIN rec ON rec.series = u.series AND rec.k = u.k)"""


ARIMA_POINTS_SQL = f"""SELECT series, ts, {r("actual", "actual")}, {r("actual - error", "prediction")}, {r("error", "error")},
  {r("error * error", "sq_error", 4)} FROM e WHERE error IS NOT NULL"""


def arima_points(df: DataFrame, **model) -> DataFrame:
    return rounded(rounded(arima(df, **model), ["actual", "prediction", "error"]), ["sq_error"], 4)


def arima_model(df: DataFrame, **model) -> DataFrame:
    return rounded(arima_metrics(df, **model), METRIC_COLUMNS)


for name, source, p, q, d, c, centered in (
    ("ar", "hourly", "0.9,0.1", "none", 1, 0.0, False),
    ("full", "hourly", "0.9,0.1", "0.5", 1, 0.0, False),
    ("centered", "hourly", "0.9,0.1", "0.5", 1, 0.0, True),
    ("second_order", "hourly", "0.6,0.3", "0.4,0.2", 0, 1.5, False),
    ("daily", "daily", "0.5", "0.3", 1, 0.0, False),
):
    ar = [float(x) for x in p.split(",")]
    ma = [] if q == "none" else [float(x) for x in q.split(",")]
    sql = f"WITH RECURSIVE {arima_sql(source, ar, ma, d, c, centered)}"
    model = {"p": p, "q": q, "d": d, "c": c, "centered": centered}
    text = f"arima_p={p} : arima_q={q} : arima_c={c} : arima_d={d} : differencing=step,{d} : zero_transform={centered}"
    text = text.replace(",", ";").replace("True", "true").replace("False", "false")
    register(f"arima_{name}", on(source, partial(arima_points, **model)), f"{sql} {ARIMA_POINTS_SQL}")
    register(
        f"arima_metrics_{name}",
        on(source, partial(arima_model, **model)),
        f"{sql} {metrics_sql(len(ar) + len(ma) + (c != 0), 'series', repr(text), 'e')}",
    )

# --- gaps -----------------------------------------------------------------------------------------

for source in ("hourly", "daily"):
    register(
        "gap_report" if source == "hourly" else "gap_report_daily",
        on(source, gap_report),
        f"""WITH {SQL_OF[source]},
g AS (SELECT series, ts, lag(ts) OVER (PARTITION BY series ORDER BY ts) + INTERVAL 1 HOUR AS missing_ts FROM {source})
SELECT series, missing_ts, ts AS next_ts FROM g WHERE missing_ts <> ts""",
    )
