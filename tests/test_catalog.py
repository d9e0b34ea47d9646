"""Every registered query against its SQL, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as contract
from catalog import file_queries, job_queries, series_queries, station_queries  # noqa: F401
from catalog.compare import connect, difference
from isochron.operators.arima import arima
from isochron.operators.differencing import difference as differences
from isochron.operators.gaps import gap_report
from isochron.operators.lagging import autocorrelation, lag_series
from isochron.operators.smoothing import sma
from isochron.operators.stats import describe_series
from isochron import sinks
from isochron.sources.tables import first_rows, read_counts, read_series

SF_DIR = "/root/testdata/sf0.001"
ORACLES = {**series_queries.oracles, **station_queries.oracles, **job_queries.oracles}
OWN = {**series_queries.queries, **station_queries.queries, **job_queries.queries}
QUERIES = {n: f for n, f in contract.queries().items() if n in OWN}


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    found = difference(QUERIES[name](spark, SF_DIR).toPandas(), connection.execute(ORACLES[name]).df())
    assert found is None, found


def test_entry(spark):
    assert contract.entry(spark).count() > 0


ORDERED = {
    "sma": lambda df: sma(df, "2,5"),
    "lag": lambda df: lag_series(df, "1,24"),
    "autocorrelation": lambda df: autocorrelation(df, "1", centered=True),
    "difference": lambda df: differences(df, "season,24"),
    "arima": lambda df: arima(df),
    "centred arima": lambda df: arima(df, centered=True),
    "strata": lambda df: describe_series(df, 2, 5),
    "gaps": gap_report,
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_no_task_gets_a_whole_series(spark, frame, name, tmp_path):
    """Rows are never windowed or exchanged by series alone; only per-block totals are."""
    path = str(tmp_path / "readings")
    frame({"a": [(h, h) for h in range(30)]}).write.parquet(path)
    plan = ORDERED[name](spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line) and "row_number" in line:
            assert "day_block" in line
        if "windowspecdefinition" in line and "value#" in line:
            assert "row_block" in line or "day_block" in line
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _lines(df, *words):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if any(w in line for w in words)]


def exchanges_and_scans(spark, df):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        exchanges = _lines(df, "Exchange hashpartitioning")
        blocks = sum("row_block" in line for line in exchanges), sum("day_block" in line for line in exchanges)
        return *blocks, len(_lines(df, "FileScan"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def stored(spark, frame, tmp_path):
    path = str(tmp_path / "readings")
    frame({"a": [(h, h) for h in range(30)]}).write.parquet(path)
    return lambda: spark.read.parquet(path)


@pytest.mark.parametrize("op", [lambda df: lag_series(df, "1-10"), lambda df: autocorrelation(df, "24,168", centered=True)])
def test_lags_take_two_scans_and_two_shuffles_of_rows(spark, stored, op):
    row_blocks, day_blocks, scans = exchanges_and_scans(spark, op(stored()))
    assert (row_blocks, day_blocks, scans) == (1, 3, 2)


@pytest.mark.parametrize(
    ("model", "scans"), [({}, 2), ({"q": "0.4,-0.3", "p": "0.5,0.3"}, 2), ({"centered": True}, 4), ({"q": "none"}, 2)]
)
def test_models_window_their_levels_once(spark, stored, model, scans):
    df = arima(stored(), **model)
    assert len(_lines(df, "FileScan")) == scans
    assert len(_lines(df, "lag(level_0#")) <= 2 * scans // 2


def test_stored_counts_save_a_scan(spark, frame, tmp_path):
    path = str(tmp_path / "readings")
    sinks.upsert_readings(frame({"a": [(24 * d, d) for d in range(100)]}), path)
    rows, counts = read_series(spark, path), read_counts(spark, path)
    for op in (lambda df, counts: sma(df, "2,5", counts=counts), lambda df, counts: differences(df, "step,2", counts=counts)):
        scans = _lines(op(rows, counts), "FileScan")
        assert len(scans) == 2 and sum("block_rows" in line for line in scans) == 1
        assert sorted(map(tuple, op(rows, counts).collect())) == sorted(map(tuple, op(rows, None).collect()))
    assert [r["value"] for r in first_rows(rows, 3, counts).orderBy("ts").collect()] == [0.0, 1.0, 2.0]
    part = read_series(spark, path, "2020-01-20 00:00:00", "2020-03-05 00:00:00")
    own = read_counts(spark, path, "2020-01-20 00:00:00", "2020-03-05 00:00:00")
    assert sorted(map(tuple, sma(part, 7, counts=own).collect())) == sorted(map(tuple, sma(part, 7).collect()))
    with pytest.raises(Exception, match="stored counts do not fit"):
        sma(part, 7, counts=counts).collect()
    with pytest.raises(Exception, match="stored counts do not fit"):
        sma(rows, 7, counts=own).collect()


def test_leading_rows_are_chosen_before_they_are_sorted(spark, frame, tmp_path):
    path = str(tmp_path / "readings")
    sinks.upsert_readings(frame({"a": [(24 * d, d) for d in range(100)]}), path)
    plan = first_rows(read_series(spark, path), 10, read_counts(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("row_number()") < plan.index("Join")  # the join is below the window


def test_rows_cross_the_network_twice(spark, frame, tmp_path):
    """Once to be numbered and once into row blocks; everything else exchanged is per block."""
    path = str(tmp_path / "readings")
    frame({"a": [(h, h) for h in range(30)]}).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for op in (sma, differences, lambda df: arima(df, q="none")):
            exchanges = _lines(op(spark.read.parquet(path)), "Exchange hashpartitioning")
            assert sum("row_block" in line for line in exchanges) == 1
            # numbering, the partial counts, and the block starts that go back to the rows
            assert sum("day_block" in line for line in exchanges) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_results_without_broadcast(spark, connection):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("sma_points", "lag_points", "arima_full", "arima_centered", "autocorr_centered_daily"):
            found = difference(QUERIES[name](spark, SF_DIR).toPandas(), connection.execute(ORACLES[name]).df())
            assert found is None, (name, found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
