import os

import pytest
from conftest import hour
from pyspark.sql import functions as F

from isochron import monthly, sinks
from isochron.operators.reshape import merge_wide, to_wide, wide_to_series
from isochron.operators.smoothing import sma, sma_metrics
from isochron.operators.stats import series_stats
from isochron.plans import jobs
from isochron.sources.tables import read_series

V = {"V": list(enumerate([1, 2, 4, 8, 16, 32]))}


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def test_replace(frame, path):
    sinks.replace_table(frame(V), path)
    assert sinks.replace_table(frame({"W": [(0, 1)]}), path).count() == 1


def test_upsert(spark, frame, path):
    assert sinks.read_table(spark, path) is None
    sinks.upsert_table(series_stats(frame({"a": [(0, 1)], "b": [(0, 2)]})), path, ["series"])
    sinks.upsert_table(series_stats(frame({"b": [(0, 5)], "c": [(0, 3)]})), path, ["series"])
    assert {r["series"]: r["mean"] for r in sinks.read_table(spark, path).collect()} == {"a": 1.0, "b": 5.0, "c": 3.0}


def test_unfinished_snapshot_is_ignored(spark, frame, path, tmp_path):
    sinks.upsert_table(series_stats(frame({"a": [(0, 1)]})), path, ["series"])
    series_stats(frame({"a": [(0, 9)]})).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{path}/snapshot-2")
    assert sinks.read_table(spark, path).first()["mean"] == 1.0


def files_of(df):
    return sorted(df.inputFiles())


def points_of(frame, values):
    return frame({"a": [(24 * day, v) for day, v in values.items()]}).withColumn("lag", F.lit(1))


def test_upsert_rewrites_touched_months_only(spark, frame, path):
    keys = ["series", "ts", "lag"]
    first = sinks.upsert_table(points_of(frame, {0: 1, 40: 2, 41: 3, 70: 4}), path, keys)
    assert first.count() == 4
    before = files_of(first)
    second = sinks.upsert_table(points_of(frame, {41: 30, 42: 5, 100: 6}), path, keys)
    stored = {(r["ts"] - hour(0)).days: r["value"] for r in second.collect()}
    assert stored == {0: 1.0, 40: 2.0, 41: 30.0, 42: 5.0, 70: 4.0, 100: 6.0}
    kept = [f for f in files_of(second) if f in before]
    assert [m for m in ("2020-01", "2020-02", "2020-03") if any(f"month={m}" in f for f in kept)] == ["2020-01", "2020-03"]
    assert files_of(sinks.read_table(spark, path)) == files_of(second)


def test_second_writer_is_refused(spark, frame, path, monkeypatch):
    sinks.upsert_table(points_of(frame, {0: 1}), path, ["series", "ts"])
    begun = monthly.manifest(spark, path)
    sinks.upsert_table(points_of(frame, {0: 2}), path, ["series", "ts"])
    with monkeypatch.context() as patch:
        patch.setattr(monthly, "manifest", lambda *_: begun)  # a writer that began before the other had ended
        with pytest.raises(monthly.ConcurrentWrite):
            sinks.upsert_table(points_of(frame, {0: 3, 50: 3}), path, ["series", "ts"])
    assert [r["value"] for r in sinks.read_table(spark, path).collect()] == [2.0]
    assert monthly.remove_unlisted(spark, path) == []


def test_old_files_go_by_rule(spark, frame, path):
    for value in range(5):
        sinks.upsert_table(points_of(frame, {0: value, 40 + 40 * value: 0}), path, ["series", "ts"])
    listed = monthly.Files(spark, path).names(f"{path}/manifest")
    assert sorted(n for n in listed if n.endswith(".json")) == ["4.json", "5.json"]
    januaries = spark.read.parquet(f"{path}/data/*/*/month=2020-01").count()
    assert januaries == 2  # of the last two manifests
    assert sinks.read_table(spark, path).count() == 6


def test_files_of_a_dead_writer(spark, frame, path):
    sinks.upsert_table(points_of(frame, {0: 1}), path, ["series", "ts"])
    points_of(frame, {0: 9}).write.parquet(f"{path}/data/dead/new")
    assert [r["value"] for r in sinks.read_table(spark, path).collect()] == [1.0]
    assert monthly.remove_unlisted(spark, path) == ["dead"]
    assert sinks.read_table(spark, path).count() == 1


def test_range_opens_its_months(spark, frame, path):
    sinks.upsert_table(points_of(frame, {0: 1, 40: 2, 70: 3}), path, ["series", "ts"])
    february = sinks.read_table(spark, path, "2020-02-01", "2020-02-29")
    assert [r["value"] for r in february.collect()] == [2.0]
    assert all("month=2020-02" in f for f in february.inputFiles())
    assert sinks.read_table(spark, path, "2021-01-01").count() == 0


def test_rows_without_time_and_empty_tables(spark, frame, path):
    rows = points_of(frame, {0: 1})
    odd = rows.withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    assert sinks.upsert_table(rows.limit(0), path, ["series", "ts"]).collect() == []
    sinks.upsert_table(rows.unionByName(odd), path, ["series", "ts"])
    assert sinks.upsert_table(odd.withColumn("value", F.lit(7.0)), path, ["series", "ts"]).count() == 2
    assert {r["value"] for r in sinks.read_table(spark, path).collect()} == {1.0, 7.0}


def test_wide_table_lists_its_columns(spark, frame, path):
    sinks.upsert_wide(to_wide(frame({"x": [(0, 1)], "y": [(0, 2)]}), ["x", "y"]), path)
    sinks.upsert_wide(to_wide(frame({"z": [(24 * 40, 3)], "x": [(24 * 40, 4)]}), ["x", "z"]), path)
    wide = sinks.upsert_wide(to_wide(frame({"x": [(0, 10)], "z": [(1, 5)]}), ["x", "z"]), path)
    assert wide.columns == ["ts", "x", "y", "z"]
    assert {r["ts"]: tuple(r)[1:] for r in wide.collect()} == {
        hour(0): (10.0, 2.0, None), hour(1): (None, None, 5.0), hour(24 * 40): (4.0, None, 3.0),
    }
    month = sinks.read_wide(spark, path, "2020-02", "2020-02")
    assert month.columns == wide.columns and [tuple(r)[1:] for r in month.collect()] == [(4.0, None, 3.0)]
    assert len(month.inputFiles()) == 1 and "month=2020-02" in month.inputFiles()[0]
    with pytest.raises(TypeError):
        sinks.upsert_wide(wide.where("false").select("ts", F.lit("text").alias("x")).unionByName(spark.createDataFrame([(hour(24 * 80), "a")], "ts timestamp_ntz, x string")), path)


def test_overall_stats_are_upserted_too(spark, frame, path):
    for shift in (0, 1):
        jobs.analysis(frame({"a": [(0, 1 + shift), (1, 2)], "b": [(0, 3)]}), 2, 1, out=path)
    stats = sinks.read_table(spark, path)
    assert stats.filter("series = 'a' AND stratum IS NULL").count() == 1
    assert stats.filter("series = 'a' AND stratum = 0").first()["mean"] == 2.0


def test_readings_by_month(spark, frame, path):
    sinks.upsert_readings(frame({"a": [(0, 1), (1, 2), (24 * 40, 3)]}), path)
    january = [p for p in spark.read.parquet(path).filter("month = '2020-02'").inputFiles() if "2020-02" in p]
    sinks.upsert_readings(frame({"a": [(1, 20)], "b": [(2, 5)]}), path)
    stored = {(r["series"], r["ts"]): r["value"] for r in spark.read.parquet(path).collect()}
    assert stored == {
        ("a", hour(0)): 1.0, ("a", hour(1)): 20.0, ("a", hour(24 * 40)): 3.0, ("b", hour(2)): 5.0,
    }
    untouched = [p for p in spark.read.parquet(path).inputFiles() if "2020-02" in p]
    assert untouched == january


def test_range_skips_other_months(spark, frame, path):
    sinks.upsert_readings(frame({"a": [(24 * d, d) for d in range(200)]}), path)
    df = read_series(spark, path, "2020-02-10 00:00:00", "2020-03-02 00:00:00")
    assert sorted(r["value"] for r in df.collect()) == list(range(40, 61))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]


def test_text_and_csv(spark, frame, path, tmp_path):
    points = sma(frame(V), 3)
    sinks.write_sma_text(points, path)
    assert spark.read.text(path).count() == 6
    csv = str(tmp_path / "csv")
    metrics = sma_metrics(points)
    sinks.append_metrics_csv(metrics, csv)
    sinks.append_metrics_csv(metrics, csv)
    stored = sinks.read_csv(spark, csv, sinks.metrics_csv(metrics).schema)
    assert stored.columns[0] == "series" and stored.columns[1:] == sorted(stored.columns[1:])
    assert stored.count() == 2 and stored.distinct().count() == 1
    lines = lines_of(csv)
    assert lines[0] == ",".join(stored.columns) and len(lines) == 3


def lines_of(folder):
    """The pieces of an export, in the order of their names."""
    names = sorted(n for n in os.listdir(folder) if n.endswith(".csv") and not n.startswith("."))
    return [line for n in names for line in open(os.path.join(folder, n)).read().splitlines()]


def test_export_keeps_the_order_of_appends(spark, path):
    for first in (100, 50, 0):
        rows = spark.range(first, first + 40).select(F.col("id").cast("string").alias("name"), "id").repartition(5)
        sinks.append_csv(rows.where("id < 130"), path)
    assert lines_of(path)[0] == "name,id"
    own = sorted(map(str, range(100, 130))), sorted(map(str, range(50, 90))), sorted(map(str, range(40)))
    assert [line.split(",")[0] for line in lines_of(path)[1:]] == [n for names in own for n in names]
    with pytest.raises(ValueError, match="has the columns"):
        sinks.append_csv(spark.range(1), path)
    assert sinks.read_csv(spark, path, "name string, id long").count() == 110
    sinks.append_csv(spark.range(0).select(F.lit("").alias("name"), "id"), path)
    assert len(lines_of(path)) == 111


def test_merge_wide(frame):
    old = to_wide(frame({"x": [(0, 1), (1, 2)], "y": [(0, 5)]}), ["x", "y"])
    new = to_wide(frame({"y": [(1, 7), (2, 8)], "z": [(0, 9)]}), ["y", "z"])
    merged = {r["ts"]: (r["x"], r["y"], r["z"]) for r in merge_wide(old, new).collect()}
    assert merged == {hour(0): (1.0, 5.0, 9.0), hour(1): (2.0, 7.0, None), hour(2): (None, 8.0, None)}


def test_wide_round_trip(frame):
    df = frame({"rain_1": [(0, 1), (5, 2)], "rain_2": [(5, 3)]})
    back = wide_to_series(to_wide(df))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_wide_choice_prunes_the_scan(spark, frame, path):
    to_wide(frame({"rain_1": [(0, 1)], "temp_1": [(0, 3)]})).write.parquet(path)
    long = wide_to_series(spark.read.parquet(path), "rain_.*")
    assert [r["series"] for r in long.collect()] == ["rain_1"]
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "temp_1" not in plan[plan.index("ReadSchema") :]


@pytest.mark.parametrize(
    "run",
    [
        lambda df, out: jobs.transform(df, "1,2", centered=True, out=out),
        lambda df, out: jobs.differencing(df, "step,2", out=out),
        lambda df, out: jobs.moving_average(df, "2,3", out=out),
        lambda df, out: jobs.arima(df, out=out, d=1),
    ],
)
def test_stored_results_equal_direct_ones(frame, path, run):
    df = frame({**V, "W": [(h, h * h % 7) for h in range(20)]})
    for stored, direct in zip(run(df, path), run(df, None)):
        assert sorted(map(str, stored.select(*sorted(stored.columns)).collect())) == sorted(
            map(str, direct.select(*sorted(direct.columns)).collect())
        )


def test_job_input_choice(frame):
    df = frame({"rain_1": [(h, h) for h in range(10)], "temp_1": [(0, 1)]})
    chosen = jobs.readings(df, "rain_.*", start="2020-01-01 02:00:00", stop="2020-01-01 05:00:00")
    assert chosen.agg(F.sum("value")).first()[0] == 2 + 3 + 4
