import pytest
from pyspark.sql import functions as F

from isochron.functions.specs import differencing_spec, range_spec, year_spec
from isochron.functions.timekeys import file_time, hour_floor, hour_key, reading_time
from isochron.functions.values import analytic_value, blank_to_zero, decode_cell, parse_type_map
from isochron.operators import filters
from isochron.operators.filters import Condition, keep_where
from isochron.sources.tables import at_key, match_series, read_series, time_range


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(i, f"s{i}") for i in range(1, 8)], "n int, name string")


def kept(df):
    return sorted(r["n"] for r in df.collect())


@pytest.mark.parametrize(
    ("condition", "expected"),
    [
        (Condition("n", "<", 3), [1, 2]),
        (Condition("n", "<=", 3), [1, 2, 3]),
        (Condition("n", "=", 3), [3]),
        (Condition("n", ">=", 6), [6, 7]),
        (Condition("n", ">", 6), [7]),
        (Condition("n", "<", [3, 5]), [1, 2]),
        (Condition("n", "<=", [3, 5]), [1, 2, 3]),
        (Condition("n", "=", [3, 5]), [3, 5]),
        (Condition("n", ">=", [3, 5]), [5, 6, 7]),
        (Condition("n", ">", [3, 5]), [6, 7]),
        (Condition("n", "in", [1, 7]), [1, 7]),
        (Condition("n", "=", "max"), [7]),
        (Condition("n", ">", "min"), [2, 3, 4, 5, 6, 7]),
        (Condition("n", None), [1, 2, 3, 4, 5, 6, 7]),
        (None, [1, 2, 3, 4, 5, 6, 7]),
        ([Condition("n", ">", 2), Condition("n", "=", "max")], [7]),
        ([Condition("n", "<", 5), Condition("n", "=", "max"), Condition("name", "=", "s4")], [4]),
    ],
)
def test_conditions(numbers, condition, expected):
    assert kept(keep_where(numbers, condition)) == expected


def test_extreme_is_no_cross_join(numbers):
    plan = keep_where(numbers, Condition("n", "=", "max"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize(
    ("spec", "expected"),
    [("<3", None), ("<0003", [1, 2]), ("<= 0003", [1, 2, 3]), ("=0003", [3]), (">=0006", [6, 7]), (">0006", [7]), (4, [4])],
)
def test_year_spec(numbers, spec, expected):
    if expected is None:
        with pytest.raises(ValueError):
            year_spec(spec, F.col("n"))
    else:
        assert kept(numbers.filter(year_spec(spec, F.col("n")))) == expected


def test_year_spec_none(spark):
    assert year_spec("none", F.col("n")) is None and year_spec(None, F.col("n")) is None


def test_specs():
    assert range_spec("5") == [5]
    assert range_spec("3,5") == [3, 5]
    assert range_spec("1-4") == [1, 2, 3, 4]
    assert range_spec("") == range_spec(" ") == []
    assert range_spec("1-3, 7") == [1, 2, 3, 7] and range_spec([2, 5]) == [2, 5] and range_spec(-1) == [-1]
    for bad in ("1,,2", "a", "1-", "1-2-3"):
        with pytest.raises(ValueError, match="neither a number nor a range"):
            range_spec(bad)
    assert differencing_spec("season,12") == ("season", 12)
    assert differencing_spec("STEP,2") == ("step", 2)
    assert differencing_spec("") == ("step", 0)


def test_column_choice():
    columns = ["date", "rain_1", "rain_22", "wetb_1", "wdsp_1", "ind_rain_1"]
    assert filters.columns_matching(columns, r"rain_\d+") == ["rain_1", "rain_22"]
    assert filters.columns_matching(columns, "rain_1,.*dsp.*") == ["rain_1", "wdsp_1"]
    assert filters.columns_matching(columns, ".*") == columns[1:]
    assert filters.columns_with_prefix(columns, ["w"]) == ["wetb_1", "wdsp_1"]


def test_drop_station_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "rain_1 int, temp_1 int, temp_11 int, temp_2 int")
    assert filters.drop_station_columns(df, 1, ["rain"]).columns == ["rain_1", "temp_11", "temp_2"]


def cells(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "raw string")


def test_bad_values(spark):
    texts = ["13.7", " 1.5 ", "abc", "nan", "NaN", "inf", "Infinity", "-Infinity", "", None]
    zero = [r[0] for r in cells(spark, texts).select(analytic_value(F.col("raw"))).collect()]
    assert zero[:4] == [13.699999809265137, 1.5, 0.0, 0.0]
    assert zero[4] != zero[4]
    assert zero[5:] == [0.0, float("inf"), float("-inf"), 0.0, None]
    null = [r[0] for r in cells(spark, texts).select(analytic_value(F.col("raw"), "null")).collect()]
    assert null[1:4] == [1.5, None, None]
    with pytest.raises(ValueError):
        analytic_value(F.col("raw"), "keep")


def test_blank_to_zero(spark):
    df = spark.createDataFrame([("rain", " "), ("ind_rain", " "), ("w", ""), ("rain", "2")], "m string, raw string")
    assert [r[0] for r in df.select(blank_to_zero(F.col("raw"), F.col("m"))).collect()] == ["0", " ", "0", "2"]


def test_type_map(spark):
    rules = parse_type_map("str(rain_.*), dbl(temp_\\d),int(n_1),nonsense,xyz(a)")
    assert rules == [("rain_.*", "string"), ("temp_\\d", "double"), ("n_1", "int")]
    df = spark.createDataFrame(
        [("rain_1", "x"), ("rain_1", "0.1"), ("temp_1", "0.1"), ("temp_12", "5"), ("n_1", "7")], "s string, raw string"
    )
    values = [r[0] for r in df.select(decode_cell(F.col("s"), F.col("raw"), rules)).collect()]
    assert values == [0.0, 0.10000000149011612, 0.10000000149011612, None, 7.0]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 2020-03-08 02:30 does not exist in New York
        df = spark.sql("SELECT TIMESTAMP_NTZ '2020-03-08 02:30:15' AS ts, '2020-03-08 02:00:00' AS d, 'r-2020030802' AS k")
        row = df.select(
            hour_floor(F.col("ts")).cast("string").alias("floor"),
            hour_key(F.col("ts")).alias("key"),
            reading_time(F.col("d"), F.col("k")).cast("string").alias("a"),
            reading_time(F.lit(None).cast("string"), F.col("k")).cast("string").alias("b"),
        ).first()
        assert (row.floor, row.key, row.a, row.b) == (
            "2020-03-08 02:00:00", "r-2020030802", "2020-03-08 02:00:00", "2020-03-08 02:00:00",
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_file_dates(spark):
    texts = ["2020-01-05 06:00:00", "2020-01-05 06:00", "2020-01-05", "05-jan-2020 06:00", "05-JAN-2020"]
    found = cells(spark, texts).select(file_time(F.col("raw")).cast("string")).collect()
    assert [r[0][:13] for r in found] == ["2020-01-05 06", "2020-01-05 06", "2020-01-05 00", "2020-01-05 06", "2020-01-05 00"]
    with pytest.raises(Exception, match="soon"):
        cells(spark, ["soon"]).select(file_time(F.col("raw"))).collect()


def test_time_range_reaches_the_scan(spark, frame, tmp_path):
    path = str(tmp_path / "readings")
    frame({"a": [(h, h) for h in range(50)]}).write.parquet(path)
    df = read_series(spark, path, "2020-01-01 05:59:59", "2020-01-02 01:30:00")
    assert sorted(r["value"] for r in df.collect()) == list(range(5, 25))
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    one = at_key(spark.read.parquet(path), "r-2020010107")
    assert [r["value"] for r in one.collect()] == [7.0]
    assert "EqualTo(ts" in one._jdf.queryExecution().executedPlan().toString()
    assert time_range(df).count() == df.count()


def test_match_is_full(frame):
    df = frame({"rain_1": [(0, 1)], "rain_12": [(0, 1)], "xrain_1": [(0, 1)]})
    assert [r["series"] for r in match_series(df, "rain_1").collect()] == ["rain_1"]
    assert match_series(df, ["rain_1", "x.*"]).count() == 2
