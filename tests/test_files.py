"""Station files on disk, from zips to loaded readings and profiles."""

import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog import station_queries
from catalog.file_queries import disordered_files
from isochron.functions.timekeys import file_time
from isochron.operators.gaps import line_gaps, missing_hours
from isochron.operators.profile import station_gaps
from isochron.plans.stations import load_readings, profile, station_cells
from isochron.sources.station_files import _unzip, contents, file_lines, fixed_rows, line_cells, list_files, preferred_files, unknown_files
from isochron.sources.stations import choose_stations, read_stations, read_stations_checked

SF = "/root/testdata/sf0.001"

STATION_TEXT = """Station details: extracted 2020
County,Station Number,name,Height (m),Easting,Northing,Latitude,Longitude,Open Year,Close Year
Cork,3904,"ROCHES, POINT",40,183100,60100,51.793,-8.244,1867,
Cork,4000,CASTLEMAGNER,120,1,2,52.1,-8.8,1941,0
Mayo,575,BELMULLET,9,69000,332600,54.228,-10.007,1956,1999
Mayo,99,NO DATA,9,69000,332600,54.228,-10.007,1990,
"""

HOURLY = """Station Name: ROCHES POINT
Station Height: 40 M

date:  -  Date and Time (utc)
rain:  -  Precipitation Amount (mm)

date,ind,rain,ind,temp,w
01-jan-2020 00:00,0,0.1,0,13.7,
01-jan-2020 01:00,2, ,,12.5,7
01-jan-2020 04:00,0,0.3,0,abc,8
01-jan-2020 04:00,0,0.4,0,11.0,9
"""

DAILY = """Station Name: BELMULLET

date:  -  Date
date,ind,rain
01-jan-2020,0,1.5
02-jan-2020,0,
"""


def put(folder, name, text):
    with zipfile.ZipFile(folder / f"{name}.zip", "w") as archive:
        archive.writestr(f"{name}.csv", text)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("stations")
    (path / "StationDetails.csv").write_text(STATION_TEXT)
    put(path, "hly3904", HOURLY)
    put(path, "dly3904", DAILY)
    put(path, "dly575", DAILY)
    put(path, "xyz1", DAILY)
    return path


@pytest.fixture(scope="module")
def stations(spark, folder):
    return read_stations(spark, str(folder / "StationDetails.csv"))


@pytest.fixture(scope="module")
def cells(spark, folder, stations):
    return station_cells(spark, str(folder), stations).cache()


def test_stations(stations):
    rows = {r["station"]: r for r in stations.collect()}
    assert set(rows) == {3904, 4000, 575, 99}
    assert rows[3904]["name"] == "ROCHES POINT"
    assert rows[3904]["close_year"] == 9999
    assert rows[4000]["close_year"] == 2002
    assert (rows[575]["height"], rows[575]["latitude"], rows[575]["open_year"]) == (9.0, 54.228, 1956)


def test_choice(stations):
    def numbers(**choice):
        return sorted(r["station"] for r in choose_stations(stations, **choice).collect())

    assert numbers(county="Cork") == [3904, 4000]
    assert numbers(close_year=9999) == [99, 3904]
    assert numbers(open_year="<1950") == [3904, 4000]
    assert numbers(number=575) == [575]
    assert numbers(number=[575, 99]) == [99, 575]
    assert numbers(county="none", close_year="none") == [99, 575, 3904, 4000]


def test_preferred_files(spark, folder):
    names = {(r["station"], r["file_type"]) for r in preferred_files(list_files(spark, str(folder))).collect()}
    assert names == {(3904, "hly"), (575, "dly")}


def test_cells(cells):
    rows = {(r["series"], r["line_no"]): r["raw"] for r in cells.collect()}
    assert rows["ind_rain_3904", 1] == "2" and rows["ind_temp_3904", 1] == ""
    assert rows["rain_3904", 1] == "0"  # blank
    assert rows["w_3904", 0] == "0"
    assert rows["temp_3904", 2] == "abc"
    assert rows["rain_575", 1] == "0"
    assert not any(series.startswith("date") for series, _ in rows)


def test_load(cells):
    got = {(r["series"], str(r["ts"])): r["value"] for r in load_readings(cells, ["rain", "temp"]).collect()}
    assert got == {
        ("rain_3904", "2020-01-01 00:00:00"): pytest.approx(0.1, rel=1e-6),
        ("rain_3904", "2020-01-01 01:00:00"): 0.0,
        ("rain_3904", "2020-01-01 04:00:00"): pytest.approx(0.4, rel=1e-6),  # the later line of that hour
        ("temp_3904", "2020-01-01 00:00:00"): 13.699999809265137,
        ("temp_3904", "2020-01-01 01:00:00"): 12.5,
        ("temp_3904", "2020-01-01 04:00:00"): 11.0,
        ("rain_575", "2020-01-01 00:00:00"): 1.5,
        ("rain_575", "2020-01-02 00:00:00"): 0.0,
    }
    ranged = load_readings(cells, ["rain"], begin="2020-01-01 01:00:00", end="2020-01-01 04:00:00")
    assert sorted(str(r["ts"]) for r in ranged.collect()) == ["2020-01-01 01:00:00", "2020-01-01 04:00:00"]
    assert load_readings(cells).filter(F.col("series") == "ind_temp_3904").count() == 2  # '' is dropped


def test_row_cap(spark, folder):
    files = contents(preferred_files(list_files(spark, str(folder))))
    assert file_lines(files, max_rows=1).groupBy("station").count().agg(F.max("count")).first()[0] == 1


def test_fixed_layout(spark, tmp_path):
    put(tmp_path, "dly7", "Legend\n" * 9 + "date,ind,rain\n2020-01-01 00:00:00,0,2.5\n2020-01-02 00:00:00,1,\n")
    columns = "date," + ",".join(f"c{i}" for i in range(20))
    line = "2020-01-01 05:00:00,0,1.5,0,9.5,0,8.5,7.5,10.1,80,1010.5,0,5,0,270,2,11,0.5,30000,999,4"
    put(tmp_path, "hly8", "Legend\n" * 23 + columns + "\n" + line + "\n")
    lines = file_lines(contents(list_files(spark, str(tmp_path))), fixed_layout=True)
    found = line_cells(lines).collect()
    raw = {r["series"]: r["raw"] for r in found if r["line_no"] == 0}
    assert raw["rain_7"] == "2.5" and raw["irain_7"] == "0"
    assert raw["rain_8"] == "1.5" and raw["clamt_8"] == "4" and raw["iwddir_8"] == "0" and len(raw) == 22
    hourly = fixed_rows(lines, "hly").first()
    assert (hourly["temp"], hourly["rhum"], hourly["clamt"], str(hourly["date"])) == (9.5, 80, 4, "2020-01-01 05:00:00")
    assert sorted((r["irain"], r["rain"]) for r in fixed_rows(lines, "dly").collect() if r["rain"]) == [(0, 2.5)]
    assert [r["rain"] for r in fixed_rows(lines, "dly").orderBy("date").collect()] == [2.5, None]


def test_header_below_a_long_legend(spark, tmp_path):
    put(tmp_path, "hly5", "Legend\n" * 150 + "date,rain\n2020-01-01 00:00:00,1\n\n 2020-01-01 01:00:00,2")
    lines = file_lines(contents(list_files(spark, str(tmp_path)))).collect()
    assert [(r["header"], r["line_no"], r["line"]) for r in lines] == [
        ("date,rain", 0, "2020-01-01 00:00:00,1"), ("date,rain", 1, "2020-01-01 01:00:00,2")
    ]


def test_cells_beyond_the_header_are_an_error(spark, tmp_path):
    put(tmp_path, "hly5", "date,rain\n2020-01-01 00:00:00,1,\n")
    files = contents(list_files(spark, str(tmp_path)))
    assert [r["raw"] for r in line_cells(file_lines(files)).collect()] == ["1"]
    put(tmp_path, "hly6", "date,rain\n2020-01-01 00:00:00,1,2\n")
    with pytest.raises(Exception, match="more cells than the header has"):
        line_cells(file_lines(contents(list_files(spark, str(tmp_path))))).collect()


def test_no_header_is_an_error(spark, tmp_path):
    put(tmp_path, "hly5", "Legend\n" * 150)
    with pytest.raises(Exception, match="hly5.zip has no header line"):
        file_lines(contents(list_files(spark, str(tmp_path)))).collect()


def test_chunks_are_cut_at_line_ends(spark, tmp_path):
    rows = [f"2020-01-{d:02d} 00:00:00,{d}" for d in range(1, 29)]
    put(tmp_path, "hly5", "Legend\ndate,rain\r\n" + "\r\n\r\n".join(rows))
    for cap in (None, 5):
        found = file_lines(contents(list_files(spark, str(tmp_path))), max_rows=cap, chunk=7).orderBy("line_no").collect()
        assert [(r["line_no"], r["line"]) for r in found] == list(enumerate(rows[:cap]))


def test_files_of_other_stations_stay_closed(spark, folder, stations, tmp_path):
    (tmp_path / "hly3904.zip").write_bytes((folder / "hly3904.zip").read_bytes())
    (tmp_path / "hly1234.zip").write_bytes(b"not a zip")
    assert station_cells(spark, str(tmp_path), stations).select("station").distinct().count() == 1


def test_locations(spark, folder, stations, tmp_path):
    """The first location that has any file of a station counts, whatever its type; one that is not there has none."""
    near = tmp_path / "near"
    near.mkdir()
    put(near, "dly3904", DAILY.replace("1.5", "9.5"))
    put(near, "hly42", HOURLY)
    chosen = preferred_files(list_files(spark, [str(tmp_path / "absent"), str(near), str(folder)])).collect()
    assert {(r["station"], r["file_type"], r["location"]) for r in chosen} == {(3904, "dly", 1), (42, "hly", 1), (575, "dly", 2)}
    assert all(r["path"].endswith(f"{r['file_type']}{r['station']}.zip") for r in chosen)
    cells = station_cells(spark, [str(near), str(folder)], stations)
    assert {(r["series"], r["raw"]) for r in cells.filter("measure = 'rain' AND line_no = 0").collect()} == {
        ("rain_3904", "9.5"), ("rain_575", "1.5"),
    }
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        list_files(spark, [str(tmp_path / "absent")])


def test_names_that_are_no_readings_files(spark, tmp_path):
    for name in ("hly1", "xyz1", "hly99999999999", "readme", "hly1x"):
        put(tmp_path, name, "date,rain\n")
    found = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in unknown_files(spark, str(tmp_path)).collect()}
    assert found == {
        "xyz1.zip": "neither a type nor a station in the name", "readme.zip": "neither a type nor a station in the name",
        "hly1x.zip": "neither a type nor a station in the name", "hly99999999999.zip": "station number is too large",
    }
    assert [r["station"] for r in list_files(spark, str(tmp_path)).collect()] == [1]


def test_faults_of_the_station_file(spark, tmp_path):
    broken = """Cork,39x4,BAD NUMBER,1,2,3,4,5,1867,
Cork,,NO NUMBER,1,2,3,4,5,1867,
Cork,-5,NEGATIVE,1,2,3,4,5,1867,
Cork,7,HIGH,tall,2,3,4,5,18.67,
Cork,8,"A, B",1,2,3,4,5,1867,1990,more
Cork,9,SHORT,1

"""
    (tmp_path / "stations.csv").write_text(STATION_TEXT + broken)
    found = read_stations_checked(spark, str(tmp_path / "stations.csv"))
    rows = {r["station"]: r for r in found.stations.collect()}
    assert set(rows) == {3904, 4000, 575, 99, 7, 8, 9}
    assert rows[7]["height"] is None and rows[8]["name"] == "A B" and rows[9]["close_year"] == 9999
    faults = {(r["line"].split(",")[2], r["column"], r["reason"]) for r in found.faults.collect()}
    assert faults == {
        ("BAD NUMBER", "station", "not a number"), ("NO NUMBER", "station", "missing"), ("NEGATIVE", "station", "not a number"),
        ("HIGH", "height", "not a number"), ("HIGH", "open_year", "not a number"), ('"A', "", "too many cells"), ("SHORT", "", "too few cells"),
    }


def test_gaps_in_the_order_of_lines(spark, tmp_path):
    hours = [0, 1, 1, 3, 2, 4, 5, 30, 6]
    stamps = [f"2020-01-{1 + h // 24:02d} {h % 24:02d}:00:00" for h in hours]
    put(tmp_path, "hly5", "date,ind,rain\n" + "".join(f"{s},0,1\n" for s in stamps))
    cells = station_cells(spark, str(tmp_path), spark.createDataFrame([(5,)], "station int"))
    gaps = sorted((r["line_no"], str(r["missing_ts"])[5:16], str(r["next_ts"])[5:16]) for r in station_gaps(cells).collect())
    at = lambda h: f"01-{1 + h // 24:02d} {h % 24:02d}:00"
    assert gaps == [(i, at(a + 1), at(b)) for i, (a, b) in enumerate(zip(hours, hours[1:]), 1) if b != a + 1]
    named = station_gaps(cells).select(F.lit("hly5").alias("series"), "missing_ts", "next_ts")
    assert {str(r["ts"])[5:16] for r in missing_hours(named).collect()} == {at(2), at(3), *map(at, range(6, 30))}


def test_long_files_are_compared_block_by_block(spark):
    lines = spark.range(20_000).selectExpr(
        "'a' AS series", "id AS rn", "TIMESTAMP_NTZ '2020-01-01 00:00:00' + make_dt_interval(0, CAST(id + id div 3072 AS INT), 0, 0) AS ts"
    )
    assert sorted(r["rn"] for r in line_gaps(lines).collect()) == [3072 * k for k in range(1, 7)]


def test_profile(spark, cells, stations):
    result = profile(cells, stations)
    rows = {r["station_id"]: r for r in result.profile.collect()}
    first = rows[3904]
    assert (first["filename"], first["type"], first["station_name"]) == ("hly3904", "hly", "ROCHES POINT")
    assert first["columns"] == "date;ind_rain;rain;ind_temp;temp;w"
    assert first["col_na_count"] == "date=0;ind_rain_3904=0;rain_3904=0;ind_temp_3904=1;temp_3904=0;w_3904=0"
    assert first["col_null_count"] == first["col_na_count"]
    assert first["missing_lines"] == "2020-01-01 02:00:00|2020-01-01 05:00:00"  # the second is a line that comes twice
    assert rows[575]["missing_lines"] == "2020-01-01 01:00:00"
    coverage = {r["type"]: r for r in result.coverage.collect()}
    assert str(coverage["hly"]["common_end"]) == "2020-01-01 04:00:00"
    assert (coverage["hly"]["estimated_rows"], coverage["dly"]["estimated_rows"]) == (0, None)
    assert all(r["is_common"] for r in result.availability.collect())
    assert result.partial_holders.count() == 0


def test_files_are_opened_by_many_tasks(spark, tmp_path):
    """A list of names is short, so adaptive execution would have all files opened by one task."""
    for n in range(40):
        put(tmp_path, f"hly{n + 1}", HOURLY)
    lines = file_lines(list_files(spark, str(tmp_path)).drop("location"))
    assert lines.select(F.spark_partition_id().alias("task")).distinct().count() > 2


def test_a_line_in_the_standard_layout_is_split_once(spark, folder):
    rows = fixed_rows(file_lines(list_files(spark, str(folder)), fixed_layout=True), "hly")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(line") == 1


def test_blank_cells_are_not_tried(spark):
    rows = spark.createDataFrame([("hly", ",".join(["2020-01-01 00:00:00", "1", "0.5", *[""] * 18]))], "file_type string, line string")
    rows = fixed_rows(rows.withColumn("station", F.lit(1)), "hly")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(") == plan.count("THEN try_cast(") + plan.count("ELSE try_cast(")
    found = rows.first()
    assert (found["irain"], found["rain"], found["temp"], found["vappr"], found["rhum"], found["ww"]) == (1, 0.5, None, 0.0, 0, None)


def test_small_files_share_a_batch(tmp_path):
    for n in range(5):
        put(tmp_path, f"hly{n}", HOURLY)
    paths = pa.array([f"{tmp_path}/hly{n}.zip" for n in range(5)])
    files = pa.RecordBatch.from_arrays([paths, pa.array(range(5), pa.int32()), pa.array(["hly"] * 5)], names=["path", "station", "file_type"])
    whole = list(_unzip(None, None, 1 << 20)(iter([files])))
    assert [b.num_rows for b in whole] == [5]
    apart = list(_unzip(None, None, 64)(iter([files])))
    assert len(apart) == 5
    for n in range(5):
        text = ["\n".join(r["chunk"] for b in found for r in b.to_pylist() if r["station"] == n).split() for found in (whole, apart)]
        assert text[0] == text[1]


def test_usual_times_need_no_patterns(spark):
    texts = ["2020-01-02 03:04:05", "2020-01-02 03:04", "2020-01-02", "02-jan-2020 03:04", "02-Jan-2020"]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", file_time(F.col("t")).alias("ts"))
    times = [str(r["ts"]) for r in found.orderBy("i").collect()]
    assert times == ["2020-01-02 03:04:05", "2020-01-02 03:04:00", "2020-01-02 00:00:00", "2020-01-02 03:04:00", "2020-01-02 00:00:00"]


def test_supplier_files_need_no_group_in_python(spark):
    """A call of Python for each group costs some 10 ms, and there are as many groups as files."""
    for files in (station_queries.supplier_files(spark, SF), station_queries.supplier_files(spark, SF, fixed_layout=True), disordered_files(spark, SF)):
        assert "FlatMapGroupsInPandas" not in files._jdf.queryExecution().optimizedPlan().toString()
        names = [f"{r['file_type']}{r['station']}.zip" for r in files.collect()]
        assert names and len(names) == len(set(names))


def test_lines_come_cut_from_arrow(spark, tmp_path):
    put(tmp_path, "hly5", "Legend\ndate,rain\r\n \t2020-01-01 00:00:00,1 \r\n\x0b\x0c\n\n2020-01-02 00:00:00,\u00a02\u00a0\n\n")
    put(tmp_path, "hly6", "date,rain\n")
    put(tmp_path, "hly7", "date,rain\n2020-01-01 00:00:00,7")
    for chunk in (1 << 20, 5):
        lines = file_lines(list_files(spark, str(tmp_path)), chunk=chunk)
        assert "posexplode(lines#" in lines._jdf.queryExecution().optimizedPlan().toString()
        assert sorted((r["station"], r["line_no"], r["line"]) for r in lines.collect()) == [
            (5, 0, "2020-01-01 00:00:00,1"), (5, 1, "2020-01-02 00:00:00,\u00a02\u00a0"), (7, 0, "2020-01-01 00:00:00,7")
        ]


def test_cells_are_taken_from_a_line_split_once(spark, tmp_path):
    put(tmp_path, "hly5", "date,rain,w,ind\n2020-01-01 00:00:00,1\n2020-01-02 00:00:00, ,x, ,  ,\n")
    cells = line_cells(file_lines(list_files(spark, str(tmp_path))))
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(line") == 1 and "stringsplitsql" not in plan and "arrays_zip" not in plan
    found = sorted((r["line_no"], r["position"], r["measure"], r["series"], r["raw"]) for r in cells.collect())
    assert found == [(0, 1, "rain", "rain_5", "1"), (0, 2, "w", "w_5", None), (1, 1, "rain", "rain_5", "0"), (1, 2, "w", "w_5", "x")]


def test_usual_times_are_cast(spark):
    def times(*texts):
        return spark.createDataFrame([(t,) for t in texts], "t string").select(file_time(F.col("t")).alias("ts"))

    usual = times("2020-02-29 23:59:59", "0000-01-01 00:00:00")
    assert "as timestamp_ntz)" in usual._jdf.queryExecution().optimizedPlan().toString()
    assert [str(r[0]) for r in usual.select(F.col("ts").cast("string")).collect()] == ["2020-02-29 23:59:59", "0000-01-01 00:00:00"]
    for text in ("2020-01-02T03:04:05", "2020-02-30 00:00:00", "2020-01-02 24:00:00", "2020-1-02 03:04:05Z", "2020-01-02 03:04:5."):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
            times(text).collect()


def test_supplier_files_are_zipped_by_many_tasks(spark):
    """Days are short, so adaptive execution would have all of their files zipped by one task."""
    files = station_queries.supplier_files(spark, SF, fixed_layout=True)
    assert files.select(F.spark_partition_id().alias("task")).distinct().count() > 2


def test_chosen_files_with_contents_are_read_by_many_tasks(spark, tmp_path):
    for n in range(40):
        put(tmp_path, f"hly{n + 1}", HOURLY)
        put(tmp_path, f"dly{n + 1}", DAILY)
    lines = file_lines(preferred_files(contents(list_files(spark, str(tmp_path)))))
    assert [r[0] for r in lines.select("file_type").distinct().collect()] == ["hly"]
    assert lines.select(F.spark_partition_id().alias("task")).distinct().count() > 2


def test_row_cap_leaves_lines_out_before_they_are_rows(spark, tmp_path):
    rows = [f"2020-01-{d:02d} 00:00:00,{d}" for d in range(1, 29)]
    for n in (3, 5, 28):
        put(tmp_path, f"hly{n}", "Legend\ndate,rain\n" + "\n\n \n".join(rows[:n]) + "\n\n")
    for cap, chunk in ((0, 100), (1, 100), (4, 7), (4, 100), (5, 1 << 20), (28, 100), (99, 1 << 20)):
        lines = file_lines(list_files(spark, str(tmp_path)), max_rows=cap, chunk=chunk)
        assert "Filter ((first_line#" not in lines._jdf.queryExecution().optimizedPlan().toString()
        found = sorted((r["station"], r["line_no"], r["line"]) for r in lines.collect())
        assert found == [(n, *pair) for n in (3, 5, 28) for pair in enumerate(rows[: min(n, cap)])]


def test_files_are_read_to_their_end_under_a_row_cap(spark, tmp_path):
    put(tmp_path, "hly5", "date,rain\n2020-01-01 00:00:00,1\n2020-01-02 00:00:00,2\n" + "2020-01-03 00:00:00,3\n" * 9)
    packed = (tmp_path / "hly5.zip").read_bytes()  # stored, not deflated
    at = packed.rindex(b",3\n") + 1
    (tmp_path / "hly5.zip").write_bytes(packed[:at] + b"4" + packed[at + 1 :])
    with pytest.raises(Exception, match="Bad CRC-32"):
        file_lines(list_files(spark, str(tmp_path)), max_rows=1, chunk=40).collect()
