"""What reaches the scan of a stored table."""

import pytest

from isochron.sources.tables import literal_prefix, match_series


@pytest.mark.parametrize(
    ("regex", "prefix"),
    [("rain_.*", "rain_"), ("rain_1?", "rain_"), ("a|b", ""), ("ab{2}", "a"), (".*", ""), ("x*", ""), (r"temp_\d+", "temp_")],
)
def test_literal_prefix(regex, prefix):
    assert literal_prefix(regex) == prefix


def test_names_and_prefixes_are_pushed(spark, frame, tmp_path):
    path = str(tmp_path / "readings")
    frame({f"{m}_{n}": [(0, n)] for m in ("rain", "temp") for n in range(20)}).write.parquet(path)
    stored = spark.read.parquet(path)
    plain = match_series(stored, "rain_3,temp_4")
    assert "In(series, [rain_3,temp_4])" in plain._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["series"] for r in plain.collect()) == ["rain_3", "temp_4"]
    some = match_series(stored, r"rain_1\d?")
    assert "StringStartsWith(series,rain_" in some._jdf.queryExecution().executedPlan().toString()
    assert some.count() == 11 and match_series(stored, ["temp_2.*", "rain_0"]).count() == 2
