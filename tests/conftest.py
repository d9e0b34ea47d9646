import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from isochron.session import local_session  # noqa: E402

START = dt.datetime(2020, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, shuffle_partitions=4, memory="4g", checkpoint_dir=f"file://{tmp_path_factory.mktemp('shared')}")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Canonical frame from ``{series: [(hour, value), ..]}``."""

    def make(series: dict):
        rows = [
            (name, START + dt.timedelta(hours=hour), float(value))
            for name, points in series.items()
            for hour, value in points
        ]
        return spark.createDataFrame(rows, "series string, ts timestamp_ntz, value double")

    return make


def hour(n: int) -> dt.datetime:
    return START + dt.timedelta(hours=n)
