import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from farelane.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    session = local_session("*", 4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


TRIP = dict(
    key="a",
    fare_amount=11.0,
    pickup_datetime="2013-07-06 17:18:00",
    pickup_longitude=-73.950655,
    pickup_latitude=40.783282,
    dropoff_longitude=-73.984365,
    dropoff_latitude=40.769802,
    passenger_count=1,
)


@pytest.fixture()
def trips(spark):
    """Build raw trips from overrides of one good trip."""
    from datetime import datetime

    from farelane.schema import RAW

    def build(*changes):
        rows = []
        for change in changes:
            row = {**TRIP, **change}
            if isinstance(row["pickup_datetime"], str):
                row["pickup_datetime"] = datetime.fromisoformat(row["pickup_datetime"])
            rows.append(tuple(row[n] for n in RAW.names))
        return spark.createDataFrame(rows, RAW)

    return build
