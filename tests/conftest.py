import datetime
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from smeltworks.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def day():
    return datetime.date.fromisoformat


@pytest.fixture
def rows():
    def sort(df, *columns):
        picked = df.select(*columns) if columns else df.select(*sorted(df.columns))
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))

    return sort
