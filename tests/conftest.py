import datetime as dt
import random
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from invoicelake.schema import BRONZE  # noqa: E402
from invoicelake.session import local_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="invoicelake-tests-")
    session = local_session(
        "tests", cores="4", spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=f"{folder}/warehouse")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True, scope="module")
def no_views_left(spark):
    """Named views of one module's tests are not there in the next one's."""
    yield
    for table in spark.catalog.listTables():
        if table.isTemporary:
            spark.catalog.dropTempView(table.name)


# One row per class of line: (invoice, code, text, quantity, date, price, customer, country)
LINES = [
    ("500", "71001", "KETTLE", "4", "2015-02-03 09:10:00", "5.0", "a", "Norway"),
    ("500", "71001", " KETTLE", "4", "2015-02-03 09:10:00", "5.00", "a", "Norway "),   # the same once typed
    ("501", "71002b", "TEAPOT", "6", "2015-05-20 11:00:00", "2.5", "a", "Norway"),    # suffix is a product
    ("502", "71002", "TEAPOT", "2", "2013-12-24 12:00:00", "2.5", "b", "Spain"),      # long ago
    ("C503", "71002", "TEAPOT", "-3", "2015-05-21 08:00:00", "2.5", "a", "Norway"),   # cancellation
    ("504", "POST", "POSTAGE", "1", "2015-05-20 11:00:00", "9.0", "a", "Norway"),
    ("A505", "71001", "correction", "1", "2015-05-20 11:00:00", "50", None, "Norway"),
    ("506", "71001", "KETTLE", "1", "2015-05-20 11:00:00", "0", None, "Norway"),
    ("507", "71001", "broken", "-7", "2015-05-20 11:00:00", "5.0", None, "Norway"),
    ("508", "71001", "KETTLE", "many", "2015-05-20 11:00:00", "5.0", None, "Norway"),
    ("C509", "71001", "KETTLE", "-1", "2015-05-22 11:00:00", "5.0", "c", "Norway"),   # only ever cancelled
    ("510", "71001", "KETTLE", "1", "2015-07-01 11:00:00", "5.0", "a", "Norway"),     # after the snapshot
]
SNAPSHOT = dt.date(2015, 6, 20)


@pytest.fixture(scope="session")
def bronze(spark):
    return spark.createDataFrame(LINES, BRONZE)


@pytest.fixture(scope="session")
def labelled(spark, bronze):
    from invoicelake.operators.silver import label_rows
    return label_rows(bronze).cache()


@pytest.fixture(scope="session")
def silver(labelled):
    from invoicelake.operators.silver import to_silver
    return to_silver(labelled).cache()


@pytest.fixture()
def rng():
    return random.Random(7)
