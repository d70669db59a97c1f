import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpuslens.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4, "8g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def small():
    return SMALL


CORPUS = [
    ("the harbour board met on tuesday and signed the dredging contract", 1),
    ("measured rainfall at the station was the lowest since records began", 1),
    ("the ministry printed the census tables with a signed annex", 1),
    ("engineers measured the bridge and printed their signed report", 1),
    ("the board printed rainfall tables for the harbour station", 1),
    ("wizards melted the moon and nobody dares tell you", 0),
    ("nobody dares tell you which wizards melted your savings", 0),
    ("secret moon wizards dares you to share before it is melted", 0),
]


@pytest.fixture(scope="session")
def corpus(spark):
    rows = [(i, f"title {i}", text, label) for i, (text, label) in enumerate(CORPUS)]
    return spark.createDataFrame(rows, "row_id bigint, title string, text string, label int")
