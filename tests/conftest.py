from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from mailsieve.session import build_session

    s = build_session("tests", 8, "8g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from oracle_check import connect

    return connect(SF)


@pytest.fixture(scope="session")
def views(spark):
    from mailsieve.fixtures import Views

    return Views(spark, SF)
