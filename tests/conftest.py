from __future__ import annotations

import pytest

from quaestor import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[*]", **{"spark.sql.shuffle.partitions": "8",
                                                    "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    return session
