import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from framewright.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "local[8]", "framewright-tests", spark__sql__shuffle__partitions="4", spark__driver__memory="8g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def t(spark):
    from framewright.registry import Tables

    return Tables(spark, SF)
