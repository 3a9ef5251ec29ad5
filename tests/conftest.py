import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from folioforge.session import get_session, ship

    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    session = get_session(
        "folioforge-tests",
        spark__master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="3g",
    )
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()
