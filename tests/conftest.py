import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagecat.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a DataFrame as sorted tuples."""

    def read(df, *cols):
        out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x) for x in r))

    return read
