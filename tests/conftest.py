import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from panelweave.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=tempfile.mkdtemp(prefix="tests-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def frame(spark):
    """frame("a int, b string", (1, "x"), ...) -> DataFrame"""

    def build(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build


@pytest.fixture
def rows():
    def collect(df, *order):
        out = [tuple(r) for r in df.collect()]
        return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))

    return collect
