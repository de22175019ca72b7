import pytest

from panelweave.llm.shared import DOCUMENT

SF = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """documents(text, ...) or documents((doc_id, text, source), ...) -> the table"""

    def build(*rows):
        full = []
        for k, r in enumerate(rows):
            i, text, source = r if isinstance(r, tuple) else (k, r, "a")
            full.append((i, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCUMENT)

    return build


@pytest.fixture
def given(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
