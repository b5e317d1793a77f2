import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harborline.llm.common import prepare  # noqa: E402
from tests_llm_rows import ODD_ROWS, ODD_SCHEMA, SMALL  # noqa: E402

@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def odd(llm):
    return llm.createDataFrame(ODD_ROWS, ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(llm):
    return llm.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def texts(llm):
    rows = llm.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {row.doc_id: row.text or "" for row in rows}
