import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(scope="session")
def documents(spark):
    """Documents of (doc_id, text), with extra columns whose names operators use too."""

    def make(rows):
        full = [(i, t, "en", "s", len(t or ""), -1.0, "x") for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string"
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.01"
