import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from wordloom.session import local_session  # noqa: E402
from tables import GOLDEN_LINES  # noqa: E402
from wordloom.sources.lines import LINES_SCHEMA  # noqa: E402

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(4)


@pytest.fixture
def frame(spark):
    def make(rows, schema=LINES_SCHEMA):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def golden(frame):
    return frame(GOLDEN_LINES)
