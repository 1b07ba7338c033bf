import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lexweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session("tests", 4, str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def base(spark):
    """A fresh folder in the session's shared storage."""
    from lexweave.session import fresh_path

    return fresh_path(spark, "test")


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")

    return make
