import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import pytest  # noqa: E402

from runlens.llm import shared  # noqa: E402


@pytest.fixture(scope="module", autouse=True)
def released(spark):
    yield
    shared.release(spark)
