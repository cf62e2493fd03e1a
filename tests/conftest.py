import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    sys.path.insert(0, str(folder))


from runlens.plans import staging  # noqa: E402


@pytest.fixture(scope="session")
def event_log_dir():
    return tempfile.mkdtemp(prefix="runlens-events-")


@pytest.fixture(scope="session")
def spark(event_log_dir):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("runlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", f"file:{event_log_dir}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    written = [Path(p.removeprefix("file:")) for p in staging._written]
    staging.release(session)
    session.stop()
    assert not any(p.exists() for p in written), "staged tables were left behind"
