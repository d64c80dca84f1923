import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ebbline.session import prepare  # noqa: E402

BASE = 1_690_000_000


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ebbline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield prepare(session)
    session.stop()


@pytest.fixture
def write_lines(tmp_path):
    """Write text files that a stream reads in the given order, one per micro-batch."""

    def write(*batches, name="in"):
        folder = tmp_path / name
        folder.mkdir(exist_ok=True)
        start = len(list(folder.iterdir()))
        for i, lines in enumerate(batches, start):
            path = folder / f"{i:04d}.txt"
            path.write_text("\n".join(lines) + "\n")
            os.utime(path, (BASE + i, BASE + i))
        return str(folder)

    return write
