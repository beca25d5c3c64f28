import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("cordon-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    from cordon.session import ensure_work_dir

    ensure_work_dir(s)  # a folder of this machine only where the session names none (as on a laptop)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="cordon-test-")
