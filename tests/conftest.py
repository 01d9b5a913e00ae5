import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[8]")
        .appName("tallyfold-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests own their checkpoint folder only when the session has none.
    from tallyfold.session import drop_scratch, ensure_checkpoint_dir

    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="tallyfold-test-ckpt-"))
    yield s
    drop_scratch(s)
    assert not [t.name for t in s.catalog.listTables() if t.name.startswith("tallyfold_")]
