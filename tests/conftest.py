import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from shelfcast.session import builder

    scratch = tmp_path_factory.mktemp("spark")
    session = (
        builder("shelfcast-tests", cores=8)
        .master("local[8]")
        .config("spark.checkpoint.dir", str(scratch / "stage"))
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch}")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    root = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    if not Path(root).is_dir():
        pytest.skip(f"no test data at {root}")
    return root
