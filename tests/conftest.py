import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(ROOT), os.environ.get("PYTHONPATH", "")]))


@pytest.fixture(scope="session")
def spark():
    from gaugework.session import session

    spark = session(int(os.environ.get("TEST_CPUS", "4")), 4)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
