import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TESTS = os.path.join(ROOT, "tests")
sys.path.insert(0, ROOT)
# Python workers unpickle test-defined model classes by module name.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, TESTS] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from mediatables.session import configure
    ckpt = tempfile.mkdtemp(prefix="mt-test-ckpt-")
    session = (SparkSession.builder.master("local[4]")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", ckpt)
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session
    session.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
