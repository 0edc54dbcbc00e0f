import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from martpulse.session import get_spark

    s = get_spark("local[*]", 8)
    # tests own their shared folder (a cluster names it in spark.checkpoint.dir)
    if not s.conf.get("spark.checkpoint.dir", None):
        root = tempfile.mkdtemp(prefix="martpulse-test-")
        s.conf.set("spark.checkpoint.dir", root)
        s.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    yield s


@pytest.fixture()
def scratch(spark):
    from martpulse.session import checkpoint_root

    return tempfile.mkdtemp(prefix="case-", dir=checkpoint_root(spark))
