import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerly.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="ledgerly-test-ckpt-")
    wh = tempfile.mkdtemp(prefix="ledgerly-test-wh-")
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture(scope="session")
def layers(spark, sf_small):
    from ledgerly.plans.layers import fixture_layers
    return fixture_layers(spark, sf_small)
