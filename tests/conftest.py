import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lodestar.session import build_session

    from lodestar.session import use_checkpoint_dir

    session = build_session("local[4]", app_name="lodestar-tests", shuffle_partitions=8)
    use_checkpoint_dir(session, lambda: str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck_small():
    from lodestar.plans.check import duckdb_conn

    return duckdb_conn(SMALL)
