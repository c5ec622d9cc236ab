import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tablero.session import build_session
    shared = tmp_path_factory.mktemp("shared")
    s = build_session("local[*]", app="tablero-tests", shuffle_partitions=8, extra={
        "spark.checkpoint.dir": str(shared / "checkpoints"), "spark.sql.warehouse.dir": str(shared / "warehouse")})
    yield s
    s.stop()
