import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from weftline.session import local_session

    shared = tmp_path_factory.mktemp("shared")
    s = local_session(
        "weftline-tests", 8, **{"spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("wh"))}
    )
    yield s
    s.stop()
