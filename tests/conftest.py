import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tsengine.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="tsengine-tests-")
    session = build_session(
        "local[8]",
        spark_sql_shuffle_partitions="8",
        spark_driver_memory="6g",
        spark_ui_enabled="false",
        spark_checkpoint_dir=shared,
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
