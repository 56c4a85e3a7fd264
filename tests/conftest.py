import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from flowguard.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "flowguard-tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
        spark__sql__streaming__stateStore__providerClass=(
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
