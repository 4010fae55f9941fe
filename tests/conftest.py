import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from seriesguard.session import get_spark

    s = get_spark("local[4]", 4, extra={"spark.sql.streaming.stateStore.providerClass":
                                          "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"})
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
