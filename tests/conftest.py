import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from threadscope.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r) for r in df.select(*cols).collect()]
