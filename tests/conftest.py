import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from orderlens.session import get_spark
    s = get_spark("local[*]", app="orderlens-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.ansi.enabled": "true",
    })
    yield s
    s.stop()
