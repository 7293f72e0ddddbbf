import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from morrowcart.session import build_session

    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session("local[*]", 8, extra={"spark.checkpoint.dir": ckpt,
                                            "spark.driver.memory": "4g"})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


def day(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


@pytest.fixture(scope="session")
def mk_log(spark):
    """Build a clean log from (user, item, category, behaviour, 'YYYY-MM-DD', hour) tuples."""
    from morrowcart.sources.schemas import CLEAN_SCHEMA

    def make(rows):
        data = [(i, u, it, c, b, h, day(d)) for i, (u, it, c, b, d, h) in enumerate(rows)]
        return spark.createDataFrame(data, CLEAN_SCHEMA)
    return make
