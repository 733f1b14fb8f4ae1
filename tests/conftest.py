import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from postlens.session import build_session, checkpoint_root

    s = build_session(master="local[4]", app="postlens-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    checkpoint_root(s)   # the configured spark.checkpoint.dir, or a temporary one if unset
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from postlens.session import work_dir
    return lambda purpose="t": work_dir(spark, purpose)


def rows(df, *cols):
    """Sorted list of tuples for an order-insensitive comparison."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
