import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from segmentflow.config import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    wh = tempfile.mkdtemp(prefix="sf-test-wh-")
    s = get_session(
        master="local[2]",
        shuffle_partitions=2,
        app_name="segmentflow-tests",
        extra={"spark.sql.warehouse.dir": wh},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Sorted plain tuples of the given columns (all when none given)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple(str(x) for x in t))
