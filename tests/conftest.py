import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quire.session import local_session

    s = local_session("*", shuffle_partitions=8, app="quire-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect the given columns as tuples (all columns when none are named)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
