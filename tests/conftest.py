import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitalgrid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    out = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x) for x in r))
