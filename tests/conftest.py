import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tessera.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("tests", cores="4", shuffle_partitions=4)
    yield s
    s.stop()


def _key(t):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)


def rows(df, *cols):
    """Collected rows as sorted tuples (None sorts last, mixed types allowed)."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=_key)
