import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from check_oracles import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture
def rows():
    """Rows as sorted tuples of the named columns, dates as text."""

    def take(df, *columns):
        return sorted(tuple(str(r[c]) if r[c] is not None else None for c in columns) for r in df.collect())

    return take
