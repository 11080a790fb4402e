import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from cohortwise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "8", 4)


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as dictionaries, sorted by the given columns."""
    def read(df, *order):
        out = [r.asDict(recursive=True) for r in df.collect()]
        return sorted(out, key=lambda r: tuple(str(r[c]) for c in order)) if order else out

    return read
