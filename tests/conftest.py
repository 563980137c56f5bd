import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from ledgerline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "ledgerline-tests", memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, nulls first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in picked.collect()),
            key=lambda t: tuple((v is not None, str(v)) for v in t),
        )

    return collect
