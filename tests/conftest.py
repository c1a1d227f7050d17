from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tidemark-tests", memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder() -> str:
    return "/root/testdata/sf0.001"


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="session")
def same():
    def check(a, b) -> None:
        """Equal as bags of rows."""
        assert sorted(a.columns) == sorted(b.columns)
        b = b.select(*a.columns)
        assert a.exceptAll(b).count() == 0
        assert b.exceptAll(a).count() == 0

    return check
