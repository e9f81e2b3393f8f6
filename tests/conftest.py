from __future__ import annotations

import gzip
import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventlake.session import local_session  # noqa: E402

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8")
    yield session
    session.stop()


@pytest.fixture
def write_hour(tmp_path):
    """Write literal lines as an hour file below ``tmp_path/landing``."""

    def write(name: str, lines: list[str]) -> str:
        folder = tmp_path / "landing"
        folder.mkdir(exist_ok=True)
        path = folder / name
        with gzip.open(path, "wt", encoding="utf-8") as handle:
            handle.write("".join(line + "\n" for line in lines))
        return str(folder)

    return write


def event(event_id, login="ann", actor_id=1, repo_id=7, name="org/repo", kind="PushEvent",
          at="2024-01-01T00:10:00Z", extra=""):
    """One event document as text; ``extra`` is appended inside the object."""
    return (
        f'{{"id":"{event_id}","type":"{kind}","actor":{{"id":{actor_id},"login":"{login}"}},'
        f'"repo":{{"id":{repo_id},"name":"{name}"}},"created_at":"{at}"{extra}}}'
    )


def at(day: int, hour: int = 0, minute: int = 0) -> datetime:
    return datetime(2024, 1, day, hour, minute)
