import sys
import tempfile
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from matrixq.session import local_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def event_log_dir():
    return tempfile.mkdtemp(prefix="matrixq-test-events-")


@pytest.fixture(scope="session")
def shared_dir(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(event_log_dir, shared_dir):
    session = local_session(
        4, spark__sql__shuffle__partitions="4", spark__eventLog__enabled="true",
        spark__eventLog__dir=f"file://{event_log_dir}", spark__eventLog__compress="false",
        spark__driver__memory="4g", spark__checkpoint__dir=f"file://{shared_dir}",
        spark__sql__warehouse__dir=f"{shared_dir}/warehouse",
    )
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def cells(m) -> dict:
    """The cells as a dict; fails on duplicates."""
    rows = m.cells.collect()
    found = {(r["i"], r["j"]): r["v"] for r in rows}
    assert len(found) == len(rows), "duplicate cells"
    return found


def dense(m) -> np.ndarray:
    out = np.zeros((m.n_rows, m.n_cols))
    for (i, j), v in cells(m).items():
        out[i, j] = v
    return out
