from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakejobs.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tables saved by tests go to a folder of this run.
    warehouse = tempfile.mkdtemp(prefix="warehouse-")
    return local_session(8, "tests", **{"spark.sql.warehouse.dir": warehouse})


def rows(df, *order):
    """Rows as plain tuples in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
