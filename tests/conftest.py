import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wavelens.session import local_session

    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        "tests", "8", **{"spark.checkpoint.dir": str(shared), "spark.sql.warehouse.dir": str(shared / "warehouse")}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
