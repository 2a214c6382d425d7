import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from clickmart.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[4]", app_name="clickmart-tests", shuffle_partitions=4)
    if not session.sparkContext.getCheckpointDir() and not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clickmart-test-ckpt-"))
    yield session


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally only some columns)."""
    data = df.select(*cols).collect() if cols else df.collect()
    return sorted((tuple(r) for r in data), key=lambda t: tuple((x is None, str(x)) for x in t))
