import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import local_session

    session = local_session("tests", cores=4, partitions=4)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # operators over streams of batches must not depend on their size
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def small_batches(request):
    """Operators over streams of batches must not depend on their size; tests on larger tables set their own."""
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
