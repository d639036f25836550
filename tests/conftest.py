import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from idloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    import tempfile
    wh = tempfile.mkdtemp(prefix="idloom-warehouse-")
    s = build_session("local[*]", app="idloom-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def no_temp_views_left(request):
    """Temporary views of one test are not listed in the next."""
    yield
    if "spark" in request.fixturenames:
        catalog = request.getfixturevalue("spark").catalog
        for t in catalog.listTables():
            if t.isTemporary:
                catalog.dropTempView(t.name)
