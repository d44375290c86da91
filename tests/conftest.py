import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from parcelflow.session import local_session
    warehouse = tempfile.mkdtemp(prefix="parcelflow-warehouse-")
    s = local_session("*", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": tempfile.mkdtemp(prefix="parcelflow-checkpoint-")})
    yield s
    s.stop()
