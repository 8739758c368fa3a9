import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quotebars.session import build_session
    ckpt = tempfile.mkdtemp(prefix="quotebars-test-")
    session = build_session("local[4]", app_name="quotebars-tests", shuffle_partitions=4,
                            extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": f"{ckpt}/warehouse",
                                   "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from quotebars.session import scratch_dir
    return lambda purpose="t": scratch_dir(spark, purpose)
