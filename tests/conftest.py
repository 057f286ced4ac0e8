import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusledger.runtime import drop_scratch, local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CPUS", "8"), "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return DATA


@pytest.fixture(scope="session")
def docs(spark, sf):
    from corpusledger.sources.dumps import documents

    return documents(spark, f"{sf}/documents.parquet", "lang")
