import pytest

from millrace.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, "4g", 4)
    s.sparkContext.setLogLevel("OFF")
    s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # several batches even in small tests
    yield s
    s.stop()
