import pytest

from palimpsest.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session("4", shuffle=4, **{"spark.checkpoint.dir": "file://" + str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    return s
