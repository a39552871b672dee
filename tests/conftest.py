import pytest

from statloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.driver.memory": "3g",
        "spark.sql.shuffle.partitions": "4",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
