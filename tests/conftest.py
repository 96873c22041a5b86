import pytest

from recordloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "recordloom-tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
