import pytest

from almanac.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(root),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.log.level": "ERROR",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    yield session
    session.stop()
