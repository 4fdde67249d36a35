import pytest
from pyspark.sql import SparkSession

from tarifa.session import build_session


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = build_session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
