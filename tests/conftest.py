import pytest
from pyspark.sql import SparkSession

from tidewater.session import configure


def make_session() -> SparkSession:
    builder = configure(SparkSession.builder.master("local[8]").appName("tidewater-tests"))
    spark = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
