import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shelfmark-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def records(spark):
    rows = [
        ("123B", "Product 1", "This is a great product.", "Fast", "BrandA", "Electronics"),
        ("123C", "Product 2", None, "Cheap", "BrandB", "Home"),
        ("123D", "Product 3", "Works well", None, "BrandC", "Outdoors"),
    ]
    names = "asin string, title string, description string, feature string, brand string, main_cat string"
    return spark.createDataFrame(rows, names)
