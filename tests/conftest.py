import os
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

# Python workers import the package and the scorers of the tests from here.
_HERE = Path(__file__).resolve().parent
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(_HERE.parent), str(_HERE), os.environ.get("PYTHONPATH", "")]
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("presswork-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Not UTC on purpose: results must not depend on it.
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
