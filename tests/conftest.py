import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pressline.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield configure(s)
    s.stop()


@pytest.fixture
def one(spark):
    """Evaluate columns on one row of named values."""

    def run(columns, **values):
        names = list(values)
        schema = ", ".join(f"{n} string" for n in names)
        row = spark.createDataFrame([tuple(values[n] for n in names)], schema).select(*columns).first()
        return row[0] if len(columns) == 1 else tuple(row)

    return run


@pytest.fixture
def page(spark):
    """Parse HTML texts into DOM rows; ids count from 0."""
    from pressline.sources.dom import parse_pages

    def run(*htmls, url="https://news.example/a/", **options):
        rows = [(i, url, h) for i, h in enumerate(htmls)]
        return parse_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), **options)

    return run
