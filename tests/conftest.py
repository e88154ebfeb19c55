from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession

from tidelog.session import configure
from tidelog.sources.event_table import EventTable


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tidelog-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def lines_of(spark):
    return lambda texts: spark.createDataFrame([(text,) for text in texts], "value STRING")


@pytest.fixture
def event_table_of(spark, lines_of, tmp_path):
    def store(texts):
        table = EventTable(spark, str(tmp_path / f"events-{len(list(tmp_path.iterdir()))}"))
        table.write(lines_of(texts))
        return table

    return store
