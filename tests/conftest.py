import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallywell.schemas import EVENT_SCHEMA  # noqa: E402
from tallywell.sinks import Layers, create_layers  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "checkpoints"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def layers(spark, tmp_path):
    return create_layers(spark, Layers(prefix=f"t{uuid.uuid4().hex[:8]}_"), location=str(tmp_path / "lake"))


@pytest.fixture
def events(spark):
    def make(*rows):
        """Rows of ingest_id, order_id, customer_id, order_status, timestamp, amount."""
        return spark.createDataFrame(list(rows), EVENT_SCHEMA)

    return make
