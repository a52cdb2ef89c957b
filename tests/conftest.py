import json
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tarmac.config import prepare  # noqa: E402
from tarmac.schemas import RAW_SCHEMA  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return prepare(session)


@pytest.fixture
def raw(spark):
    """Raw deliveries from documents: a dict, a JSON text, or (document, extracted hour, day)."""

    def build(*documents):
        rows = []
        for entry in documents:
            document, hour, day = entry if isinstance(entry, tuple) else (entry, 0, 11)
            text = document if isinstance(document, str) else json.dumps(document)
            at = None if hour is None else datetime(2024, 1, day, hour)
            rows.append((text, at, at, at, None, None, None))
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return build


def movement(**fields):
    """A valid departure, with some fields changed; None removes a field."""
    document = {
        "id": "F1",
        "nro": "AR100",
        "idaerolinea": "AR",
        "aerolinea": "Andes Regional",
        "arpt": "AEP",
        "mov": "D",
        "IATAdestorig": "COR",
        "x_date": "2024-01-10",
        "x_fetched_at": "2024-01-11T00:00:00Z",
        "stda": "10:00",
        "estin": "Programado",
    }
    document.update(fields)
    return {key: value for key, value in document.items() if value is not None}
