import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


REVIEWS = [
    "camera pulita personale gentile colazione ottima",
    "ottima posizione camera grande e pulita",
    "personale gentile e colazione abbondante ottima",
    "vista splendida camera pulita consigliato",
    "gentile accoglienza ottima cena ottima vista",
    "pulita comoda centrale ottima",
    "camera sporca personale scortese",
    "rumore tutta la notte camera sporca",
    "colazione pessima personale scortese sporca",
    "pessima esperienza rumore sporca",
]
CLASSES = ["pos"] * 6 + ["neg"] * 4


@pytest.fixture(scope="session")
def reviews(spark):
    """Labelled reviews, three copies of each, with labels in mixed order."""
    rows = [(i * 10 + j, text, label) for i in range(3) for j, (text, label) in enumerate(zip(REVIEWS, CLASSES))]
    return spark.createDataFrame(rows, "doc_id long, text string, class string")
