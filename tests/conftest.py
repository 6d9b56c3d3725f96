import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from contestlab.session import tuned  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        tuned(SparkSession.builder.master("local[4]"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.maxMetadataStringLength", "1000")  # late in a run, long column numbers would cut filters short in plans
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as plain tuples, sorted by the named columns or by all."""
    out = [tuple(r) for r in df.collect()]
    if order:
        at = [df.columns.index(c) for c in order]
        return sorted(out, key=lambda r: [r[i] for i in at])
    return sorted(out, key=repr)
