import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from trackstats.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = session("local[4]", app="tests", shuffle_partitions=4, **{
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    made.sparkContext.setLogLevel("ERROR")
    made.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield made
    made.stop()


@pytest.fixture()
def values(spark):
    """Evaluate column expressions on literal rows: ``values(rows, names, *columns)``."""
    def run(rows, names, *columns):
        out = [tuple(r) for r in spark.createDataFrame(rows, names).select(*columns).collect()]
        return [r[0] for r in out] if len(columns) == 1 else out
    return run
