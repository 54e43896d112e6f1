import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from tidegrid.session import get_spark

    s = get_spark(
        "tests", "local[8]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false", spark_driver_memory="6g",
    )
    s.sparkContext.setLogLevel("ERROR")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    s.stop()
