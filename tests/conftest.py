import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from millrace.session import session

    made = session("tests", "local[2]", **{"spark.sql.shuffle.partitions": "3", "spark.millrace.clean": "false", "spark.ui.enabled": "false", "spark.driver.memory": "3g", "spark.ui.showConsoleProgress": "false"})
    made.sparkContext.setLogLevel("ERROR")
    return made
