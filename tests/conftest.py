import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]


@pytest.fixture(scope="session")
def spark():
    from bindery.runtime import session

    spark = session("4", 4)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
