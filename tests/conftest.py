import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from lakeops.session import get_spark
    s = get_spark("local[4]", app_name="lakeops-tests", shuffle_partitions=4,
                  extra_conf={"spark.driver.memory": "4g"})
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
