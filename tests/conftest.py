import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from spark_ledger.session import get_spark
    s = get_spark("local[*]", app_name="spark_ledger_tests", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
