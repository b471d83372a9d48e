import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cadastro.session import local_session

    s = local_session("*", shuffle_partitions=8, app="cadastro-tests")
    yield s


@pytest.fixture()
def tmp_dir(spark, tmp_path):
    """A fresh folder for files a test writes (tests run on one machine, so a local path is shared)."""
    return str(tmp_path)


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
