import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from larderspark.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", shuffle_partitions="4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF).exists():
        pytest.skip("test tables are not here")
    return SF


def rows(df, *columns):
    """Collected rows as tuples, in no particular order."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


@pytest.fixture(scope="session")
def collect():
    return rows
