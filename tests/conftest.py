import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for p in (str(ROOT), str(ROOT / "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gaugework.session import local_session

    base = tmp_path_factory.mktemp("spark")
    return local_session(
        8, "gaugework-tests", "4g", spark__sql__warehouse__dir=str(base / "warehouse"), spark__checkpoint__dir=str(base / "shared")
    )


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark, small):
    from gaugework.sources.tables import Tables

    return Tables(spark, small)
