import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from acrewise.scale import release
    from acrewise.session import build_session

    session = build_session("local[8]", 4, "tests")
    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def listings(spark, sf):
    from acrewise.fixtures import view

    return view(spark, sf, "listings").cache()


@pytest.fixture(scope="session")
def duck(sf):
    from check_oracle import connect

    con = connect(sf)
    yield con
    con.close()
