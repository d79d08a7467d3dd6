import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from faceoff.session import build_session

    session = build_session(
        master="local[*]",
        shuffle_partitions=8,
        app_name="faceoff-tests",
        extra={"spark.ui.showConsoleProgress": "false"},
    )
    yield session
    session.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


@pytest.fixture
def db(spark):
    from faceoff.operators.tables import create_database

    return create_database(spark, "t")
