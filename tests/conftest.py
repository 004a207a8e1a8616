import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rowgraft.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, 2, "4g")
    session.sparkContext.setLogLevel("ERROR")
    # Hundreds of tiny plans: compiling each costs more than running it (check.py runs them compiled).
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
