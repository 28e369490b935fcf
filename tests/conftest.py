import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from checks.compare import session
    from pricemill.session import configure

    return configure(session())


@pytest.fixture(scope="session")
def duck():
    from checks.compare import connect

    return connect(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
