import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from vitrine.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("8", "vitrine-tests", "6g")


@pytest.fixture(scope="session")
def small():
    return SMALL
