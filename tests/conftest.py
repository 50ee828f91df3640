import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck01():
    from oracle_check import duck_connect
    from paths import SF01
    return duck_connect(SF01)
