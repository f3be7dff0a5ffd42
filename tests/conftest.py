import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from revlens.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="revlens-tests")
    yield s


@pytest.fixture(scope="session")
def star(spark):
    from revlens.sources.star import Star
    return Star.from_source(spark, SF_SMALL)


class Tables:
    """Minimal star-like holder for hand-made frames."""

    def __init__(self, **frames):
        self.__dict__.update(frames)
