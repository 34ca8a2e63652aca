import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kitwise.plans.session import ensure_checkpoint_dir, local_session

    s = local_session(4, shuffle_partitions=4)
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def empty_inputs(spark):
    """Stand-in inputs with zero rows: the schemas for hand-made tables."""
    from kitwise.sources import standins
    from kitwise.sources.tables import INPUT_NAMES

    st = standins.load(spark, SF0001)
    return {n: getattr(st, n).limit(0) for n in INPUT_NAMES}
