from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from usagelens.session import get_session
    s = get_session("local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def inputs_mid(spark):
    from usagelens.plans.catalog import Inputs
    return Inputs(spark, SF_MID)
