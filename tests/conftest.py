import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tessera.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return get_spark("local[4]", 4, app_name="tessera-tests")


def plan_text(df) -> str:
    """The executed physical plan (AQE final plan) as text."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
