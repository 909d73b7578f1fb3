import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from churnkit.session import get_spark

    s = get_spark("local[4]", 8)
    yield s


@pytest.fixture(scope="session")
def raw(spark):
    from churnkit.sources.fixture import subscriber_raw

    return subscriber_raw(spark, SF_SMALL).cache()


@pytest.fixture(scope="session")
def fm(raw):
    from churnkit.operators.features import FeatureModel

    return FeatureModel.fit(raw)
