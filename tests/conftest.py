import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hearth.session import local_session

    s = local_session("*", shuffle_partitions=8, app="hearth-tests")
    yield s


@pytest.fixture(scope="session")
def small_tables(spark):
    from hearth.plans.pipeline import clean_listings
    from hearth.sources.fixture import raw_listings

    cats, lst = clean_listings(raw_listings(spark, SF_SMALL))
    return cats.cache(), lst.cache()
