import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from kerbline.session import local_session
    return local_session(8, memory="8g", checkpoint_dir=tmp_path_factory.mktemp("stage").as_uri())


@pytest.fixture(scope="session")
def city(spark):
    import queries
    from queries.registry import City
    queries.all_queries()
    return City.of(spark, SF)
