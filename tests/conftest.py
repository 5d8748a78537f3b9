import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tariff_engine.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", shuffle_partitions=8, app="tariff_engine_tests")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Changes settings of the session until the end of a test."""
    before = {}

    def use(values):
        for key, value in values.items():
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield use
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
