import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cofi.session import build_session, drop_tables  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8, app_name="cofi-tests")
    yield s
    drop_tables(s)
    s.stop()


# Micro fixture (FIXTURES.md section 3): user 4 has norm 0, user 6 and item 16 are unseen.
MICRO_TRAIN = [(1, 10, 5.0), (1, 11, 3.0), (1, 12, 1.0), (1, 13, 4.0), (2, 10, 4.0), (2, 11, 3.0),
               (2, 12, 2.0), (3, 10, 1.0), (3, 11, 4.0), (3, 12, 5.0), (3, 14, 2.0), (4, 13, 3.0),
               (4, 14, 3.0), (5, 14, 5.0), (5, 15, 1.0)]
MICRO_TEST = [(1, 14, 3.0), (2, 13, 4.0), (3, 13, 2.0), (4, 10, 4.0), (5, 10, 2.0), (6, 10, 4.0),
              (1, 16, 3.0), (6, 16, 2.0)]
SCHEMA = "user_id BIGINT, item_id BIGINT, rating DOUBLE"


@pytest.fixture(scope="session")
def micro(spark):
    train = spark.createDataFrame(MICRO_TRAIN, SCHEMA)
    test = spark.createDataFrame(MICRO_TEST, SCHEMA)
    return train, test
