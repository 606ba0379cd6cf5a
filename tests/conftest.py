import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starfit.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(shuffle_partitions=4)


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not here")
    return SMALL


@pytest.fixture(scope="session")
def mini_train(spark):
    rows = [
        (1, 10, 5.0, "Drama"),
        (1, 20, 3.0, "Comedy|Drama"),
        (2, 10, 4.0, "Drama"),
        (2, 30, 2.0, None),
        (3, 20, 1.5, "Comedy|Drama"),
        (3, 10, 4.5, "Drama"),
    ]
    return spark.createDataFrame(rows, "userId int, movieId int, rating double, genres string")


@pytest.fixture(scope="session")
def mini_validation(spark):
    rows = [
        (1, 30, 2.5, None),  # missing genres match the missing group
        (2, 20, 3.5, "Comedy|Drama"),
        (3, 40, 3.0, "Western"),  # unseen movie and genres
        (9, 10, 4.0, "Drama"),  # unseen user
    ]
    return spark.createDataFrame(rows, "userId int, movieId int, rating double, genres string")


@pytest.fixture()
def no_auto_broadcast(spark):
    """Only hinted tables are broadcast, so joins called large are shuffled for real."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    adaptive = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    spark.conf.set(adaptive, "-1")
    yield
    spark.conf.set(key, before)
    spark.conf.unset(adaptive)
