import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marquee.session import local_session
    s = local_session(4, shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def ratings5(spark):
    """The five-row rating sample used across the reference's tests."""
    rows = [(1, 1, 10, 4.0, 1000), (2, 1, 20, 3.5, 2000), (3, 2, 10, 5.0, 1500), (4, 2, 30, 2.0, 2500),
            (5, 3, 20, 4.5, 3000)]
    return spark.createDataFrame(rows, "id long, user_id int, movie_id int, rating double, timestamp long")


@pytest.fixture()
def movies3(spark):
    rows = [(10, "Movie A (2010)", "Action"), (20, "Movie B (2015)", "Drama"), (30, "Movie C (2020)", "Comedy|Drama")]
    return spark.createDataFrame(rows, "movie_id int, title string, genres string")
