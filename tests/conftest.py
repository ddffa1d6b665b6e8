import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# Mini fixture (FIXTURES.md section 2): six items, eleven community ratings, two personal ratings.
ITEMS_CSV = """1,Paper Kite (1995),Adventure|Animation|Comedy
2,"Harbour Papers, The (2012)",Crime|Documentary
3,Ember (1995),Crime|Drama
4,Quiet Mill (2000),Drama
5,NoGenre (2001)
6,"Salt, the Wind, and Stone, The (1966)",Adventure|Crime
"""

RATINGS_CSV = """1,1,4.0,1000000000
1,2,3.0,1000000001
1,3,5.0,1000000006
2,1,2.0,1000000009
2,3,4.5,1000000002
2,6,3.5,1000000007
3,1,5.0,1000000003
3,5,1.0,1000000008
3,6,2.0,1000000004
10,3,3.0,1000000005
10,6,4.0,1000000009
"""

PERSONAL_CSV = """0,1,5,1000000000
0,3,2,1000000000
"""


@pytest.fixture
def no_broadcast(spark):
    """A context in which Spark broadcasts nothing by size."""
    import contextlib

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")

    @contextlib.contextmanager
    def off():
        saved = {k: spark.conf.get(k, None) for k in keys}
        for k in keys:
            spark.conf.set(k, "-1")
        try:
            yield
        finally:
            for k, v in saved.items():
                spark.conf.set(k, v) if v is not None else spark.conf.unset(k)

    return off


@pytest.fixture(scope="session")
def spark():
    from prefkit.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="prefkit-tests")
    yield s


@pytest.fixture(scope="session")
def fixture_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("fixture")
    (d / "items.csv").write_text(ITEMS_CSV)
    (d / "ratings.csv").write_text(RATINGS_CSV)
    (d / "personal.csv").write_text(PERSONAL_CSV)
    return d


@pytest.fixture(scope="session")
def ratings(spark, fixture_dir):
    from prefkit.sources import read_ratings

    return read_ratings(spark, str(fixture_dir / "ratings.csv"))


@pytest.fixture(scope="session")
def items(spark, fixture_dir):
    from prefkit.sources import read_items

    return read_items(spark, str(fixture_dir / "items.csv"))


@pytest.fixture(scope="session")
def personal(spark, fixture_dir):
    from prefkit.sources import read_personal_ratings

    return read_personal_ratings(spark, str(fixture_dir / "personal.csv"))
