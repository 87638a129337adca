import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerfold.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("8", "8g", "tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def skewed(spark):
    """3000 rows: a third of them belong to id 7."""
    import random

    rng = random.Random(5)
    rows = []
    for i in range(3000):
        ident = 7 if i % 3 == 0 else rng.randrange(100, 500)
        rows.append((ident, i * 13 % 30011, rng.choice([None, 0, 1, 2]), rng.randrange(4), rng.random() < 0.4))
    return spark.createDataFrame(rows, "id bigint, rn int, a int, b int, flag boolean").repartition(6).cache()


def rows_of(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
