import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gleaner.session import session

    made = session(4, **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    made.sparkContext.setLogLevel("OFF")
    yield made
    made.stop()


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("the smallest tables are absent")
    return SMALL


def norm(rows):
    """Rows as comparable tuples, whatever their order."""
    return sorted(repr(tuple(sorted(r.items()))) for r in rows)


def oracle(sql, folder):
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{folder}/{name}'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return [dict(zip(names, row)) for row in found.fetchall()]
