from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keelson.session import local_session  # noqa: E402

TESTDATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", shuffle_partitions=8, app_name="keelson-tests")
    yield session
    session.stop()


def duckdb_on(sf_dir: str):
    """A DuckDB connection with the driver's tables as views, as the driver sets it up."""
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
