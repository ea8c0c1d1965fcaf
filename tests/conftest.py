import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def against_sql(spark, sf_dir, query, sql):
    """Rows of a query and of its SQL, both sorted."""
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{sf_dir}/{f}'")
    df = query(spark, sf_dir)
    ours = sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())
    rel = con.sql(sql)
    cols = rel.columns
    assert sorted(cols) == sorted(df.columns)
    return ours, sorted(repr(tuple(r[cols.index(c)] for c in sorted(cols))) for r in rel.fetchall())
