import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from exposura.session import build_session  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def tidy(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (list, tuple)):
        return tuple(tidy(v) for v in value)
    return value


def in_name_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(tidy(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="session")
def results(spark):
    """Result, columns and plan of every query, each run once."""
    from exposura import catalog

    cache = {}

    def run(name):
        if name not in cache:
            df = catalog.queries()[name](spark, FOLDER)
            rows = [tuple(r) for r in df.collect()]
            plan = df._jdf.queryExecution().executedPlan().toString()
            cache[name] = (df.columns, rows, plan, dict(df.dtypes))
        return cache[name]

    return run


@pytest.fixture
def one(spark):
    """Evaluates column functions of one text value: one(fn, "text")."""
    from pyspark.sql import functions as F

    def run(fn, *values):
        schema = ", ".join(f"c{i} string" for i in range(len(values)))
        df = spark.createDataFrame([values], schema)
        return df.select(fn(*[F.col(f"c{i}") for i in range(len(values))]).alias("r")).first()[0]

    return run
