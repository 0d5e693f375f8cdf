import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallyspan.session import local_session

    s = local_session("8")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def scratch_is_cleared(spark):
    from tallyspan.session import clear_scratch

    yield
    clear_scratch(spark)


@pytest.fixture(scope="session")
def t(spark):
    from tallyspan.plans.registry import Tables

    return Tables(spark, SF_DIR)


@pytest.fixture(scope="session")
def sql():
    import oracle

    return oracle.connect(SF_DIR)


@pytest.fixture
def values(spark):
    """Evaluate columns over one row or over given rows."""

    def run(columns, rows=None, schema=None):
        df = spark.createDataFrame(rows, schema) if rows is not None else spark.range(1)
        out = df.select(*columns).collect()
        return [tuple(r) for r in out]

    return run


@pytest.fixture(params=["merged slices", "many slices"])
def slices(spark, request):
    """Small data ends in one slice, as adaptive execution merges the others: run with both."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, str(request.param == "merged slices").lower())
    yield request.param
    spark.conf.set(key, "true")
