"""Every registered query against its SQL, on the smallest tables."""

import sys
import os

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hydrolens import catalog  # noqa: E402
from tests.check import compare, duck  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.oracle()))
def test_equals_sql(spark, con, name):
    diff = compare(spark, con, catalog.queries()[name], catalog.oracle()[name], FOLDER)
    assert diff in (None, "EMPTY"), diff


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, FOLDER).count() > 0


def test_oracle_names_are_queries():
    assert set(catalog.oracle()) <= set(catalog.queries())


def test_workers_get_the_package_anywhere(tmp_path):
    """From another working directory, without any path set, functions of the package run on the workers."""
    import subprocess

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
import __spark_entry__ as e
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
print("rows", e.queries()["prediction_statistics"](spark, {FOLDER!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"SPARK_LOCAL_IP": "127.0.0.1"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 500" in done.stdout, done.stderr[-2000:]
