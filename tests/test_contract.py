"""The driver contract, and every query with SQL against DuckDB at the
smallest size."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from check_oracle import connect, difference
from millrace.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["lang", "word", "n", "rank"] and df.count() > 0


def test_names():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(catalog.entries()) <= set(entry_point.queries())


def test_works_without_the_optional_parts():
    code = "import sys; sys.modules['millrace.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(entry_point.__file__).parent, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(catalog.entries())), "False"]


@pytest.mark.parametrize("name", sorted(name for name, (_, sql) in catalog.entries().items() if sql))
def test_query_equals_sql(spark, duck, name):
    got = entry_point.queries()[name](spark, FOLDER).toPandas()
    want = duck.execute(entry_point.oracle_sql()[name]).fetchdf()
    assert difference(got, want) is None


@pytest.mark.parametrize("name", ["sample_bernoulli", "sample_with_replacement", "random_split", "lr_metrics"])
def test_query_without_sql_runs(spark, name):
    assert entry_point.queries()[name](spark, FOLDER).count() > 0
