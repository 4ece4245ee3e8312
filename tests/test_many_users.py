"""Reports over more users than may be broadcast: what is run, and what comes out."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tallywind.catalog.oracles import ORACLES
from tallywind.catalog.queries import REGISTRY
from tallywind.operators.posts import BROADCAST_USERS
from tallywind.plans import collecting
from tallywind.sources import files
from tests.helpers import comparable, plan


@pytest.fixture(scope="module")
def many(spark, tables, tmp_path_factory):
    """The tables with customers repeated under shifted keys."""
    root = tmp_path_factory.mktemp("many")
    os.symlink(f"{tables}/documents.parquet", root / "documents.parquet")
    customers = spark.read.parquet(f"{tables}/customer.parquet")
    n = customers.count()
    copies = customers.crossJoin(spark.range(BROADCAST_USERS // n + 1).toDF("copy"))
    key = (F.col("c_custkey") + F.col("copy") * n).alias("c_custkey")
    grown = copies.select(key, *(c for c in customers.columns if c != "c_custkey"))
    grown.coalesce(1).write.parquet(str(root / "customer.parquet"))
    return str(root)


def _wanted(many, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{many}/documents.parquet'")
    connection.execute(f"CREATE VIEW customer AS SELECT * FROM '{many}/customer.parquet/*.parquet'")
    return comparable(connection.execute(ORACLES[name]).fetchdf())


def _spied(monkeypatch, module):
    """The plans of what the module writes from now on."""
    plans, write = [], module.write_json

    def spy(df, path):
        plans.append(plan(df))
        write(df, path)

    monkeypatch.setattr(module, "write_json", spy)
    return plans


def _read_with(text, column):
    """What the tasks that read the table with this column do before they send its rows."""
    steps = re.findall(r"^\(\d+\) (\w+).*\n(.*)", text, re.M)
    [scan] = [i for i, (name, out) in enumerate(steps) if name == "Scan" and column in out]
    names = [name for name, _ in steps[scan:]]
    return names[: names.index("Exchange")]


def test_report_lists(spark, many, monkeypatch):
    plans = _spied(monkeypatch, collecting)
    found = REGISTRY["report_lists"](spark, many).toPandas()
    assert len(plans) == 4
    assert all("SortMergeJoin" in p and "BroadcastExchange" not in p for p in plans)
    assert comparable(found) == _wanted(many, "report_lists")


def test_post_report(spark, many):
    """No task holds all users: they are sorted and merged."""
    found = REGISTRY["post_report"](spark, many)
    assert "SortMergeJoin" in plan(found) and "BroadcastExchange" not in plan(found)
    assert comparable(found.toPandas()) == _wanted(many, "post_report")


def test_post_report_sorts_no_whole_file(spark, many):
    """A file of one row group is one task, which sends its users before any are sorted."""
    found = _read_with(plan(REGISTRY["post_report"](spark, many)), "c_custkey")
    assert found[0] == "Scan" and not any("Sort" in name for name in found)


def test_report_json(spark, many, monkeypatch):
    plans = _spied(monkeypatch, files)
    found = REGISTRY["report_json"](spark, many).toPandas()
    assert len(plans) == 1
    assert "SortMergeJoin" in plans[0] and "BroadcastExchange" not in plans[0]
    assert comparable(found) == _wanted(many, "report_json")


def test_report_json_sorts_no_whole_file(spark, many, monkeypatch):
    plans = _spied(monkeypatch, files)
    REGISTRY["report_json"](spark, many)
    [found] = [_read_with(text, "c_custkey") for text in plans]
    assert found[0] == "Scan" and not any("Sort" in name for name in found)
