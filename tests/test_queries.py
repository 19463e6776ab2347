"""Registered queries against their SQL on the small table."""

import os
import shutil
import subprocess
import sys
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__
from tests.conftest import SMALL
from tidemark.plans import registry

SOME = sorted(registry.ORACLES)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(SMALL):
        c.sql(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SMALL}/{t}'")
    return c


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}")
    if isinstance(v, datetime):
        return v.date()
    return v if isinstance(v, date) or not hasattr(v, "item") else v.item()


@pytest.mark.parametrize("name", SOME)
def test_same_rows(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    want = duck.sql(__spark_entry__.oracle_sql()[name])
    assert sorted(want.columns) == columns
    rows = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    at = [want.columns.index(c) for c in columns]
    assert rows and Counter(rows) == Counter(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("gone", [["tidemark/llm"], ["tidemark/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_without_the_corpus_operators(tmp_path, gone):
    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    copy = shutil.copytree(root, tmp_path / "copy", ignore=lambda d, names: [n for n in names if n in (".git", "tests", "__pycache__") or os.path.relpath(os.path.join(d, n), root) in gone])
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True).stdout.split()
    assert int(said[0]) >= int(said[1]) > 40


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_report_columns(spark):
    from tidemark.plans.forecast import REPORT, compare_scenarios, forecast_run
    from tidemark.plans.registry import SETTINGS, _catalog, _demand

    demand = _demand(spark, SMALL).filter("Product_Group = 'Brand#1'")
    read = _catalog(spark, SMALL)
    report, pairs, short = forecast_run(demand, read.groups, read.unit_names, SETTINGS)
    rows = report.collect()
    assert tuple(report.columns) == REPORT and rows and len(rows) % 12 == 0
    assert all(r.Lower_CI <= r.Forecast <= r.Upper_CI and r.Lower_CI >= 0 for r in rows)
    assert compare_scenarios(demand, read.groups, read.unit_names, SETTINGS, None, None).count() > 0


def _above(plan, leaf, node):
    """How many nodes of a class are above the relation with a column, on the way down to it; None if it is not there."""
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    if not children:
        return 0 if f"{leaf}#" in plan.toString() else None
    found = [n for n in (_above(c, leaf, node) for c in children) if n is not None]
    return found and max(found) + (plan.nodeName() == node) if found else None


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan()


def test_lines_move_by_order_and_by_part_only(spark):
    from tidemark.sources import star_schema

    assert _above(_optimized(star_schema.pipeline(spark, SMALL)), "l_orderkey", "Join") == 2


def test_names_are_summed_before_their_groups_repeat_them(spark):
    """Summed by name, and then by group: each line of a name with 25 groups was 25 rows to be summed."""
    assert _above(_optimized(registry._prepared(spark, SMALL)), "l_orderkey", "Aggregate") == 2


def test_facts_meet_the_catalog_before_they_are_summed(spark):
    """A sum by product, unit and month has nearly as many rows as there are facts, which then moved twice."""
    from tidemark.operators import features, series
    from tidemark.sources import star_schema

    skus = registry._catalog(spark, SMALL).skus
    assert _above(_optimized(series.monthly_demand(series.clean_actuals(star_schema.actuals(spark, SMALL)), skus)), "l_partkey", "Aggregate") == 1
    assert _above(_optimized(features.backlog_monthly(star_schema.backlog(spark, SMALL), skus)), "l_partkey", "Aggregate") == 1


def test_facts_of_several_groups_count_once(spark):
    from tidemark.operators import mapping

    skus = spark.createDataFrame([("a", "P1"), ("b", "P1"), ("a", "P1"), ("c", "P2")], "Product_Group string, sku string")
    facts = spark.createDataFrame([("p1",), ("P2",), ("p3",)], "Product string")
    rows = mapping.map_products(facts, skus, keep_unmapped=True, once="once").collect()
    assert sorted((r.Product, r.Product_Group or "", r.once) for r in rows) == [("P2", "c", True), ("p1", "a", True), ("p1", "b", False), ("p3", "", True)]
