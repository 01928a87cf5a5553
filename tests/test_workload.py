"""Every registered query against its SQL, and the shape of the plans."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from semstore.plans.workload import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    rows, columns = df.collect(), sorted(df.columns)
    if name not in ORACLES:
        assert rows
        return
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in rows) == expected


def test_entry(spark):
    assert entry_module.entry(spark).count() == 10
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


LAZY = [n for n in sorted(QUERIES) if not re.match("collection_|store_pipeline|stream_|embed_once|search_cells_(all|recall|exact_)", n)]


@pytest.mark.parametrize("name", LAZY)
def test_no_plan_pairs_everything_with_everything(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def plan_of(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("search_filtered_topk", "EqualTo(label,1)"),
        ("filter_eq", "EqualTo(lang,en)"),
        ("filter_ne", "Or(IsNull(lang),Not(EqualTo(lang,en)))"),
        ("filter_gt", "GreaterThan(value,50.0)"),
        ("filter_ge", "GreaterThanOrEqual(user_id,100)"),
        ("filter_le", "LessThanOrEqual(n_chars,300)"),
        ("filter_in", "In(event_type, [click,signup])"),
        ("delete_by_filter", "Not(EqualTo(lang,en))"),
        ("get_by_id_list", "In(doc_id, [17,3,42])"),
        ("scroll_page", "GreaterThan(doc_id,40)"),
    ],
)
def test_filters_reach_the_scan(spark, sf_dir, name, pushed):
    assert pushed in plan_of(spark, sf_dir, name)


def test_one_vector_search_sends_on_the_best_only(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "search_threshold")
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    assert plan.count("zip_with") == 1
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in plan


def test_batch_search_cuts_before_its_shuffle(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "search_batch_topk")
    assert plan.count("Exchange hashpartitioning") == 1 and "Partial" in plan and "MapInArrow" in plan


def test_upserts_cut_before_their_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan_of(spark, sf_dir, "upsert_latest_wins")
