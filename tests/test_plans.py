"""Scale guards on the physical plans of every registered query."""

import re

from conftest import SF_SMALL

from quarry.operators import search as S
from quarry.plans.catalog import QUERIES

# queries whose nested-loop join has a one-row or fixed-size side by construction:
# match-all (every document x the few match-all clauses), one-row statistics, the
# (query x requested index) grid of result counts, the one-row batch-size statistics
NESTED_LOOP_OK = {"match_all", "index_stats", "result_counts", "ledger_batches"}


def test_no_cartesian_and_bounded_nested_loops(spark):
    for name, fn in QUERIES.items():
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
        if name not in NESTED_LOOP_OK:
            assert "BroadcastNestedLoopJoin" not in plan, name
        assert not re.search(r"MapInPandas|MapInArrow|FlatMapGroups|ArrowEvalPython|BatchEvalPython", plan), name


def test_scans_are_pruned(spark):
    plan = QUERIES["bm25_or"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))
    assert "struct<doc_id:bigint,text:string>" in schemas
    assert all("lang" not in s and "n_chars" not in s for s in schemas)


def test_top_k_is_limited_before_the_shuffle(spark):
    df = QUERIES["bm25_term"](spark, SF_SMALL)
    df.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) and final


def test_expansions_join_on_more_than_the_field(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_MAX_ROWS", 0)
    for name in ("prefix_search", "wildcard_search", "regexp_search", "term_range_search", "pattern_search", "fuzzy_two_edits"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and not re.search(r"SortMergeJoin \[field#\d+\], \[field#\d+\]", plan), name
