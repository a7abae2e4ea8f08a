"""The plans are the ones meant: what moves, what is broadcast, what reaches the scan."""

import os

import pytest
from pyspark.sql import functions as F

from checks import views
from checks.views import table, view
from srcsieve.operators import discovery as D
from srcsieve.operators import exact_dedup as E
from srcsieve.operators import languages as L
from srcsieve.operators import quality as G

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")


@pytest.fixture(autouse=True)
def unspread_tables(monkeypatch):
    monkeypatch.setattr(views, "TEXT_KEYS", {})


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_quality_chain_is_one_narrow_stage(spark):
    plan = physical(G.quality_filter_chain(view(spark, SF, "code_files")))
    assert not exchanges(plan) and "Join " not in plan and "EvalPython" not in plan


def test_duplicate_groups_shuffle_digests_only(spark):
    plan = physical(E.exact_duplicate_groups(view(spark, SF, "code_files"), "id"))
    assert "partial_min" in plan
    for line in exchanges(plan):
        assert "text" not in line


def test_dedup_keeps_texts_in_place(spark):
    plan = physical(E.exact_dedup(view(spark, SF, "code_files"), "id"))
    assert "BroadcastHashJoin" in plan and not exchanges(plan)


def test_language_lookup_is_broadcast(spark):
    tokens = view(spark, SF, "language_tokens").groupBy("pos", "language").agg(F.collect_list("token").alias("extensions"))
    plan = physical(L.detect_language(view(spark, SF, "code_files"), L.extension_language_dim(tokens)))
    assert "BroadcastHashJoin" in plan and "BroadcastNestedLoopJoin" not in plan and not exchanges(plan)


def test_repo_rules_reach_the_scan(spark):
    meta = table(spark, SF, "customer").select(
        F.col("c_custkey").alias("stars"), F.col("c_nationkey").alias("size"), F.col("c_mktsegment").alias("language")
    )
    plan = physical(D.filter_has_language(D.filter_repo_size(D.filter_min_stars(meta))))
    assert "GreaterThanOrEqual(c_custkey,50)" in plan and "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_mktsegment:string>" in plan


def test_latest_event_aggregates_before_the_shuffle(spark):
    plan = physical(D.latest_event_per_repo(D.filter_event_types(view(spark, SF, "archive_events"))))
    assert len(exchanges(plan)) == 1 and "partial_max" in plan
