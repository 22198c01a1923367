"""The physical plans are the intended ones."""

import re

import pytest

from tagmatch import recommend_titled
from tagmatch.plans.oracle import ORACLE_SQL
from tagmatch.plans.queries import QUERIES, TARGET_USER
from tagmatch.sources import testdata
from tests.conftest import TESTDATA
from tests.oracle_check import connect

SF_DIR = f"{TESTDATA}/sf0.01"

SLOW_NODES = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "FlatMapGroupsInPandas",
)


def executed_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["recommend_titled", "recommend_hashed", "tfidf", "build_subset"])
def test_no_slow_nodes(spark, name):
    plan = executed_plan(QUERIES[name](spark, SF_DIR))
    assert not [node for node in SLOW_NODES if node in plan]


def test_interactions_are_shuffled_by_user_once(spark):
    tables = (f(spark, SF_DIR) for f in (testdata.interactions, testdata.items, testdata.item_tags))
    plan = executed_plan(recommend_titled(*tables, 0))
    by_user = re.findall(r"^.*REPARTITION_BY_NUM.*$", plan, re.M)
    assert len(by_user) > 1
    assert len([line for line in by_user if "ReusedExchange" not in line]) == 1
    # One scan of the liked rows, with only the columns and rows needed.
    scans = re.findall(r"FileScan parquet \[l_[^\n]*", plan)
    scans = [s for s in scans if "l_returnflag" in s]
    columns = r"\[l_orderkey#\d+L?,l_partkey#\d+L?,l_linenumber#\d+,l_returnflag#\d+\]"
    assert len(scans) == 1
    assert all(re.match(rf"FileScan parquet {columns}", s) for s in scans)
    assert all("EqualTo(l_returnflag,A)" in s for s in scans)


def test_nearest_users_are_not_sorted_as_a_whole(spark):
    plan = executed_plan(QUERIES["similar_users_top3"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize(
    ("partitions", "adaptive"), [("1", "true"), ("7", "false"), ("40", "true")]
)
def test_results_do_not_depend_on_partitions(spark, partitions, adaptive):
    kept = {key: spark.conf.get(key) for key in (
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        nearest = QUERIES["similar_users_top3"](spark, SF_DIR).collect()
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    assert [tuple(r) for r in nearest] == [(844, 0.647577), (244, 0.610684), (572, 0.592775)]


@pytest.mark.parametrize(("sf", "target"), [("0.001", 42), ("0.01", 7)])
def test_neighbours_of_other_targets(spark, sf, target):
    from pyspark.sql import functions as F

    from tagmatch.operators.catalog import item_catalog
    from tagmatch.operators.interactions import positive_interactions
    from tagmatch.operators.profiles import Profiles
    from tagmatch.operators.similarity import cosine_similarity, most_similar

    sf_dir = f"{TESTDATA}/sf{sf}"
    profiles = Profiles(
        positive_interactions(testdata.interactions(spark, sf_dir)),
        item_catalog(testdata.items(spark, sf_dir), testdata.item_tags(spark, sf_dir)),
    )
    nearest = most_similar(cosine_similarity(profiles, target))
    found = nearest.select("user_id", F.round("cosine_similarity", 6)).collect()
    sql = ORACLE_SQL["similar_users_top3"]
    for sign in ("=", "<>"):
        sql = sql.replace(f"user_id {sign} {TARGET_USER}", f"user_id {sign} {target}")
    assert [tuple(r) for r in found] == connect(sf_dir).execute(sql).fetchall()
