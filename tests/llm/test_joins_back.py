"""Facts on documents that are too many to be broadcast: no text is exchanged for them."""

import pytest

from tagmatch.llm import decontaminate, near_dup, pii, queries
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"


def exchanged_columns(df):
    """Names of the columns of each exchange of the plan as it ran."""
    rows = df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            if "Exchange" in name:
                output = node.output()
                found.append({output.apply(i).name() for i in range(output.size())})
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return rows, found


@pytest.mark.parametrize(
    ("query", "module"), [("op1_pii", pii), ("op4_near_dup", near_dup), ("op5_decontaminate", decontaminate)]
)
def test_no_text_in_an_exchange(spark, monkeypatch, query, module):
    small, _ = exchanged_columns(queries.QUERIES[query](spark, SF_DIR))
    monkeypatch.setattr(module, "BROADCAST_ROWS", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large, columns = exchanged_columns(queries.QUERIES[query](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert columns and not any("text" in names for names in columns)
    assert sorted(map(repr, small)) == sorted(map(repr, large))
