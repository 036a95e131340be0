"""Physical plans: what must not be in them, and what must."""

import pytest
from pyspark.sql import functions as F

from broadsheet.plans.catalog import QUERIES
from broadsheet.storage import Workspace
from tests.conftest import SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def plan(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def executions(spark):
    """All executions the session knows of, by id; what has been posted is waited for."""
    spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    store = spark._jsparkSession.sharedState().statusStore()
    found = store.executionsList()
    return {found.apply(i).executionId(): found.apply(i) for i in range(found.size())}


def all_plans(spark, build):
    """Plans of every job that runs while a query is built, and that of the query itself."""
    before = max(executions(spark), default=-1)
    last = build(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    ran = {number: execution for number, execution in executions(spark).items() if number > before}
    assert not ran or len(ran) == max(ran) - min(ran) + 1, "executions were dropped"
    return [ran[number].physicalPlanDescription() for number in sorted(ran)] + [last]


def forbidden(plans):
    return [word for text in plans for word in FORBIDDEN if word in text]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_joins(spark, name):
    assert not forbidden(all_plans(spark, QUERIES[name]))


def test_plans_of_inner_jobs_are_seen(spark):
    assert len(all_plans(spark, QUERIES["mirror_triage"])) > 3


def test_python_in_an_inner_job_is_seen(spark, monkeypatch):
    """A Python function put into a table that triage writes must show, however many executions came before."""
    write = Workspace.write
    marked = []

    def with_python(self, df):
        if not marked:
            marked.append(1)
            df = df.withColumn(df.columns[0], F.udf(lambda value: value, df.schema[0].dataType)(F.col(df.columns[0])))
        return write(self, df)

    monkeypatch.setattr(Workspace, "write", with_python)
    assert forbidden(all_plans(spark, QUERIES["mirror_triage"]))


@pytest.mark.parametrize("name", ["norm_articles", "page_lines", "page_harvest", "relevance_rules", "search_near", "tier_lookup"])
def test_no_shuffle(spark, name):
    assert "Exchange hashpartitioning" not in plan(spark, name)


@pytest.mark.parametrize("name", ["dedup_url_first", "dedup_labelled", "feed_latest", "listing"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("name", ["lookback_ts", "lookback_day"])
def test_window_reaches_the_scan(spark, name):
    assert "GreaterThanOrEqual(ts" in plan(spark, name)


def test_only_needed_columns_are_read(spark):
    assert "ReadSchema: struct<doc_id:bigint>" in plan(spark, "url_resolve")
    assert "html" not in plan(spark, "url_domain").split("ReadSchema", 1)[1]


def test_caps_sort_only_what_they_keep(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_relevance_input")
    assert "TakeOrderedAndProject" in plan(spark, "final_cap")
