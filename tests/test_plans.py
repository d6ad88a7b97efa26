"""Physical-plan audit of every registered batch query: no Cartesian
products or nested-loop joins, no Python UDF evaluation, and the flagship
keeps its per-group limits and partial aggregation."""

import contextlib
import io

import pytest

import __spark_entry__ as entry_mod
from editsurge.plans import registry

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]
# Streaming queries run a stream before returning their (batch) output
# table; their plans are audited through the operators they call.
BATCH = sorted(k for k in registry.queries() if not k.startswith("stream_"))


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_products_or_python(spark, name):
    text = plan_text(entry_mod.queries()[name](spark, SF))
    bad = [f for f in FORBIDDEN if f in text]
    assert not bad, f"{name}: {bad}"


def test_flagship_plan_shape(spark):
    text = plan_text(entry_mod.queries()["trends_report"](spark, SF))
    assert text.count("WindowGroupLimit") >= 2            # top topics and top articles, partial + final
    assert "partial_count" in text                          # map-side combine before the shuffle
    # articles are counted for the reported topics only: the semi-join lies below the count
    assert "LeftSemi" in text


def test_cascade_plan_has_few_scans(spark):
    text = plan_text(entry_mod.queries()["class_hierarchy_closure"](spark, SF))
    # the closure, the start nodes and the kept classes are checkpointed, so the plan
    # reads each of them once instead of unfolding the graph for every branch
    assert text.split("== Physical Plan ==")[1].split("\n\n")[0].count("Scan ") <= 12


def executed(df):
    """The final adaptive plan of a query that has run."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


@pytest.mark.parametrize("name, scans, exchanges", [("trends_report", 1, 5), ("trends_api", 2, 6), ("cluster_articles", 1, 6)])
def test_reports_read_their_inputs_once(spark, name, scans, exchanges):
    """Lists of topics end the plans of what they come from (counts and baselines; in the report
    names too); what is left reads names and articles once each."""
    final = executed(entry_mod.queries()[name](spark, SF))
    assert final.count("FileScan") == scans, final
    shuffles = [x for x in final.splitlines() if "Exchange " in x and "Broadcast" not in x and "Reused" not in x]
    assert len(shuffles) <= exchanges, final
