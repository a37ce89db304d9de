"""Plan-shape regression tests: the properties the scale design relies on."""

import re

import __spark_entry__ as E

from .conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Queries that balance nested elements of pages: one Arrow pass over the standard parser.
ELEMENT_TREES = ("html_book_records", "html_book_rejects", "html_product_links", "html_nested")


def test_no_cross_joins_or_python_in_any_query(query_frame):
    bad = {}
    for name in E.queries():
        plan = _plan(query_frame(name))
        hits = [f for f in FORBIDDEN if f in plan and not (f == "ArrowEvalPython" and name in ELEMENT_TREES)]
        if hits:
            bad[name] = hits
    assert not bad, bad


def _scan_columns(plan: str) -> list[list[str]]:
    return [[c.split("#")[0] for c in cols.split(",")] for cols in re.findall(r"FileScan \w+ \[([^\]]*)\]", plan)]


def test_column_pruning_and_single_scans(spark):
    q = E.queries()
    assert _scan_columns(_plan(q["bi_count_by_group"](spark, SF_SMALL))) == [["p_type"]]
    assert _scan_columns(_plan(q["bi_sum_share"](spark, SF_SMALL))) == [["l_extendedprice", "l_returnflag"]]
    assert _scan_columns(_plan(q["check_fk"](spark, SF_SMALL))) == [["l_orderkey"], ["o_orderkey"]]
    positive = _plan(q["positive_filter"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThan(c_acctbal,0.0)]" in positive


def test_partial_window_limits(spark):
    for name in ("latest_per_key_ties", "dedup_first"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert "WindowGroupLimit" in plan and "Partial" in plan, name


def test_metric_queries_hash_aggregate_and_copy_only_panes(query_frame):
    for name in [n for n in E.queries() if n.startswith("metric_")]:
        plan = _plan(query_frame(name))
        assert "SortAggregate" not in plan, name
        # an explode or expand of samples would stand below every aggregate, next to the scan
        for m in re.finditer(r"(Generate|Expand)", plan):
            assert "HashAggregate" in plan[m.end():], name


def test_rate_from_increments_needs_no_window(spark):
    plan = _plan(E.queries()["metric_rate_1d"](spark, SF_SMALL))
    assert "Window" not in plan.replace("window_", "") and "partial_min_by" in plan


def test_raw_counters_are_scanned_once_and_not_windowed(spark):
    """Below the counter that the query derives (its running sum), a rate reads its input once and needs no window."""
    from rivulet.operators import metrics as M
    df = spark.createDataFrame([(1, "s", 1.0)], "id long, series string, value double").selectExpr("*", "timestamp_seconds(id) AS ts")
    plan = _plan(M.counter_rate(df, ["series"], "ts", "value", "id", "1 day", "6 hours"))
    assert len(re.findall(r"Scan ExistingRDD|LocalTableScan", plan)) == 1 and not re.search(r"\bWindow\b", plan)


def test_health_evaluates_the_vector_once_and_recent_ranges_reach_the_scan(spark):
    q = E.queries()
    assert len(_scan_columns(_plan(q["metric_health"](spark, SF_SMALL)))) == 1
    recent = _plan(q["metric_recent_6h"](spark, SF_SMALL))
    assert len(_scan_columns(recent)) == 1 and re.search(r"PushedFilters: \[[^]]*GreaterThan\(ts,", recent)
