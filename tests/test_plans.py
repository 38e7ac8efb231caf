"""Physical plan checks: no Python evaluation, no single-partition exchange in
the bucketed scan, the summary table broadcast, parse inside codegen."""

import contextlib
import io

from conftest import SF001
from solospan.operators.exclusive import exclusive_ranges
from solospan.queries import QUERIES
from solospan.sources.derived import ip_ranges


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_range_plan_shape(spark):
    """The ranges go through one range exchange and one sweep; what is left is a join with the carries."""
    from solospan.plans import scan, sweep

    raw = ip_ranges(spark, SF001, sets=16)
    plan = scan.scan_plan(raw, ["set_id"], ["begin", "end"], "bucketed", target_rows=200)
    laid = raw.repartitionByRange(plan.partitions, "set_id", "begin", "end").sortWithinPartitions("set_id", "begin", "end")
    swept = sweep.sweep(laid, ["set_id"], {}, {"next": "begin"}, {}, {("far", "second"): "end"})
    p = plan_text(swept, "simple")
    assert p.count("Exchange rangepartitioning(set_id") == 1 and p.count("Exchange") == 1 and p.count("MapInArrow") == 1
    # the scan reads only the columns it needs
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int,l_extendedprice:double>" in plan_text(swept)
    assert swept.where(sweep.EDGE).count() <= 2 * plan.partitions
    df = exclusive_ranges(ip_ranges(spark, SF001, sets=16), strategy="bucketed", target_rows=200)
    df.collect()
    final = plan_text(df, "simple").split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final and "FileScan" not in final


def test_planning_collects_no_rows():
    import inspect

    from solospan.plans import scan, sweep

    for module in (scan, sweep):
        assert not any(w in inspect.getsource(module) for w in (".collect()", "toPandas", "toLocalIterator", "createDataFrame"))


def test_window_plan_has_no_python_and_one_shuffle(spark):
    p = plan_text(exclusive_ranges(ip_ranges(spark, SF001, sets=16), strategy="window"))
    assert "Python" not in p
    assert "Window" in p
    assert sum("Arguments: hashpartitioning(" in l for l in p.splitlines()) == 1


def test_no_registered_query_uses_python(spark):
    for name, q in QUERIES.items():
        p = plan_text(q(spark, SF001), "simple")
        assert "EvalPython" not in p and "PythonUDF" not in p, name


def test_parse_plan_keeps_codegen(spark):
    p = plan_text(QUERIES["parse_ranges"](spark, SF001), "codegen")
    assert "WholeStageCodegen" in p
    assert len(p.splitlines()) < 6000
