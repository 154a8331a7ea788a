"""Physical plan shape: top-k limits before the shuffle, no Python in built-in-only
queries, broadcast of small dimensions, pruned scans."""

import pytest

import __spark_entry__ as E
from inferframe.plans import catalog
from tests.conftest import SF_SMALL

Q = {k: v for k, v in E.queries().items() if k in catalog.QUERIES}
PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
            "FlatMapCoGroupsInPandas", "PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_topk_uses_window_group_limit(spark):
    p = plan(Q["jn_topk"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["prj_chat", "prj_options", "ag_content", "ag_tool_calls",
                                  "wn_boundaries", "cv_blocks", "cv_render", "val_json_schema",
                                  "val_grammar", "sc_smart_resize", "fl_pages", "wn_history",
                                  "wn_task_outcome", "ag_conversation", "prj_conv_options"])
def test_builtin_queries_stay_in_the_jvm(spark, name):
    p = plan(Q[name](spark, SF_SMALL))
    assert not any(n in p for n in PY_NODES), name


@pytest.mark.parametrize("name", ["rsp_chat", "rsp_completion", "rsp_transcript", "rsp_outcome", "ag_outcomes", "rsp_embeddings",
                                  "rsp_tool_calls", "jn_dispatch", "val_tool_args", "jn_reconcile", "jn_pending"])
def test_response_queries_call_nothing(spark, name):
    p = plan(Q[name](spark, SF_SMALL))
    assert not any(n in p for n in PY_NODES), name


def test_pass_rate_reads_each_table_once(spark):
    assert plan(Q["ag_pass_rate"](spark, SF_SMALL)).count("FileScan parquet") == 2


@pytest.mark.parametrize("name", ["jn_prompt", "jn_dispatch", "jn_profiles", "jn_model"])
def test_small_dimensions_are_broadcast(spark, name):
    assert "BroadcastHashJoin" in plan(Q[name](spark, SF_SMALL))


def test_no_cross_joins_anywhere(spark):
    for name, fn in Q.items():
        if name.startswith("st_") or name in ("snk_requests", "snk_outcomes", "src_responses"):
            continue
        p = plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_item_scan_is_pruned(spark):
    p = plan(Q["src_items"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_render_blocks_json(spark):
    import json
    from inferframe.operators.pages import pages_to_blocks, render_blocks
    pages = spark.createDataFrame([(1, "<html><body><article><h1>T &amp; U</h1><p>one<p><b>two</b></p>"
                                       "</article><footer>&copy; x</footer></body></html>")],
                                  "page_id long, html string")
    r = render_blocks(pages_to_blocks(pages), "json").first()
    assert json.loads(r["document"]) == [{"category": "Title", "text": "T & U"},
                                         {"category": "Text", "text": "one"},
                                         {"category": "Text", "text": "two"},
                                         {"category": "Page-footer", "text": "© x"}]
    md = render_blocks(pages_to_blocks(pages), "md").first()["document"]
    assert md == "# T & U\n\none\n\ntwo\n\n© x"


def test_package_is_shipped_to_executors(spark):
    """The zip added with addPyFile holds every module of the package."""
    import os
    import zipfile
    import inferframe
    from inferframe.session import ship_package
    ship_package(spark)
    root = os.path.dirname(inferframe.__file__)
    want = {os.path.relpath(os.path.join(d, f), os.path.dirname(root))
            for d, _, fs in os.walk(root) for f in fs if f.endswith(".py")}
    zips = [os.path.join(dp, f) for dp, _, fs in os.walk("/tmp") for f in fs
            if f == "inferframe.zip" and "inferframe-pyfiles-" in dp]
    assert zips
    newest = max(zips, key=os.path.getmtime)
    assert want <= set(zipfile.ZipFile(newest).namelist())
