"""Every registered query with a SQL counterpart agrees with it, and plans stay free of nested loops."""

import contextlib
import io
import os

import pytest

import __spark_entry__ as app
import compare

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The quick ones; `python compare.py` runs all.
SOME = ["monthly_trade", "trade_snapshots", "stress_rules", "score_opportunities", "match_suppliers", "enrich_orgs_by_name",
        "create_leads", "buyer_profiles", "session_leads", "keyed_merge", "gold_upsert", "assign_leads", "demote_stale",
        "apply_overrides", "stream_profiles", "effective_permissions", "lead_prediction", "classifier_metrics"]
LAZY = ["trade_snapshots", "match_profiles", "dedup_leads", "session_leads", "strategic_watch", "keyed_merge",
        "link_conversion_buyers", "pipeline_quality", "next_best_action", "keyword_use_cases", "contact_links"]


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


@pytest.mark.parametrize("name", SOME)
def test_query_agrees_with_sql(spark, con, name):
    line = compare.compare(spark, con, FOLDER, name, app.queries()[name], app.oracle_sql().get(name))
    assert line.startswith("ok"), line


@pytest.mark.parametrize("name", LAZY)
def test_plan_has_no_cartesian_or_python(spark, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        app.queries()[name](spark, FOLDER).explain("formatted")
    plan = out.getvalue()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert word not in plan, word


def test_entry_runs(spark):
    assert app.entry(spark).limit(5).count() == 5


def test_every_sql_has_its_query():
    assert set(app.oracle_sql()) <= set(app.queries())


def test_decision_makers_has_contacts_of_whole_names(spark, tmp_path):
    spark.createDataFrame([(n, f"Customer#{n:09d}", "AUTO", 1) for n in range(2, 9)],
                          "c_custkey int, c_name string, c_mktsegment string, c_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    got = {(r.company, r.person_key) for r in app.queries()["decision_makers"](spark, str(tmp_path)).collect()}
    own = {(f"Customer#{n:09d}", f"m{n}@x.example") for n in (2, 4, 6, 8)}  # the cut name of 7 is in all of them too
    assert {g for g in got if len(g[0]) == 18 and g[1].startswith("m")} == own
    assert {g[1] for g in got if len(g[0]) == 17} == {"m4@x.example", "m8@x.example", "zi:Customer#000000005"}  # buyers by their titles
