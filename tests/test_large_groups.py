"""What keeps steps small where one key, name, page or file holds much."""

from pyspark.sql import functions as F

from leadloom.checks import queries_state, queries_views
from leadloom.checks.compose import Inputs
from leadloom.operators import enrich, governance, models, provenance
from tests.conftest import rows


def _plan(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_events_land_as_they_are_partitioned(spark, tmp_path):
    made = spark.range(0, 900, 1, 6).select(F.col("id").cast("string").alias("event_key"))
    seen = []
    queries_state.in_parts(made, str(tmp_path / "in"), F.col("event_key").endswith("5"), lambda: seen.append(len(list((tmp_path / "in").glob("*.txt")))))
    assert seen[0] == 6 and seen[1] >= 12
    lines = [r.value for r in spark.read.text(str(tmp_path / "in")).collect()]
    assert len(set(lines)) == 900
    assert queries_views.land(made.select(F.col("event_key").alias("value")), str(tmp_path / "two")) == 3


def test_a_shared_fixture_is_computed_once(spark, tmp_path):
    pieces = {"shipments": "SELECT l_orderkey AS a, rand() AS r FROM {lineitem}", "one": "SELECT a, r FROM {shipments}", "two": "SELECT a, r FROM {shipments}"}
    spark.range(50).select(F.col("id").alias("l_orderkey")).write.parquet(str(tmp_path / "lineitem.parquet"))
    i = Inputs(spark, str(tmp_path), pieces)
    assert rows(i.one) == rows(i.two) == rows(i.shipments)


def test_best_company_of_a_domain_is_found_before_organisations_meet_it(spark):
    orgs = spark.createDataFrame([(f"o{k}", f"Firm {k}", "d.example") for k in range(40)] + [("p", "Acme Long Ltd", "")], "org_id string, org_name string, domain string")
    companies = spark.createDataFrame([(f"Other {k:03}", k, "i", "d.example", "x") for k in range(50)] + [
        ("acme", 1, "i", "", "x"), ("ACME long", 2, "i", "", "x"), ("Acme Long", 3, "i", None, "x"), (" ", 4, "i", "d.example", "x")],
        "company_name string, employee_count long, industry string, domain string, country string")
    got = enrich.enrich_orgs_by_name(orgs, companies)
    assert rows(got.select("org_id", "matched_company", "employee_count")) == sorted([(f"o{k}", "Other 049", 49) for k in range(40)] + [("p", "Acme Long", 3)], key=repr)
    assert _plan(got).count("Aggregate") >= 4


def test_links_of_contacts_of_several_companies_come_once(spark):
    people = spark.createDataFrame([("a", "acme"), ("a", "Acme Ltd"), ("b", "ACME"), ("c", ""), ("d", None), (None, "acme")], "person_key string, company_name string")
    orgs = spark.createDataFrame([("o1", "Acme Ltd"), ("o1", "The Acme Ltd"), ("o2", "acme"), ("o3", None)], "org_id string, org_name string")
    assert rows(enrich.contact_links(people, orgs)) == sorted([(p, o) for p in ("a", "b", None) for o in ("o1", "o2")], key=repr)


def test_scopes_below_one_ancestor_are_cut_up(spark):
    scopes = spark.range(3000).select(F.concat(F.lit("s"), "id").alias("scope_id"), F.lit("top").alias("parent_id"))
    rules = spark.createDataFrame([("top", "p", "allow"), ("top", "q", "deny"), ("s7", "p", "deny")], "scope_id string, permission string, effect string")
    got = governance.effective_permissions(scopes, rules)
    assert "_grid_row" in _plan(got)
    assert got.count() == 6000 and rows(got.where("effect = 'deny' AND permission = 'p'")) == [("s7", "p", "deny")]


def test_pairs_of_ghosts_and_leads_come_once(spark):
    ghosts = spark.createDataFrame([("g", "s1"), ("g", "s2"), ("h", "s3")], "profile_id string, session_id string")
    views = spark.createDataFrame([("s1", 1), ("s1", 2), ("s2", 3), ("s3", 1)], "session_id string, page_view_id int")
    view_sources = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (3, None)], "page_view_id int, source_id string")
    leads = spark.createDataFrame([("l", "x"), ("l", "x"), ("m", "x"), ("m", "y"), (None, "y"), ("n", None)], "lead_id string, source_id string")
    got = provenance.ghost_to_lead(ghosts, views, view_sources, leads)
    assert rows(got) == sorted([("g", "l"), ("g", "m"), ("g", None), ("h", "l"), ("h", "m")], key=repr)


def test_without_enough_positive_rows_no_probability_is_known(spark):
    made = spark.createDataFrame([("r", 0.0, False)], "rel_id string, label double, holdout boolean")
    model = models.fit_switch_classifier(made)
    assert model is None
    assert rows(models.switch_probability(model, made)) == [("r", None)]
    assert rows(models.score_explanations(model, made, top=3)) == []
