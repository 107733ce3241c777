"""Joins of uneven keys, containment, and resolution of permissions, against plain versions."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from leadloom.functions import skew
from leadloom.operators import enrich, governance, trade
from tests.conftest import rows


@pytest.fixture(scope="module")
def uneven(spark):
    """One key holds a third of all rows of both sides, some keys have one side only, some rows are repeated."""
    rng = random.Random(6)
    left = [(rng.choice([None, "hot"] if n % 3 == 0 else [f"k{rng.randrange(40)}", "l"]), n % 900) for n in range(3000)]
    right = [("hot" if n % 3 == 0 else rng.choice([f"k{rng.randrange(40)}", "r", None]), n) for n in range(1500)]
    return spark.createDataFrame(left, "k string, a int"), spark.createDataFrame(right, "k string, b int"), left, right


@pytest.mark.parametrize("cell", [50, 100_000])
def test_grid_join_is_the_join(uneven, cell):
    a, b, _, _ = uneven
    got, want = (df.groupBy("k", "a", "b").count() for df in (skew.grid_join(a, b, ["k"], cell), a.join(b, "k")))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert skew.grid_join(a.where("1 = 0"), b, ["k"], cell).count() == 0
    near = skew.grid_join(a, b, ["k"], cell, condition=F.abs(F.col("a") - F.col("b")) < 3)
    assert near.count() == a.join(b, "k").where("abs(a - b) < 3").count()


def test_no_part_of_a_hot_key_is_much_larger_than_the_median(uneven):
    a, b, left, _ = uneven
    one, two = skew.grid_sides(a, b, ["k"], 50)
    hot = [r["count"] for r in one.where("k = 'hot'").groupBy(skew.ROW, skew.COLUMN).count().collect()]
    assert sum(k == "hot" for k, _ in left) > 400 and len(hot) > 50 and max(hot) <= 3 * statistics.median(hot)
    both = one.select("k", skew.ROW, skew.COLUMN).unionByName(two.select("k", skew.ROW, skew.COLUMN))
    tasks = [r["count"] for r in both.repartition(8, "k", skew.ROW, skew.COLUMN).groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) <= 3 * statistics.median(tasks)
    assert one.where("k = 'l'").count() == sum(k == "l" for k, _ in left) and one.where("k IS NULL").isEmpty()  # cut up, not copied


def test_relationships_of_a_hot_code_are_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(skew, "CELL", 7)
    companies = [(f"c{i}", f"Company {i}", "buyer" if i % 2 else "Supplier") for i in range(80)]
    codes = [(c, "hot" if n % 4 else f"x{n % 5}", 5.0) for n, (c, _, _) in enumerate(companies)]
    who = spark.createDataFrame(companies, "company_id string, company_name string, company_role string").withColumns({
        "number_of_shipments": F.lit(3), "shipment_value": F.lit(10.0), "from_date": F.lit("2023-01-01").cast("date"), "to_date": F.lit("2023-06-01").cast("date")})
    listed = spark.createDataFrame(codes, "company_id string, hs_code string, share double")
    got = trade.relationships_from_codes(who, listed.withColumnRenamed("share", "import_share_pct"), listed.withColumnRenamed("share", "export_share_pct"), "2024-01-31 00:00:00")
    want = {(a, b, x) for a, x, _ in codes for b, y, _ in codes if x == y and int(a[1:]) % 2 and not int(b[1:]) % 2}
    assert {(r.buyer_id, r.supplier_id, r.hs_code) for r in got.collect()} == want and got.count() == len(want)


def test_containment_of_patterns_of_all_widths(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abc é", k=rng.randint(1, 40))) for _ in range(150)] + ["", "a" * 60, "common name of all " * 2]
    longs = words + [f"common name of all {w}" for w in words[:60]]
    patterns = words[:80] + [w[2:2 + rng.randint(1, 20)] for w in longs] + ["", "not there at all", "A" * 12]
    got = enrich.contains_pairs(spark.createDataFrame([(w,) for w in longs], "t string"), "t", spark.createDataFrame([(w,) for w in patterns], "t string"), "t")
    low, pat = {w.lower() for w in longs if w}, {p.lower() for p in patterns if p}
    assert {tuple(r) for r in got.collect()} == {(a, b) for a in low for b in pat if b in a}
    none = spark.createDataFrame([], "t string")
    assert enrich.contains_pairs(none, "t", none, "t").count() == 0


def test_permissions_are_those_of_a_walk_up_the_tree(spark):
    rng = random.Random(12)
    parent = {"scope:global": None}
    for n in range(40):
        parent[f"scope:{rng.choice(['account', 'org', 'group', 'store'])}:{n}"] = rng.choice(list(parent))
    parent["scope:org:loop1"], parent["scope:org:loop2"] = "scope:org:loop2", "scope:org:loop1"
    names = list(parent)
    plain_rules, policies, overrides = [], [], []
    holders = {f"scope:account:{n}": {rng.choice(["buyer", "admin"])} for n in range(40)}
    for n in range(150):
        scope, permission, effect = rng.choice(names), f"p{rng.randrange(4)}", rng.choice(["allow", "deny"])
        if n % 2:
            policies.append((f"r{n}", permission, effect, scope))
            plain_rules.append((scope, permission, 2, effect, f"r{n}"))
        else:
            role, account = rng.choice([None, "buyer", "admin"]), rng.choice([None, rng.choice(names)])
            overrides.append((f"r{n}", permission, effect, scope, role, account))
            if role is None:
                plain_rules.append((scope, permission, 1, effect, f"r{n}"))
            elif account and role in holders.get(account, ()):
                plain_rules.append((account, permission, 0, effect, f"r{n}"))
    want = set()
    for scope in names:
        for permission in {r[1] for r in plain_rules}:
            at, distance, seen = scope, 0, set()
            while at and at not in seen:
                seen.add(at)
                own = sorted((place, effect != "deny", rule, effect) for s, p, place, effect, rule in plain_rules if s == at and p == permission)
                if own:
                    want.add((scope, permission, own[0][3], distance, own[0][2], own[0][0] < 2))
                    break
                at, distance = parent[at], distance + 1
    got = governance.resolved_permissions(
        spark.createDataFrame(list(parent.items()), "scope_id string, parent_id string"),
        spark.createDataFrame(policies, "policy_id string, permission string, effect string, scope_id string"),
        spark.createDataFrame(overrides, "policy_id string, permission string, effect string, scope_id string, role string, account_scope string"),
        spark.createDataFrame([(a.removeprefix("scope:account:"), r.upper()) for a, rs in holders.items() for r in rs], "account_id string, role string"))
    assert {tuple(r) for r in got.collect()} == want


def test_rules_say_yes_and_no_in_several_columns(spark):
    data = [(1, "deny", None, None, None), (2, "", "0", "1", None), (3, None, "1", None, None), (4, None, None, "False", None), (5, None, "", None, "0"), (6, None, None, None, None)]
    df = spark.createDataFrame(data, "id int, effect string, deny string, is_allowed string, allow string").withColumns({
        "module": F.lit("m"), "action": F.lit(""), "organization_group_id": F.when(F.col("id") == 1, 7), "store_id": F.when(F.col("id") == 2, "s")})
    got = governance.policies(df)
    assert [r.effect for r in got.where("scope_id = 'scope:global'").join(
        df.select(F.col("id"), governance.stable_id(F.lit("policy_rule"), F.lit("permissions"), F.col("id")).alias("policy_id")), "policy_id").orderBy("id").collect()] == [
        "deny", "allow", "deny", "deny", "deny", "allow"]
    assert {r.scope_id for r in got.collect()} == {"scope:global", "scope:group:7", "scope:store:s"}
    over = governance.overrides(spark.createDataFrame([(1, None, " Admin ", 3), (2, "", None, None), (3, "1", "", 4)], "id int, is_allowed string, role string, user_id int").withColumns({
        "module": F.lit(None).cast("string"), "action": F.lit("x")}))
    assert rows(over.where("scope_id = 'scope:global'").select("permission", "effect", "role", "account_scope")) == sorted([
        ("general:x", "allow", "admin", "scope:account:3"), ("general:x", "deny", None, None), ("general:x", "allow", None, "scope:account:4")], key=repr)
