"""Rules, confidence gates, contexts and permissions over entities."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.ids import stable_id
from leadloom.functions.skew import grid_join
from leadloom.functions.values import choose, first_non_empty, non_empty, text
from leadloom.session import staged

# Confidence words and role fallbacks.
GATE_WORDS = [(["high", "very high"], 0.9), (["medium"], 0.7), (["low"], 0.5)]
ROLE_COLUMNS = ["default_role", "user_type", "account_type", "role", "role_name"]
FALSE_WORDS = ["0", "false", "False", ""]


def parse_gate(gate: Column) -> Column:
    """A confidence gate (``>=0.95``, ``High``, ``0.7``) as a number; null when it says nothing."""
    word = F.lower(F.trim(gate))
    number = F.nullif(F.regexp_extract(gate, r"([\d.]+)", 1), F.lit("")).try_cast("double")
    return choose([(word.isin(*names), value) for names, value in GATE_WORDS], number)


def confidence_gate(instances: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Instances (entity, id, confidence) with the gate of their entity type and whether they pass; no gate, pass."""
    gates = taxonomy.select("entity", parse_gate(F.col("gate")).alias("required"))
    return instances.join(gates, "entity", "left").withColumn(
        "passed", F.coalesce(F.col("confidence") >= F.col("required"), F.lit(True)))


def validate_entities(instances: DataFrame, entity: str, key: str, rules: Sequence[tuple[str, str, float]]) -> DataFrame:
    """Result rows of rule predicates (rule_id, SQL expression, threshold) on every instance of one entity.

    A rule that holds gives the threshold as confidence, else half of it and a review mark. A
    null predicate does not hold. All rules run in one pass over the instances.
    """
    def one(rule_id: str, predicate: str, threshold: float) -> Column:
        ok = F.coalesce(F.expr(predicate), F.lit(False))
        return F.struct(F.lit(rule_id).alias("rule_id"), ok.alias("check_passed"), (~ok).alias("needs_review"),
                        F.when(ok, threshold).otherwise(threshold / 2).alias("confidence"))
    rows = instances.select(F.col(key).cast("string").alias("instance_id"), F.explode(F.array(*[one(*r) for r in rules])).alias("r"))
    return rows.select(
        stable_id(F.lit("rule_result"), F.col("r.rule_id"), F.lit(entity), F.col("instance_id")).alias("result_id"),
        F.lit(entity).alias("entity"), "instance_id", "r.*")


def governance_chain(taxonomy: DataFrame, subtypes: DataFrame, entities: DataFrame, rules: DataFrame) -> DataFrame:
    """Taxonomy -> subtype -> entity -> rule as one linked table; levels without children stay."""
    return (taxonomy.select("taxonomy", "gate").join(subtypes.select("taxonomy", "subtype"), "taxonomy", "left")
            .join(entities.select("subtype", "entity"), "subtype", "left")
            .join(rules.select("entity", "rule_id", "predicate"), "entity", "left")
            .select("taxonomy", "gate", "subtype", "entity", "rule_id", "predicate"))


def contexts(accounts: DataFrame, account_orgs: DataFrame, orgs: DataFrame, stores: DataFrame) -> DataFrame:
    """The hats of an account: itself, each organisation it owns, each store of those; role by fallback."""
    role = first_non_empty(*[c for c in ("default_role", "user_type", "account_type") if c in accounts.columns])
    who = accounts.select("account_id", F.col("name").alias("a_name"), role.alias("role"))
    owned = account_orgs.join(who, "account_id").join(orgs.select("org_id", F.col("name").alias("o_name")), "org_id")

    def hat(rows: DataFrame, kind: str, ident: Column, name: Column, default_role: str, org: Column, store: Column) -> DataFrame:
        return rows.select(F.concat(F.lit(f"ctx:{kind}:"), ident).alias("context_id"),
                           F.lit({"org": "organization"}.get(kind, kind)).alias("context_type"), name.alias("name"),
                           F.coalesce("role", F.lit(default_role)).alias("role_name"), "account_id", org.alias("org_id"), store.alias("store_id"))
    nothing = F.lit(None).cast("string")
    pair = F.concat(F.col("account_id"), F.lit(":"), F.col("org_id"))
    shops = owned.join(stores.select("org_id", "store_id", "slug"), "org_id")
    return (hat(who, "account", F.col("account_id"), F.coalesce(non_empty("a_name"), F.lit("Account Context")), "account_owner", nothing, nothing)
            .unionByName(hat(owned, "org", pair, F.coalesce(non_empty("o_name"), non_empty("a_name"), F.lit("Organization Hat")),
                             "organization_operator", F.col("org_id"), nothing))
            .unionByName(hat(shops, "store", F.concat(F.col("account_id"), F.lit(":"), F.col("store_id")),
                             F.coalesce(non_empty("slug"), non_empty("o_name"), F.lit("Store Hat")), "store_operator",
                             F.col("org_id"), F.col("store_id"))))


def roles(accounts: DataFrame) -> DataFrame:
    """(account_id, role): distinct roles of five columns ignoring case; account_user when there is none."""
    named = F.filter(F.array(*[F.lower(F.trim(text(c))) if c in accounts.columns else F.lit("") for c in ROLE_COLUMNS]),
                     lambda r: r != "")
    return accounts.select("account_id", F.explode(F.when(F.size(named) > 0, F.array_distinct(named)).otherwise(
        F.array(F.lit("account_user")))).alias("role"))


def scopes(accounts: DataFrame, groups: DataFrame, orgs: DataFrame, stores: DataFrame) -> DataFrame:
    """(scope_id, scope_type, parent_id): accounts and groups under global, organisations under groups, stores under organisations."""
    top = F.lit("scope:global")

    def scope(kind: str, key: str) -> Column:
        return F.concat(F.lit(f"scope:{kind}:"), F.col(key).cast("string"))
    first = accounts.select(scope("account", "account_id").alias("scope_id"), F.lit("account").alias("scope_type"), top.alias("parent_id"))
    rest = [groups.select(scope("group", "group_id").alias("scope_id"), F.lit("organization_group").alias("scope_type"), top.alias("parent_id")),
            orgs.select(scope("org", "org_id").alias("scope_id"), F.lit("organization").alias("scope_type"),
                        F.when(F.col("group_id").isNotNull(), scope("group", "group_id")).otherwise(top).alias("parent_id")),
            stores.select(scope("store", "store_id").alias("scope_id"), F.lit("store").alias("scope_type"), scope("org", "org_id").alias("parent_id"))]
    for part in rest:
        first = first.unionByName(part)
    return first


REACHED = 500_000  # rows of a part
SCOPE_COLUMNS = (("account", "user_id"), ("org", "organization_id"), ("group", "organization_group_id"), ("store", "store_id"))


def _permission() -> Column:
    return F.concat(F.coalesce(non_empty("module"), F.lit("general")), F.lit(":"), F.coalesce(non_empty("action"), F.lit("access")))


def _said(rows: DataFrame, name: str, yes: str, no: str) -> Column:
    """What a yes/no column says; null where it is absent or empty."""
    if name not in rows.columns:
        return F.lit(None).cast("string")
    said = F.trim(F.col(name).cast("string"))
    return F.when(non_empty(name).isNotNull(), F.when(said.isin(*FALSE_WORDS), no).otherwise(yes))


def _applies(rows: DataFrame) -> Column:
    """The scopes a rule applies to: everywhere, and the account, organisation, group and store it names."""
    named = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"scope:{k}:"), F.col(c).cast("string"))) for k, c in SCOPE_COLUMNS if c in rows.columns]
    return F.filter(F.array(F.lit("scope:global"), *named), lambda s: s.isNotNull())


def policies(rows: DataFrame) -> DataFrame:
    """Policy rules with permission id, effect (from effect, deny, is_allowed or allow, the first that says something, else
    allow) and the scopes they apply to."""
    effect = F.coalesce(non_empty("effect") if "effect" in rows.columns else F.lit(None).cast("string"), _said(rows, "deny", "deny", "allow"),
                        _said(rows, "is_allowed", "allow", "deny"), _said(rows, "allow", "allow", "deny"), F.lit("allow"))
    named = rows.withColumns({"permission": _permission(), "effect": effect})
    return named.select(
        stable_id(F.lit("policy_rule"), F.lit("permissions"), F.col("id")).alias("policy_id"),
        stable_id(F.lit("permission"), F.col("permission")).alias("permission_id"), "permission", "effect",
        F.explode(_applies(rows)).alias("scope_id"))


def overrides(rows: DataFrame) -> DataFrame:
    """Overrides of permissions: as ``policies``, with the role they name (lower case, else null) and the account it is meant for.

    The effect is what ``effect`` says, else what ``is_allowed`` says: an empty one denies, an absent one allows.
    """
    said = F.trim(F.col("is_allowed").cast("string")) if "is_allowed" in rows.columns else F.lit(None).cast("string")
    effect = F.coalesce(non_empty("effect") if "effect" in rows.columns else F.lit(None).cast("string"),
                        F.when(F.coalesce(said.isin(*FALSE_WORDS), F.lit(False)), "deny").otherwise("allow"))
    role = first_non_empty(*[c for c in ("role_name", "role") if c in rows.columns]) if {"role_name", "role"} & set(rows.columns) else F.lit(None)
    named = rows.withColumns({"permission": _permission(), "effect": effect, "_role": F.lower(F.trim(role.cast("string")))})
    return named.select(
        stable_id(F.lit("override"), F.lit("custom_role_permission_overrides"), F.col("id")).alias("policy_id"),
        stable_id(F.lit("permission"), F.col("permission")).alias("permission_id"), "permission", "effect",
        F.explode(_applies(rows)).alias("scope_id"), non_empty("_role").alias("role"),
        F.when(F.col("user_id").isNotNull(), F.concat(F.lit("scope:account:"), F.col("user_id").cast("string"))).alias("account_scope"))


def capabilities(packages: DataFrame) -> DataFrame:
    """(capability_id, name) of feature packages: name, title, slug, else the id."""
    named = first_non_empty(*[c for c in ("name", "title", "slug") if c in packages.columns])
    key = F.col("id").cast("string")
    return packages.where("id IS NOT NULL").select(key.alias("capability_id"), F.coalesce(named, F.concat(F.lit("capability:"), key)).alias("name"))


def enabled_capabilities(plans: DataFrame, known: DataFrame, account_orgs: DataFrame) -> DataFrame:
    """(owner_kind, owner_id, capability_id): what the plan of an account enables, for it and for the organisations it owns."""
    bought = plans.select(F.col("user_id").cast("string").alias("account_id"),
                          F.coalesce("plan_id", "feature_package_id").cast("string").alias("capability_id")).where(
        "account_id IS NOT NULL").distinct().join(known.select("capability_id"), "capability_id")
    orgs = bought.join(account_orgs, "account_id").select(F.lit("organization").alias("owner_kind"), F.col("org_id").alias("owner_id"), "capability_id")
    return bought.select(F.lit("account").alias("owner_kind"), F.col("account_id").alias("owner_id"), "capability_id").unionByName(orgs).distinct()


def scope_closure(scope_rows: DataFrame) -> DataFrame:
    """(scope_id, ancestor, distance): every scope with itself (0) and all above it, by the shortest way.

    Built level by level over distinct pairs until a level adds none, so depth is free and a loop ends. A level is written
    once, and only what it adds is looked up in the next.
    """
    parents = staged(scope_rows.where("parent_id IS NOT NULL").select(F.col("scope_id").alias("ancestor"), F.col("parent_id").alias("above")).distinct(), "parents")
    level = staged(scope_rows.select("scope_id", F.col("scope_id").alias("ancestor")).distinct().withColumn("distance", F.lit(0)), "closure")
    closure, distance = level, 0
    while not level.isEmpty():
        distance += 1
        above = level.join(parents, "ancestor").select("scope_id", F.col("above").alias("ancestor")).distinct()
        level = staged(above.join(closure, ["scope_id", "ancestor"], "left_anti").withColumn("distance", F.lit(distance)), "level")
        closure = closure.unionByName(level)
    return closure


def _reached(closure: DataFrame, rules: DataFrame) -> DataFrame:
    """Every scope with the rules of all its ancestors, dealt into parts of about ``REACHED`` rows by scope and permission.

    All scopes lie below one, so that one is cut up (``grid_join``), and the parts are counted from the rows that come out:
    few rows go in, so their size would give a few parts, whose aggregation grows with the number of scopes.
    """
    met = closure.groupBy("ancestor").agg(F.count(F.lit(1)).alias("l")).join(rules.groupBy("ancestor").agg(F.count(F.lit(1)).alias("r")), "ancestor")
    found = met.agg(F.sum(F.col("l") * F.col("r"))).first()[0] or 0
    return grid_join(closure, rules, ["ancestor"]).repartition(max(1, ceil(found / REACHED)), "scope_id", "permission")


def resolved_permissions(scope_rows: DataFrame, policy_rows: DataFrame, override_rows: DataFrame, role_rows: DataFrame) -> DataFrame:
    """(scope_id, permission, effect, distance, policy_id, is_override): the one rule that decides a permission in a scope.

    The rule applied nearest counts: to the scope itself before those above it. At one distance an override for a role comes
    before a general override and that before a policy, and a deny before an allow; then the smallest rule id. An override that
    names a role counts only in the scope of the account it is meant for, and only if that account holds the role.
    """
    general = override_rows.where("role IS NULL").select("scope_id", "permission", "effect", "policy_id", F.lit(1).alias("place"))
    holders = role_rows.select(F.concat(F.lit("scope:account:"), F.col("account_id").cast("string")).alias("account_scope"), F.lower("role").alias("role")).distinct()
    by_role = override_rows.where("role IS NOT NULL AND account_scope IS NOT NULL").select(
        "account_scope", "role", "permission", "effect", "policy_id").distinct().join(holders, ["account_scope", "role"]).select(
        F.col("account_scope").alias("scope_id"), "permission", "effect", "policy_id", F.lit(0).alias("place"))
    rules = policy_rows.select("scope_id", "permission", "effect", "policy_id", F.lit(2).alias("place")).unionByName(general).unionByName(by_role)
    # of the rules of one scope and permission only the first can decide
    order = F.struct("place", (F.col("effect") != "deny").alias("allows"), "policy_id", "effect")
    first = rules.groupBy("scope_id", "permission").agg(F.min(order).alias("r")).withColumnRenamed("scope_id", "ancestor")
    reached = _reached(scope_closure(scope_rows), staged(first, "rules"))
    best = reached.groupBy("scope_id", "permission").agg(F.min(F.struct("distance", "r")).alias("b"))
    return best.select("scope_id", "permission", F.col("b.r.effect").alias("effect"), F.col("b.distance").alias("distance"),
                       F.col("b.r.policy_id").alias("policy_id"), (F.col("b.r.place") < 2).alias("is_override"))


def effective_permissions(scope_rows: DataFrame, policy_rows: DataFrame) -> DataFrame:
    """(scope_id, permission, effect): a scope inherits its ancestors' rules; one deny outweighs any allow."""
    rules = policy_rows.groupBy("scope_id", "permission").agg(F.max((F.col("effect") == "deny")).alias("denied"))
    return _reached(scope_closure(scope_rows), staged(rules.withColumnRenamed("scope_id", "ancestor"), "rules")).groupBy(
        "scope_id", "permission").agg(F.when(F.max("denied"), "deny").otherwise("allow").alias("effect"))
