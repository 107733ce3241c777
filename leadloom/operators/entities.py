"""Entity tables and edge tables from source rows, by specification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.ids import stable_id
from leadloom.functions.skew import grid_join
from leadloom.functions.values import first_present, non_empty, text
from leadloom.operators.layers import family_tree_edges
from leadloom.session import staged


@dataclass(frozen=True)
class Entity:
    """Key column name, accepted source key columns, key prefix, and output column -> accepted columns."""

    key: str
    from_columns: tuple[str, ...]
    columns: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    prefix: str = ""
    dates: tuple[str, ...] = ()


@dataclass(frozen=True)
class Edge:
    """Edge type between two entities and the source columns that hold the two keys."""

    kind: str
    src: str
    src_columns: tuple[str, ...]
    dst: str
    dst_columns: tuple[str, ...]
    zero_is_none: bool = False


# Entities, their keys and accepted column names.
ENTITIES = {
    "Person": Entity("personId", ("id", "person_id"), {"name": ("name", "full_name"), "email": ("email",)}),
    "Account": Entity("accountId", ("id", "user_id"), {"name": ("name", "full_name", "username"), "email": ("email",),
                                                       "default_role": ("default_role", "user_type", "account_type")}),
    "OrganizationGroup": Entity("groupId", ("id", "group_id"), {"name": ("name",)}),
    "Organization": Entity("orgId", ("id", "org_id"), {"name": ("name", "company_name"), "website": ("website", "domain", "url"),
                                                       "email": ("email", "company_email"), "country": ("country",)}),
    "Store": Entity("storeId", ("id", "org_id"), {"slug": ("slug",)}, prefix="store:"),
    "Category": Entity("categoryId", ("id", "category_id"), {"name": ("name", "title"), "slug": ("slug",)}),
    "Brand": Entity("brandId", ("id", "brand_id"), {"name": ("name", "brand_name", "slug")}),
    "Product": Entity("productId", ("id", "product_id"), {"name": ("name", "title", "product_name"), "sku": ("sku",),
                                                          "price": ("price", "unit_price")}),
    "ProductApplication": Entity("appId", ("id",), {"name": ("name", "title")}),
    "UseCase": Entity("useCaseId", ("id",), {"name": ("name", "title")}),
    "Facility": Entity("facilityId", ("id", "facility_id"), {"name": ("name",), "country": ("country",)}),
    "SubscriptionPlan": Entity("planId", ("id",), {"name": ("name", "package_name")}),
    "Subscription": Entity("subscriptionId", ("id",), {"status": ("status",)}),
    "PipelineStage": Entity("stageId", ("id", "stage_id"), {"name": ("name", "stage_name")}),
    "RFQ": Entity("rfqId", ("id", "rfq_id"), {"status": ("status",), "title": ("title",)}, dates=("created_at",)),
    "Lead": Entity("leadId", ("id", "lead_id"), {"status": ("status", "statusId"), "message": ("message",)}, dates=("created_at",)),
    "Deal": Entity("dealId", ("id", "deal_id"), {"name": ("deal_name", "name"), "amount": ("amount",), "status": ("status",)}, dates=("created_at",)),
    "DealLeg": Entity("dealLegId", ("id",), {"quantity": ("quantity",), "price": ("price", "unit_price")}),
    "Thread": Entity("threadId", ("id", "thread_id"), {"subject": ("subject", "title")}, dates=("created_at",)),
    "Task": Entity("taskId", ("id", "task_id"), {"title": ("title", "task_name"), "status": ("status",)}),
    "PageView": Entity("pageViewId", ("id",), {"pageName": ("page_name", "type"), "timeSpent": ("stay_on_page", "time_spent")}, dates=("created_at",)),
    "Session": Entity("sessionId", ("session_id", "id"), {"userAgent": ("user_agent",), "ipAddress": ("ip_address", "ip")}, dates=("created_at",)),
    "Meeting": Entity("meetingId", ("id", "meeting_id"), {"title": ("title",), "status": ("status",)}),
    "ScoringRule": Entity("ruleId", ("id",), {"name": ("name", "rule_name")}),
    "FAQ": Entity("faqId", ("id",), {"question": ("question",), "answer": ("answer",)}),
    "Keyword": Entity("keywordId", ("id", "keyword_id"), {"name": ("name", "keyword")}),
}
# Edges and the source columns of their ends.
EDGES = [
    Edge("OWNS", "Person", ("person_id",), "Account", ("id", "user_id")),
    Edge("MEMBER_OF_GROUP", "Organization", ("id", "org_id"), "OrganizationGroup", ("group_id", "organization_group_id")),
    Edge("OWNS", "Account", ("user_id", "owner_id"), "Organization", ("id", "org_id")),
    Edge("OWNS", "Organization", ("id", "org_id"), "Store", ("id", "org_id")),
    Edge("IS_SUBCATEGORY_OF", "Category", ("id",), "Category", ("parent_id", "parent_category_id"), zero_is_none=True),
    Edge("OWNED_BY", "Brand", ("id",), "Organization", ("organization_id", "org_id")),
    Edge("HAS_CATEGORY", "Product", ("id",), "Category", ("category_id",)),
    Edge("HAS_BRAND", "Product", ("id",), "Brand", ("brand_id",)),
    Edge("OWNS", "Account", ("user_id", "seller_user_id"), "Product", ("id",)),
    Edge("SUPPLIED_BY", "Product", ("id",), "Organization", ("organization_id", "org_id", "supplier_id")),
    Edge("HAS_APPLICATION", "Product", ("product_id",), "ProductApplication", ("id",)),
    Edge("HAS_USE_CASE", "Product", ("product_id",), "UseCase", ("id", "use_case_id")),
    Edge("HAS_FACILITY", "Organization", ("organization_id", "org_id"), "Facility", ("id",)),
    Edge("HAS_SUBSCRIPTION", "Account", ("user_id",), "Subscription", ("id",)),
    Edge("ON_PLAN", "Subscription", ("id",), "SubscriptionPlan", ("plan_id", "feature_package_id")),
    Edge("CREATES", "Account", ("user_id",), "RFQ", ("id", "rfq_id")),
    Edge("BUYER_ACCOUNT", "Lead", ("id", "lead_id"), "Account", ("buyer_id", "user_id")),
    Edge("SELLER_ACCOUNT", "Lead", ("id", "lead_id"), "Account", ("seller_id",)),
    Edge("HAS_DEAL", "Lead", ("lead_id",), "Deal", ("id", "deal_id")),
    Edge("OWNS_DEAL", "Account", ("deal_owner", "user_id"), "Deal", ("id",)),
    Edge("IN_STAGE", "Deal", ("id",), "PipelineStage", ("stage_id", "deal_stage_id")),
    Edge("HAS_LEG", "Deal", ("deal_id",), "DealLeg", ("id",)),
    Edge("TARGETS", "DealLeg", ("id",), "Product", ("product_id",)),
    Edge("HAS_THREAD", "Lead", ("lead_id",), "Thread", ("id", "thread_id")),
    Edge("HAS_TASK", "Lead", ("lead_id",), "Task", ("id", "task_id")),
    Edge("HAS_PAGEVIEW", "Session", ("session_id",), "PageView", ("id",)),
    Edge("GENERATED", "Account", ("user_id",), "PageView", ("id",)),
    Edge("TARGETS_SELLER", "PageView", ("id",), "Organization", ("seller_id",)),
    Edge("TARGETS", "PageView", ("id",), "Product", ("product_id",)),
    Edge("IN_CATEGORY", "PageView", ("id",), "Category", ("category_id",)),
    Edge("HAS_SESSION", "Account", ("user_id",), "Session", ("session_id", "id")),
    Edge("HAS_MEETING", "Lead", ("lead_id",), "Meeting", ("id", "meeting_id")),
    Edge("USES_SCORING_RULE", "Lead", ("lead_id",), "ScoringRule", ("id", "rule_id")),
]


def _key(rows: DataFrame, entity: Entity, names: Sequence[str]) -> Column:
    value = F.trim(first_present(rows, names))
    return F.when(value != "", F.concat(F.lit(entity.prefix), value))


def entity_nodes(rows: DataFrame, label: str, source: str) -> DataFrame:
    """One node per key: the key as text, listed columns by first non-empty alias, ISO dates, source tag.

    Rows without key are dropped; several rows of one key give the largest value per column.
    """
    spec = ENTITIES[label]
    named = {out: first_present(rows, names) for out, names in spec.columns.items()}
    if label == "Person":
        both = F.trim(F.concat_ws(" ", first_present(rows, ["first_name"]), first_present(rows, ["last_name"])))
        named["name"] = F.coalesce(named["name"], F.nullif(both, F.lit("")))
    for date in spec.dates:
        named[date] = F.date_format(first_present(rows, [date], "timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    picked = rows.select(_key(rows, spec, spec.from_columns).alias(spec.key), *[c.alias(n) for n, c in named.items()])
    return picked.where(F.col(spec.key).isNotNull()).groupBy(spec.key).agg(*[F.max(n).alias(n) for n in named]).withColumn(
        "source", F.lit(source))


def account_emails(accounts: DataFrame) -> DataFrame:
    """E-mail nodes of accounts with the HAS_EMAIL edge: (accountId, emailId, email)."""
    rows = accounts.select("accountId", F.lower(F.trim("email")).alias("email")).where("email <> ''")
    return rows.select("accountId", stable_id(F.lit("email"), F.col("email")).alias("emailId"), "email").distinct()


def entity_edges(rows: DataFrame, edge: Edge, src_nodes: DataFrame, dst_nodes: DataFrame,
                 props: Mapping[str, Column] | None = None) -> DataFrame:
    """(src, kind, dst) of one edge type whose two ends exist; '' is no end, nor is 0 where the edge says so."""
    src_spec, dst_spec = ENTITIES[edge.src], ENTITIES[edge.dst]
    pairs = rows.select(_key(rows, src_spec, edge.src_columns).alias("src"), _key(rows, dst_spec, edge.dst_columns).alias("dst"),
                        *[c.alias(n) for n, c in (props or {}).items()])
    pairs = pairs.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).dropDuplicates(["src", "dst"])
    if edge.zero_is_none:
        pairs = pairs.where(F.col("dst") != "0")
    return (pairs.join(src_nodes.select(F.col(src_spec.key).alias("src")), "src", "left_semi")
            .join(dst_nodes.select(F.col(dst_spec.key).alias("dst")), "dst", "left_semi")
            .select("src", F.lit(edge.kind).alias("kind"), "dst", *(props or {})))


def split_keywords(*columns: Column | str) -> Column:
    """Distinct words of texts split at bar, comma, semicolon or newline, trimmed; first spelling and order kept."""
    joined = F.concat_ws("\n", *[text(c) for c in columns])
    words = F.filter(F.transform(F.split(joined, r"[|,;\n]+"), lambda w: F.trim(w)), lambda w: w != "")
    lower = F.transform(words, lambda w: F.lower(w))
    return F.filter(words, lambda w, i: F.array_position(lower, F.lower(w)) == i + 1)


def keyword_nodes(rows: DataFrame, key: str, words: Column) -> DataFrame:
    """(key, keyword_id, keyword): the keyword id is the stable id of the lower-cased word."""
    return rows.select(key, F.explode(words).alias("keyword")).select(
        key, stable_id(F.lit("keyword"), F.lower("keyword")).alias("keyword_id"), F.lower("keyword").alias("keyword")).distinct()


def keyword_use_cases(product_words: DataFrame, use_case_words: DataFrame) -> DataFrame:
    """Distinct (product_id, use_case_id) that share a keyword; a keyword is cut up by how many of either have it."""
    left = staged(product_words.select("product_id", "keyword_id").distinct(), "product_words")
    right = staged(use_case_words.select("use_case_id", "keyword_id").distinct(), "use_case_words")
    return grid_join(left, right, ["keyword_id"]).select("product_id", "use_case_id").distinct()


def seller_products(owned_products: DataFrame, owned_orgs: DataFrame) -> DataFrame:
    """(org, product): an account that owns both makes its organisation sell the product."""
    return owned_products.join(owned_orgs, "account_id").select("org_id", "product_id").distinct()


def category_tree(categories: DataFrame) -> DataFrame:
    """Every category with its root, parent and depth from (id, parent_id, name); parent 0 or null is a root."""
    edges = categories.select(F.col("id").alias("node"), F.coalesce("parent_id", F.lit(0)).alias("parent"), "name")
    return family_tree_edges(edges).select("root", "node", "parent", "name", "level")


def classify_accounts(accounts: DataFrame, sellers: DataFrame, rfqs: DataFrame, owners: DataFrame) -> DataFrame:
    """(entity, id, label): Seller and Buyer on accounts, passed on to the persons that own them."""
    labels = sellers.select(F.col("user_id").cast("string").alias("account_id"), F.lit("Seller").alias("label")).unionByName(
        rfqs.select(F.col("user_id").cast("string").alias("account_id"), F.lit("Buyer").alias("label"))).where(
        "account_id is not null").distinct().join(accounts.select("account_id"), "account_id", "left_semi")
    persons = labels.join(owners, "account_id").select(F.lit("Person").alias("entity"), F.col("person_id").alias("id"), "label").distinct()
    return labels.select(F.lit("Account").alias("entity"), F.col("account_id").alias("id"), "label").unionByName(persons)


def derived_units(products: DataFrame) -> DataFrame:
    """(product_id, unit_id, unit, price, currency): the unit and price of every product that has either; the id is of both.

    Products of one unit and price share the node; its currency is the largest of theirs.
    """
    currency = F.col("currency_id").cast("string") if "currency_id" in products.columns else F.lit(None).cast("string")
    unit, price = non_empty(F.trim(text("unit"))), F.col("price").cast("string")
    rows = products.select("product_id", unit.alias("unit"), non_empty(price).alias("price"), currency.alias("currency")).where(
        "unit IS NOT NULL OR price IS NOT NULL").withColumn("unit_id", stable_id(F.lit("unit"), text("unit"), text("price")))
    nodes = rows.groupBy("unit_id").agg(F.max("currency").alias("currency"))
    return rows.select("product_id", "unit_id", "unit", "price").distinct().join(nodes, "unit_id")


def derived_pipelines(deals: DataFrame, owners: DataFrame) -> DataFrame:
    """Edges (src, kind, dst) of pipelines seen on deals: deal in, owner's organisation, stages seen together."""
    rows = deals.where("pipeline_id is not null")
    pipe = F.col("pipeline_id").cast("string")
    parts = [
        rows.select(F.col("deal_id").cast("string").alias("src"), F.lit("IN_PIPELINE").alias("kind"), pipe.alias("dst")),
        rows.where("stage_id is not null").select(pipe.alias("src"), F.lit("HAS_STAGE").alias("kind"), F.col("stage_id").cast("string").alias("dst")),
        rows.join(owners, "account_id").select(F.col("org_id").cast("string").alias("src"), F.lit("OWNS_PIPELINE").alias("kind"), pipe.alias("dst"))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


