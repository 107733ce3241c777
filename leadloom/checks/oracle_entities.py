"""Source rows of all entities and edges, and the DuckDB statements of their nodes and edges.

The entities, the columns they are read from and the ends of the edges are written here again, as the sources have them.
"""

# label, key column in the source, key prefix; then source column > node column (a date marked @).
NODES = """
Person person_id - full_name>name email>email
Account id - username>name email>email user_type>default_role
OrganizationGroup group_id - name>name
Organization org_id - company_name>name domain>website company_email>email country>country
Store org_id store: slug>slug
Category category_id - title>name slug>slug
Brand brand_id - brand_name>name
Product product_id - product_name>name sku>sku unit_price>price
ProductApplication id - title>name
UseCase id - title>name
Facility facility_id - name>name country>country
SubscriptionPlan id - package_name>name
Subscription id - status>status
PipelineStage stage_id - stage_name>name
RFQ rfq_id - status>status title>title created_at>created_at@
Lead lead_id - statusId>status message>message created_at>created_at@
Deal deal_id - deal_name>name amount>amount status>status created_at>created_at@
DealLeg id - quantity>quantity unit_price>price
Thread thread_id - title>subject created_at>created_at@
Task task_id - task_name>title status>status
PageView id - type>pageName time_spent>timeSpent created_at>created_at@
Session session_id - user_agent>userAgent ip>ipAddress created_at>created_at@
Meeting meeting_id - title>title status>status
ScoringRule id - rule_name>name
FAQ id - question>question answer>answer
Keyword keyword_id - keyword>name
"""
# kind, source entity and column, target entity and column; 0 is no target where marked.
EDGES = """
OWNS Person person_id Account user_id
MEMBER_OF_GROUP Organization org_id OrganizationGroup organization_group_id
OWNS Account owner_id Organization org_id
OWNS Organization org_id Store org_id
IS_SUBCATEGORY_OF Category id Category parent_category_id zero
OWNED_BY Brand id Organization org_id
HAS_CATEGORY Product id Category category_id
HAS_BRAND Product id Brand brand_id
OWNS Account seller_user_id Product id
SUPPLIED_BY Product id Organization supplier_id
HAS_APPLICATION Product product_id ProductApplication id
HAS_USE_CASE Product product_id UseCase use_case_id
HAS_FACILITY Organization org_id Facility id
HAS_SUBSCRIPTION Account user_id Subscription id
ON_PLAN Subscription id SubscriptionPlan feature_package_id
CREATES Account user_id RFQ rfq_id
BUYER_ACCOUNT Lead lead_id Account buyer_id
SELLER_ACCOUNT Lead lead_id Account seller_id
HAS_DEAL Lead lead_id Deal deal_id
OWNS_DEAL Account deal_owner Deal id
IN_STAGE Deal id PipelineStage deal_stage_id
HAS_LEG Deal deal_id DealLeg id
TARGETS DealLeg id Product product_id
HAS_THREAD Lead lead_id Thread thread_id
HAS_TASK Lead lead_id Task task_id
HAS_PAGEVIEW Session session_id PageView id
GENERATED Account user_id PageView id
TARGETS_SELLER PageView id Organization seller_id
TARGETS PageView id Product product_id
IN_CATEGORY PageView id Category category_id
HAS_SESSION Account user_id Session session_id
HAS_MEETING Lead lead_id Meeting meeting_id
USES_SCORING_RULE Lead lead_id ScoringRule rule_id
"""
NODE_LINES = [line.split() for line in NODES.split("\n") if line]
EDGE_LINES = [line.split() for line in EDGES.split("\n") if line]


def _rows(n: int, line: list[str]) -> str:
    """Rows of one source: some keys twice, some blank or null, some values empty."""
    key, columns = line[1], [c.rstrip("@").split(">")[0] for c in line[3:]]
    made = []
    for i, (name, spec) in enumerate(zip(columns, line[3:])):
        if spec.endswith("@"):
            made.append(f"TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * (k + {n}) AS {name}")
        else:
            made.append(f"CASE WHEN (k + {i + n}) % 6 = 0 THEN '' WHEN (k + {i}) % 11 = 0 THEN NULL ELSE '{name} ' || CAST((k * {i + 3} + {n}) % 50 AS STRING) END AS {name}")
    return (f"SELECT CASE WHEN k % 13 = 0 THEN ' ' WHEN k % 17 = 0 THEN NULL ELSE CAST(k % {120 + n} AS STRING) END AS {key}, {', '.join(made)} "
            "FROM (SELECT CAST(c_custkey AS BIGINT) AS k FROM {customer}) AS q")


def _pairs(n: int, line: list[str]) -> str:
    """Rows that hold both ends: repeated, unknown, zero and null ones among them."""
    a, b = line[2], line[4]
    return (f"SELECT CASE WHEN k % 19 = 0 THEN NULL ELSE CAST(k % 90 AS STRING) END AS {a}, CASE WHEN k % 23 = 0 THEN '' ELSE CAST((k * 7 + {n}) % 140 AS STRING) END AS {b if b != a else b + '_2'} "
            "FROM (SELECT CAST(o_orderkey AS BIGINT) AS k FROM {orders} WHERE o_orderkey % 4 = 0) AS q")


def _nodes(n: int, line: list[str]) -> str:
    label, key, prefix = line[:3]
    prefix = "" if prefix == "-" else prefix
    parts = []
    for spec in line[3:]:
        source, target = spec.rstrip("@").split(">")
        value = f"strftime(max({source}), '%Y-%m-%dT%H:%M:%S')" if spec.endswith("@") else f"max(nullif({source}, ''))"
        parts.append(f"SELECT '{label}' AS label, '{prefix}' || trim({key}) AS key, '{target}' AS field, {value} AS value FROM {{ent_{label}}} WHERE trim({key}) <> '' GROUP BY trim({key})")
    return " UNION ALL ".join(parts)


def _edges(n: int, line: list[str]) -> str:
    kind, src, a, dst, b = line[:5]
    keys = {x[0]: (x[1], "" if x[2] == "-" else x[2]) for x in NODE_LINES}
    other = b if b != a else b + "_2"

    def known(label: str) -> str:
        return f"(SELECT trim({keys[label][0]}) FROM {{ent_{label}}} WHERE trim({keys[label][0]}) <> '')"
    zero = f" AND {other} <> '0'" if len(line) > 5 else ""
    return (f"SELECT DISTINCT '{keys[src][1]}' || {a} AS src, '{src} {kind} {dst}' AS kind, '{keys[dst][1]}' || {other} AS dst FROM {{edge_{n}}} "
            f"WHERE {a} IN {known(src)} AND {other} IN {known(dst)}{zero}")


ENTITY_FIXTURES: dict[str, str] = {f"ent_{line[0]}": _rows(n, line) for n, line in enumerate(NODE_LINES)} | {
    f"edge_{n}": _pairs(n, line) for n, line in enumerate(EDGE_LINES)}
ENTITY_SQL: dict[str, str] = {
    "all_entity_nodes": " UNION ALL ".join(_nodes(n, line) for n, line in enumerate(NODE_LINES)),
    "all_entity_edges": " UNION ALL ".join(_edges(n, line) for n, line in enumerate(EDGE_LINES)),
}
