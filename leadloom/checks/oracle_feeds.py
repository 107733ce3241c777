"""Records of the feeds, in SQL for both engines, and the DuckDB statements of what gold holds after two runs of them."""

from leadloom.operators.layers import FEEDS
from leadloom.sources.feeds import MAPS, Field, fields_of

# Which columns tell records apart, written here again; the hashed ones with what is hashed.
KEYS = {"buyer_supplier_list": ["company_id"], "company_matcher": ["company_id"], "company_profile": ["company_id"], "hs_classifier": ["product_title"],
        "relationship_health": ["supplier_id", "buyer_id"], "shipment_search": ["shipment_id"], "company_search": ["company_id"],
        "contact_enrich": ["person_id"], "contact_search": ["contact_id"], "corporate_hierarchy": ["company_id"], "intent_search": ["company_id"],
        "news_search": ["news_id"], "scoop_search": ["scoop_id"]}
HASHED = {"buyer_supplier_list": ("hash_key", ["company_id", "country", "zip_code", "'[' || array_to_string(matched_hs_codes, ', ') || ']'", "company_role"]),
          "hs_classifier": ("hs_hash", ["product_title", "country_of_classification", "trade_direction"]),
          "intent_search": ("intent_hash", ["company_id", "topic", "signal_date"])}
BEST = {"buyer_supplier_list": "number_of_shipments", "company_matcher": "name_match_percentage", "contact_search": "last_updated_date"}
ORDERS = {"contact_search": "last_updated_date, contact_id"}
RUN_1, RUN_2 = "TIMESTAMP '2024-01-30 00:00:00'", "TIMESTAMP '2024-01-31 00:00:00'"


def _timed(name: str) -> bool:
    """Records carry a time of their own."""
    return any(f.name == "ingested_at" for f in fields_of(MAPS[name]))


def _own(name: str, field: Field, i: int) -> str:
    """The value of a column in record k of version v. What belongs to the document is the same for all its records; what is
    hashed does not change with the version."""
    keys, best = KEYS[name], BEST.get(name, "ingested_at")
    k = "(k % 40)" if field.level == 0 and MAPS[name].lists else "k"
    v = "1" if field.name in FEEDS[name].hash_parts else "v"
    if field.name in keys:
        return "k" if field.kind == "long" else f"'{field.name[0].upper()}' || CAST({'k' if field.name == keys[0] else 'k % 5'} AS STRING)"
    if field.name == best:
        return {"long": "k % 10 + 20 * v", "double": "k % 10 + 20.5 * v"}.get(field.kind, f"TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * (v + 24 * {k})")
    if field.kind in ("time", "vendor_time"):
        return f"TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * (v + {k})"
    made = {"list": f"split(CAST({k} % {i + 3} AS STRING) || ',x' || CAST({v} AS STRING), ',')", "long": f"{k} * {i + 1} % 1000 + {v}",
            "int": f"CAST({k} % {i + 50} AS INT)", "double": f"CAST({k} % {i + 10} AS DOUBLE) + 0.5 * {v}", "boolean": f"({k} + {i} + {v}) % 2 = 0",
            "json": f"chr(123) || '\"a\":' || CAST({k} * {i + 1} + {v} AS STRING) || chr(125)"}.get(
        field.kind, f"'{field.name.replace('_', ' ')} ' || CAST(({k} * {i + 3} + {v}) % 97 AS STRING)")
    return made if field.name in FEEDS[name].hash_parts else f"CASE WHEN ({k} + {i}) % 7 = 0 THEN NULL ELSE {made} END"


def _flat(name: str) -> str:
    """Records of two runs; a key comes twice in the first where something in the records tells the better one."""
    made = ", ".join(f"{_own(name, f, i)} AS {f.name}" for i, f in enumerate(fields_of(MAPS[name])))
    twice = " UNION ALL SELECT 1 AS run, 2 AS v" if name in BEST or _timed(name) else ""
    return f"""
        SELECT run, k % 40 + 100 * v AS page, {made}
        FROM (SELECT t.run, t.v, CAST(c.c_custkey AS BIGINT) AS k FROM {{customer}} AS c CROSS JOIN (SELECT 1 AS run, 1 AS v{twice} UNION ALL SELECT 2 AS run, 3 AS v) AS t
              WHERE (t.run = 1 AND c.c_custkey % 3 <> 0) OR (t.run = 2 AND c.c_custkey % 3 <> 1)) AS q"""


def _shown(field: Field) -> str:
    if field.name == "stock_tickers":
        return "'[\"' || array_to_string(stock_tickers, '\",\"') || '\"]' AS stock_tickers"
    return f"coalesce(array_to_string({field.name}, ','), '') AS {field.name}" if field.kind == "list" else field.name


def _gold(name: str, only_new: bool = False) -> str:
    spec, feed = FEEDS[name], MAPS[name]
    extra = "" if _timed(name) else f", CASE run WHEN 1 THEN {RUN_1} ELSE {RUN_2} END AS ingested_at"
    facts = ", 'buyer' AS company_role, DATE '2024-01-01' AS from_date, DATE '2024-01-31' AS to_date" if feed.path_facts else ""
    key = KEYS[name]
    hashed = ""
    if name in HASHED:
        column, parts = HASHED[name]
        hashed, key = f", sha256(concat_ws('|', {', '.join(f'coalesce(CAST({p} AS VARCHAR), {chr(39)}{chr(39)})' for p in parts)})) AS {column}", [column]
    keys, order = ", ".join(key), ORDERS.get(name, ", ".join(key))
    same = " AND ".join(f"b.{k} = a.{k}" for k in key)
    own = ", ".join([*([key[0]] if hashed else []), *[_shown(f) for f in fields_of(feed)], *(["ingested_at"] if extra else []), *(["company_role", "from_date", "to_date"] if facts else [])])
    kept_time = own if name == "contact_enrich" else own.replace("ingested_at", "first_at AS ingested_at")  # that of the first run, but for this feed
    fresh = f"SELECT gk AS {spec.gold_key}, {own}, {RUN_2} AS created_on, {RUN_2} AS modified_on FROM fresh"
    changed = (f"SELECT gk AS {spec.gold_key}, {kept_time}, {RUN_1} AS created_on, {RUN_2} AS modified_on FROM changed UNION ALL "
               f"SELECT gk AS {spec.gold_key}, {own}, {RUN_1} AS created_on, {RUN_1} AS modified_on FROM kept UNION ALL ")
    return f"""
        WITH r AS (SELECT *{extra}{facts} FROM {{flat_{name}}}), h AS (SELECT *{hashed} FROM r),
        x AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY run, {keys} ORDER BY {BEST.get(name, 'ingested_at')} DESC) = 1),
        one AS (SELECT *, row_number() OVER (ORDER BY {order}) AS gk FROM x WHERE run = 1), two AS (SELECT * FROM x WHERE run = 2),
        fresh AS (SELECT *, (SELECT max(gk) FROM one) + row_number() OVER (ORDER BY {order}) AS gk FROM two AS a WHERE NOT EXISTS (SELECT 1 AS hit FROM one AS b WHERE {same})),
        changed AS (SELECT a.*, b.gk, b.ingested_at AS first_at FROM two AS a JOIN one AS b ON {same}), kept AS (SELECT * FROM one AS a WHERE NOT EXISTS (SELECT 1 AS hit FROM two AS b WHERE {same}))
        {fresh if only_new else changed + fresh}"""


FEED_FIXTURES: dict[str, str] = {f"flat_{name}": _flat(name) for name in MAPS}
FEED_SQL: dict[str, str] = {f"feed_{name}": _gold(name) for name in MAPS} | {"feed_warehouse_append": _gold("buyer_supplier_list", only_new=True)}
