"""Registered queries: sources, sinks, layer jobs."""

from pyspark.sql import functions as F

from leadloom.checks.fixtures import AS_OF_EVENTS, AS_OF_TRADE
from leadloom.checks.queries_trade import monthly
from leadloom.checks.registry import Registry
from leadloom.functions.ids import hash_key
from leadloom.functions.values import parse_date, parse_timestamp
from leadloom.operators import layers as la
from leadloom.operators import merge as m
from leadloom.operators import trade
from leadloom.session import shared_dir
from leadloom.sources import landed, sinks, tables

ORDER_DOC = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"


def landed_orders(i):
    """Orders written as JSON documents below role folders, then read back."""
    import uuid
    folder = f"{shared_dir(i.spark)}/leadloom/{uuid.uuid4().hex}/landed"
    for role, cond in (("Buyer", "o_orderstatus = 'O'"), ("supplier", "o_orderstatus <> 'O'")):
        i.orders.where(cond).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").write.json(
            f"{folder}/buyer-supplier-list/{role}/US/sea/2024-01-01_to_2024-03-31/1700000000")
    return landed.read_landed_json(i.spark, folder, ORDER_DOC, multi_line=False)


def order_docs(i):
    line = F.struct(F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("supplier"),
                    F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag"))
    return i.lineitem.groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))


def nested_docs(i):
    item = F.struct(F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity"))
    by_flag = i.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.collect_list(item).alias("items"))
    return by_flag.groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_returnflag").alias("flag"), "items")).alias("flags"))


def tree_docs(i):
    """Region -> nation -> supplier trees as nested JSON text."""
    leaf = F.to_json(F.struct(F.col("s_suppkey").alias("companyId"), F.col("s_name").alias("companyName")))
    suppliers = i.supplier.groupBy("s_nationkey").agg(F.concat(
        F.lit("["), F.array_join(F.collect_list(leaf), ","), F.lit("]")).alias("kids"))
    node = F.concat(F.lit('{"companyId":'), F.col("n_nationkey").cast("string"), F.lit(',"companyName":"'), "n_name",
                    F.lit('","familyNodes":'), F.coalesce("kids", F.lit("[]")), F.lit("}"))
    nations = i.nation.join(suppliers, i.nation.n_nationkey == suppliers.s_nationkey, "left").groupBy("n_regionkey").agg(
        F.array_join(F.collect_list(node), ",").alias("kids"))
    return i.region.join(nations, i.region.r_regionkey == nations.n_regionkey, "left").select(
        F.col("r_regionkey").alias("company_id"), F.lit(99).alias("parent_id"), F.lit("World").alias("parent_name"),
        F.concat(F.lit('[{"companyId":'), F.col("r_regionkey").cast("string"), F.lit(',"companyName":"'), "r_name",
                 F.lit('","familyNodes":['), F.coalesce("kids", F.lit("")), F.lit("]}]")).alias("family_nodes"))


def topic_rows(i):
    topics = i.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_returnflag").alias("topic"), F.col("l_quantity").alias("score"))).alias("topics"))
    return i.orders.join(topics, i.orders.o_orderkey == topics.l_orderkey, "left").select(
        F.col("o_orderkey").alias("id"), F.coalesce("topics", F.array().cast(topics.schema["topics"].dataType)).alias("topics"),
        F.col("o_orderstatus").alias("topic"), F.col("o_totalprice").alias("score"))


def health_responses(i):
    """The same facts in nested camel case, nested snake case and flat form, by turns."""
    form = F.col("o_orderkey") % 3
    names = {"buyerId": "o_custkey", "supplierId": "o_orderkey", "healthScore": "h", "shipmentCount": "n", "healthStatus": "s"}
    snake = {"buyer_id": "o_custkey", "supplier_id": "o_orderkey", "health_score": "h", "shipment_count": "n", "status": "s"}
    rows = i.orders.withColumns({"h": F.col("o_orderkey") % 90, "n": F.col("o_orderkey") % 9,
                                 "s": F.when(form == 2, "").otherwise(F.col("o_orderstatus"))})

    def struct(kind: int):
        return F.when(form == kind, F.struct(
            *[F.when(F.lit(kind) == 0, F.col(c).cast("string")).alias(n) for n, c in names.items()],
            *[F.when(F.lit(kind) == 1, F.col(c).cast("string")).alias(n) for n, c in snake.items()]))
    return rows.select(struct(0).alias("relationshipHealth"), struct(1).alias("relationship"),
                       *[F.when(form == 2, F.col(c).cast("string")).alias(n) for n, c in names.items()],
                       *[F.lit(None).cast("string").alias(n) for n in snake])


def classification_docs(i):
    piece = "struct<hsCode: string, description: string>"
    return i.requests.select(
        "title", "description", "country", "direction",
        F.struct(F.col("id").cast("string").alias("hsCode"), F.col("title").alias("description")).alias("mostSuitableHs"),
        F.when(F.col("size") % 2 == 1, F.array(F.struct(
            F.concat(F.lit("alt"), F.col("id").cast("string")).alias("hsCode"), F.lit("other").alias("description")))).otherwise(
            F.array().cast(f"array<{piece}>")).alias("dutiableHsCode"))


def line_lists(i):
    lines = i.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("flag"))
    lists = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(
        F.col("l_linenumber").alias("id"), F.col("flag").alias("name")))).alias("items"))
    return lists.select(F.col("l_orderkey").alias("order_id"), la.list_to_text("items", "id").alias("ids"),
                        la.list_to_text("items", "name").alias("names"), la.first_of_list("items").id.alias("first_id"))


def spans(i):
    return i.lineitem.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list("l_linenumber")).alias("lines"), F.struct(
            F.min("l_linenumber").alias("first"), F.max("l_linenumber").alias("last")).alias("span")).withColumnRenamed(
        "l_orderkey", "order_id")


def edges(i):
    a = i.customer.select(F.col("c_nationkey").cast("string").alias("src"), F.col("c_custkey").cast("string").alias("dst"))
    b = i.supplier.select(F.col("s_nationkey").cast("string").alias("src"), F.col("s_suppkey").cast("string").alias("dst"))
    return sinks.unique_edges(a, b)


def feed(i):
    spec = la.FEEDS["buyer_supplier_list"]
    done = la.silver(i.bronze_list, None, spec, AS_OF_EVENTS, "feed")
    empty = done.where("false").select(F.lit(0).cast("long").alias(spec.gold_key), "*")
    return la.gold(done, empty, spec)


def register(r: Registry) -> None:
    r.add("read_landed_json", landed_orders, "o_orderkey,o_custkey,o_orderstatus,o_totalprice:d")
    r.add("path_fields", lambda i: landed.path_fields(landed_orders(i)), "o_orderkey,company_role,from_date:s,to_date:s")
    r.add("partitioned_table_read", lambda i: tables.split_ranges(i.lineitem, "l_orderkey"), "split:i,lower:i,upper:i,rows:i")
    r.add("resolve_columns", lambda i: tables.resolve_columns(
        i.bills, trade.SHIPMENT_ALIASES, trade.SHIPMENT_TYPES, trade.SHIPMENT_REQUIRED),
        "buyer_id,buyer_name,supplier_id,supplier_name,hs_code,quantity:d,value:d,ship_date")
    new = lambda i: tables.incremental_since(i.events, "ts", "event_id", F.lit("2024-01-20 00:00:00").cast("timestamp"), 100)
    r.add("incremental_since", new, "event_id,ts,user_id")
    r.add("new_watermark", lambda i: tables.new_watermark(new(i), "ts", "event_id"), "watermark,last_id:i,rows_read:i")
    r.add("append_new_keys", lambda i: sinks.append_new_keys(i.old_table, i.new_table, "company_id"),
          "company_id,name,balance:d,origin,created_on,created_by")
    r.add("warehouse_shape", lambda i: sinks.warehouse_shape(spans(i), ["order_id", "lines", "span"], ["lines"], ["span"]),
          "order_id,lines,span")
    r.add("node_edge_sink", edges, "src,dst")
    r.add("outbox_events", lambda i: sinks.outbox_events(
        trade.trade_relationships(monthly(i)), sinks.RELATIONSHIP_EVENT, "rel_id",
        ["rel_id", "buyer_id", "total_shipments"], AS_OF_TRADE),
        "aggregate_id,event_id,event_type,created_at,processed,payload")
    r.add("load_log", lambda i: sinks.load_log(i.old_log, i.pending_runs),
          "feed_name,last_run_at,last_success_at,records_loaded:i,status,error_msg")
    r.add("flatten_array", lambda i: la.flatten_array(order_docs(i), "lines", {
        "line": ("line", "long"), "supplier": ("supplier", "string"), "quantity": ("quantity", "double"),
        "flag": ("flag", "string")}, {"order_id": ("l_orderkey", "long")}), "order_id,line:i,supplier,quantity:d,flag")
    r.add("flatten_nested_array", lambda i: la.flatten_nested_array(nested_docs(i), "flags", "items", {
        "line": ("line", "long"), "quantity": ("quantity", "double")}, {"flag": ("flag", "string")},
        {"order_id": ("l_orderkey", "long")}), "order_id,flag,line:i,quantity:d")
    r.add("flatten_struct", lambda i: la.flatten_struct(i.orders.select(F.struct(
        F.col("o_orderkey").alias("id"), F.struct("o_custkey", "o_orderstatus", "o_orderdate").alias("inner")).alias("doc")), {
        "order_id": ("doc.id", "long"), "buyer": ("doc.inner.o_custkey", "long"),
        "state": ("doc.inner.o_orderstatus", "string"), "day": ("doc.inner.o_orderdate", "date")}), "order_id,buyer,state,day:s")
    r.add("json_side_columns", lambda i: la.json_side_columns(i.orders.select("o_orderkey", F.struct(
        F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status")).alias("side")), ["side"]), "o_orderkey,side")
    r.add("family_tree_rows", lambda i: la.family_tree_edges(i.tree_edges), "root:i,node:i,parent:i,name,level:i,node_type")
    r.add("family_tree_json", lambda i: la.family_tree_rows(tree_docs(i)), "root:i,node:i,parent:i,level:i,node_type,name")
    r.add("explode_topics_or_self", lambda i: la.explode_topics_or_self(topic_rows(i)), "id,topic,score:d")
    r.add("hash_key", lambda i: i.requests.select(
        "id", hash_key("title", "description", "country", "direction", lower=True).alias("hash_key"),
        hash_key("title", "description").alias("plain_key")), "id,hash_key,plain_key")
    r.add("dedup_best", lambda i: la.dedup_best(i.bronze_list.withColumn("hash_key", hash_key(
        *la.FEEDS["buyer_supplier_list"].hash_parts)), ["hash_key"], "number_of_shipments"),
        "hash_key,company_id,country,zip_code,matched_hs_codes,company_role,number_of_shipments:i,shipment_value:d,ingested_at")
    r.add("keyed_merge", lambda i: m.keyed_merge(i.old_table, i.new_table, ["company_id"], AS_OF_EVENTS, "job1"),
          "company_id,name,balance:d,origin,created_on,created_by,modified_on,modified_by")
    r.add("surrogate_key", lambda i: m.surrogate_key(i.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"), "line_key",
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]),
        "line_key:i,l_orderkey,l_linenumber:i,l_partkey")
    r.add("gold_upsert", lambda i: m.gold_upsert(i.old_gold, i.gold_silver, "cp_key", ["company_id"], ["company_id"]),
          "cp_key:i,company_id,name")
    r.add("audit_columns", lambda i: m.audit_columns(i.region, AS_OF_EVENTS, "feed"),
          "r_regionkey:i,created_on,created_by,modified_on,modified_by")
    r.add("pairs_from_roles", lambda i: la.pairs_from_roles(i.company_list, i.imported_hs.select("company_id", "hs_code").unionByName(
        i.exported_hs.select("company_id", "hs_code"))), "buyer_id,supplier_id")
    r.add("not_yet_enriched", lambda i: la.not_yet_enriched(i.contact_scores, i.enriched, 60), "contact_id,contact_accuracy_score:d")
    r.add("normalise_health", lambda i: la.normalise_health(health_responses(i)),
          "buyer_id,supplier_id,health_score:d,shipment_count:i,health_status")
    r.add("classification_rows", lambda i: la.classification_rows(classification_docs(i)),
          "hash_key,most_suitable_hs_code,most_suitable_hs_description,dutiable_hs_code,dutiable_hs_description")
    r.add("list_to_text", line_lists, "order_id,ids,names,first_id:i")
    r.add("parse_dates", lambda i: i.date_texts.select("id", parse_date("raw").alias("day"), parse_timestamp("raw").alias("moment")),
          "id,day:s,moment")
    r.add("feed_job", feed,
          "bsl_key:i,hash_key,company_id,country,zip_code,matched_hs_codes,company_role,number_of_shipments:i,shipment_value:d,ingested_at,created_on,created_by")
