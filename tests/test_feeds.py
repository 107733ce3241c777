"""Feeds from documents as vendors write them, field by field."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from leadloom.checks import queries_feeds
from leadloom.sources import feeds
from tests.conftest import rows

AS_OF = "2024-01-31 00:00:00"
DOCUMENTS = {
    "shipment_search": ({"shipments": [{"shipmentId": "S1", "shipperCountryName": "Peru", "hsCodes": [{"code": "68", "n": 1}], "quantity": 12.5, "billOfLadingNumber": 77, "other": 1},
                                       {"shipmentId": "S2", "quantity": "many"}]}, "shipment_id,shipper_country_name,hs_codes_json,quantity,bill_of_lading_number",
                        [("S1", "Peru", '[{"code":"68","n":1}]', 12.5, "77"), ("S2", None, None, None, None)]),
    "contact_enrich": ({"data": {"result": [{"input": {"personid": 5}, "data": [{"id": "9", "mobilePhone": "1", "company": {"id": 3}, "mobilePhoneDoNotCall": True},
                                                                               {"id": 10}]}, {"input": {"personid": 6}, "data": []}]}},
                       "id,person_id,mobile_phone,mobile_dnc,company_id", [(9, 5, "1", True, 3), (10, 5, None, None, None)]),
    "corporate_hierarchy": ({"ingested_at": "2024-01-02T03:04:05Z", "match_input": {"companyName": "Q", "companyId": 8}, "response": {"data": {"result": [
        {"data": {"companyId": 4, "parentage": {"parentCompany": {"id": 2, "name": "P", "country": "DE"}, "ultimateParentCompany": {"id": 1}}, "familyTree": {"b": 1, "a": [None]}}}]}}},
        "ingested_at,query_company_name,query_company_id,company_id,parent_company_id,parent_country,ultimate_parent_id,family_tree_json",
        [(dt.datetime(2024, 1, 2, 3, 4, 5), "Q", "8", 4, 2, "DE", 1, '{"a":[null],"b":1}')]),
    "hs_classifier": ({"ingested_at": "2024-01-02 03:04:05", "request": {"product_title": "T", "trade_direction": "IMPORT"}, "response": {
        "status": "ok", "mostSuitableHs": {"hsCode": "6802", "description": "stone"}, "dutiableHsCode": []}},
        "product_title,trade_direction,status,most_suitable_hs_code,dutiable_hs_codes_json,country_of_classification", [("T", "IMPORT", "ok", "6802", "[]", None)]),
    "contact_search": ({"ingested_at": "2024-01-02", "data": [{"id": 3, "firstName": "Ann", "lastUpdatedDate": "1/9/2024 3:05 PM", "hasEmail": True, "company": {"id": 1, "name": "C"},
                                                              "hasCompanyEmployeeCount": False}]},
                       "contact_id,first_name,last_updated_date,has_email,company_name,has_company_employee_count,valid_date",
                       [(3, "Ann", dt.datetime(2024, 1, 9, 15, 5), True, "C", False, None)]),
    "company_profile": ({"companyID": "c", "companyName": "N", "addressList": "a", "tradeHealthScore": "71.5", "stockTickers": ["X"], "totalImportCount": 4},
                        "company_id,company_name,address,trade_health_score,stock_tickers_json,total_import_count", [("c", "N", "a", 71.5, '["X"]', 4)]),
    "news_search": ({"ingested_at": "2024-01-02", "pageDateMin": "p0", "pageDateMax": "p1", "data": [{"id": 1, "url": "u", "publishedDate": "d", "companyId": 2}]},
                    "page_date_min,page_date_max,news_id,news_url,published_date,company_id", [("p0", "p1", 1, "u", "d", 2)]),
    "buyer_supplier_list": ({"companies": [{"companyId": "b1", "zipCode": "9", "matchedHsCodes": ["68", "69"], "numberOfShipments": 3}]},
                            "company_id,zip_code,matched_hs_codes,number_of_shipments,company_role,from_date", [("b1", "9", ["68", "69"], 3, "buyer", dt.date(2024, 1, 1))]),
}


@pytest.mark.parametrize("name", sorted(DOCUMENTS))
def test_fields_of_a_document(spark, tmp_path, name):
    document, columns, want = DOCUMENTS[name]
    folder = tmp_path / "buyer-supplier-list" / "buyer" / "2024-01-01_to_2024-01-31"
    folder.mkdir(parents=True)
    (folder / "one.json").write_text(json.dumps(document, indent=2))
    (folder / "broken.json").write_text('{"companies": [')
    (folder / "empty.json").write_text("{}")
    got = feeds.read_feed(spark, str(tmp_path), name, AS_OF).select(*columns.split(","))
    if not feeds.MAPS[name].lists:  # a document is a record; those without content have nothing in any field
        got = got.where(F.coalesce(*[F.col(c).cast("string") for c in columns.split(",")]).isNotNull())
    assert rows(got) == sorted(want, key=repr)


def test_maps_name_each_column_once():
    for name, feed in feeds.MAPS.items():
        names = [f.name for f in feeds.fields_of(feed)]
        assert len(names) == len(set(names)) and {c for c in feeds.FEEDS[name].hash_parts} <= {*names, "company_role"}, name


def test_two_runs_keep_keys_and_replace_values(spark, tmp_path):
    def land(run, companies):
        (tmp_path / run).mkdir()
        (tmp_path / run / "a.json").write_text(json.dumps({"companies": companies}))
        return str(tmp_path / run)
    first = land("1", [{"companyId": "b", "nameMatchPercentage": 10}, {"companyId": "b", "nameMatchPercentage": 90, "country": "PE"}, {"companyId": "a"}, {"companyName": "no key"}])
    second = land("2", [{"companyId": "b", "nameMatchPercentage": 5}, {"companyId": "c"}])
    silver, gold = feeds.run_feed(spark, first, "company_matcher", AS_OF, "x")
    sent = feeds.warehouse_rows(gold, "company_matcher")
    assert rows(gold.select("cm_key", "company_id", "name_match_percentage", "country")) == sorted([(1, "a", None, None), (2, "b", 90.0, "PE")], key=repr)
    _, gold = feeds.run_feed(spark, second, "company_matcher", "2024-02-01 00:00:00", "x", silver, gold)
    assert rows(gold.select("cm_key", "company_id", "name_match_percentage", "country")) == sorted([(1, "a", None, None), (2, "b", 5.0, None), (3, "c", None, None)], key=repr)
    assert rows(feeds.warehouse_rows(gold, "company_matcher", sent).select("cm_key")) == [(3,)]


def _files_of(made, name):
    return [json.loads(r.value) for r in queries_feeds.documents(made, name).collect()]


def test_a_page_of_many_records_lands_in_several_documents(spark):
    made = spark.range(2600).selectExpr("id as contact_id", "id % 2 as page", "'n' || id as first_name", "timestamp'2024-01-02' as ingested_at")
    made = made.select("page", *[f.name if f.name in made.columns else F.lit(None).cast("string").alias(f.name) for f in feeds.fields_of(feeds.MAPS["contact_search"])])
    for c in ("valid_date", "last_updated_date"):
        made = made.withColumn(c, F.lit(None).cast("timestamp"))
    found = _files_of(made, "contact_search")
    assert len(found) == 6 and max(len(d["data"]) for d in found) < 1.5 * queries_feeds.RECORDS
    assert sorted(r["id"] for d in found for r in d["data"]) == list(range(2600))


def test_single_records_share_files_of_bounded_size(spark):
    made = spark.range(1300).selectExpr("'c' || id as company_id")
    made = made.select("*", *[F.lit(None).cast("string").alias(f.name) for f in feeds.fields_of(feeds.MAPS["company_profile"]) if f.name != "company_id"])
    found = _files_of(made, "company_profile")
    assert len(found) == 3 and max(map(len, found)) < 1.5 * queries_feeds.RECORDS
    assert {r["companyID"] for d in found for r in d} == {f"c{k}" for k in range(1300)}


def test_files_hold_one_document_or_many_with_exact_values(spark, tmp_path):
    one = {"companyID": "a", "stockTickers": ["X", {"b": 1.50}]}
    (tmp_path / "one.json").write_text(json.dumps(one, indent=2).replace("1.5", "1.50"))
    (tmp_path / "many.json").write_text('[{"companyID": 1.50e3,\n "tradeHealthScore": 2},\n {"companyID": true}]')
    got = feeds.read_feed(spark, str(tmp_path), "company_profile", AS_OF).select("company_id", "trade_health_score", "stock_tickers_json")
    assert rows(got) == sorted([("a", None, '["X",{"b":1.5}]'), ("1.50e3", 2.0, None), ("true", None, None)], key=repr)
