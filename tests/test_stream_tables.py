"""Streams into versioned tables: equal to the batch answer after every batch, repeats and late rows included."""

import datetime as dt
import json
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from leadloom.operators import trade
from leadloom.plans.trade import TradePlan
from leadloom.sources.versioned import VersionedTable
from leadloom.streaming import events as ev
from leadloom.streaming import tables as st
from leadloom.streaming.leads import LeadStream
from tests.conftest import rows

AS_OF = "2024-01-31 00:00:00"
SHIP = "buyer_id string, buyer_name string, supplier_id string, supplier_name string, hs_code string, quantity double, value double, ship_date timestamp"


def shipments(n, seed, suppliers=14, codes=("680210", "680220", "720110", "990100")):
    rng = random.Random(seed)
    for k in range(n):
        s = rng.randrange(suppliers)
        day = dt.datetime(2023, 1, 1) + dt.timedelta(days=rng.randrange(0, 390 if s % 3 else 200))
        yield (f"{seed}-{k}", f"B{rng.randrange(5)}", f"Sup {s}", f"S{s}", rng.choice(codes[:2] if s < 9 else codes), float(rng.randint(1, 90)), day)


def line(row, polled):
    key, buyer, name, supplier, code, qty, day = row
    return json.dumps({"event_key": key, "buyer_id": buyer, "buyer_name": f"Buyer {buyer}", "supplier_id": supplier, "supplier_name": name, "hs_code": code,
                       "quantity": qty, "value": qty * 2, "ship_date": day.isoformat(), "_polled_at": polled.isoformat()})


def as_frame(spark, done):
    return spark.createDataFrame([(b, f"Buyer {b}", s, n, c, q, q * 2, d) for _, b, n, s, c, q, d in done], SHIP)


def test_months_equal_batch_and_state_stays_flat(spark, tmp_path):
    """One file a batch for 7 batches: repeats of the batch before, late shipments, state of one repeat window."""
    (tmp_path / "in").mkdir()
    table, done, before, files = st.month_table(spark, str(tmp_path / "t"), most_deltas=6), [], [], []
    for n in range(7):
        new = list(shipments(6, n))
        polled = dt.datetime(2024, 2, 1) + dt.timedelta(days=2 * n)
        late = [line(r, polled - dt.timedelta(days=9)) for r in shipments(2, 100 + n)]  # far behind any watermark
        files.append("\n".join([line(r, polled) for r in new] + [line(r, polled) for r in before] + late + ["{broken"]))
        done += list(shipments(2, 100 + n))
        done, before = done + new, new[:3]
    seen, sizes = st.seen_table(spark, str(tmp_path / "seen"), most_deltas=2), []
    for n in range(7):  # as they arrive; file times alone do not order them
        (tmp_path / "in" / f"{n:02d}.json").write_text(files[n])
        query = st.stream_months(table, seen, str(tmp_path / "in"), str(tmp_path / "state"), AS_OF, within="2 days")
        sizes.append(seen.read().count())
    assert max(sizes[4:]) <= 5 * 6 < 7 * 8 and not query.recentProgress[-1]["stateOperators"]  # what the window holds, not what has come
    want = trade.monthly_trade(as_frame(spark, done), AS_OF)
    assert rows(table.read().select(*want.columns)) == rows(want) and len(table.version().deltas) <= 6
    number = table.version().number  # a batch delivered again changes nothing
    assert st.add_shipments(table, as_frame(spark, done[:6]).withColumn("event_key", F.lit("x")), AS_OF, batch=3) == number
    st.expire_months(table, "2026-06-15")
    assert table.read().where("year_month < '2023-06-01'").count() == 0 < table.read().count()


@pytest.fixture(scope="module")
def inputs(spark):
    firms = [(f"B{i}", "stone", 10 * i, i, i % 2, 0, 0) for i in range(5)] + [(f"S{i}", "supply", 5 * i, 0, 0, 0, 0) for i in range(14)]
    return SimpleNamespace(
        firms=spark.createDataFrame(firms, "org_id string, industry string, employee_count long, intent_count long, leadership_change int, funding_event int, ma_event int"),
        people_links=spark.createDataFrame([("P1", "S1"), ("P2", "S4"), ("Q1", "B1")], "person_key string, org_id string"),
        people=spark.createDataFrame([("Q1", "Ann", "Head", "a@x.example", True), ("P1", "Bo", "Sales", "b@x.example", False)],
                                     "person_key string, name string, title string, email string, is_decision_maker boolean"),
        buyer_countries=spark.createDataFrame([("B0", "peru"), ("B1", "chile"), ("B2", "peru")], "buyer_id string, country string"))


def test_leads_equal_the_batch_plan_after_every_batch(spark, tmp_path, inputs):
    stream, done = LeadStream(spark, str(tmp_path / "t"), inputs, AS_OF), []
    # the last batch touches one supplier only, whose prefixes are not all there are
    batches = [list(shipments(160, 1)), [r for r in shipments(60, 2, codes=("720110", "990100")) if r[3] in ("S12", "S13")]]
    for batch, new in enumerate(batches):
        done += new
        frame = as_frame(spark, new).withColumns({"event_key": F.concat(F.lit(f"{batch}-"), F.monotonically_increasing_id().cast("string")),
                                                  "_polled_at": F.lit("2024-01-30 00:00:00").cast("timestamp")})
        frame = frame.unionByName(frame.limit(7))  # repeats
        stream.apply(frame, batch)
        plan = TradePlan(inputs, AS_OF)
        plan.__dict__["monthly"] = trade.monthly_trade(as_frame(spark, done), AS_OF)
        want = plan.matched_leads.unionByName(plan.unmatched_leads)
        assert rows(stream.leads.read().drop("hs_prefix")) == rows(want) and want.count() > 5
        assert rows(stream.opportunities.read().drop("hs_prefix")) == rows(plan.scored.select(*stream.opportunities.schema.names[:-1]))
        versions = [t.version().number for t in (stream.months, stream.health, stream.opportunities, stream.matches, stream.leads)]
        stream.apply(frame, batch)  # delivered again after a failure
        assert versions == [t.version().number for t in (stream.months, stream.health, stream.opportunities, stream.matches, stream.leads)]


def test_latest_rows_totals_and_folds(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    schema = "handler string, _source_table string, id string, status string, enquiry_type string, message string, account_uid string, risk_type string, lead_uid string, email_event string, _polled_at timestamp, event_key string"

    def event(handler, n, **more):
        base = dict.fromkeys(["_source_table", "id", "status", "enquiry_type", "message", "account_uid", "risk_type", "lead_uid", "email_event"], "")
        return tuple((base | {"handler": handler, "_polled_at": at + dt.timedelta(minutes=n), "event_key": f"e{n:03d}"} | more)[c.split()[0]] for c in schema.split(", "))
    records = st.SalesRecords(spark, str(tmp_path))
    first = [event("rfq", 1, id="1", status="quoted", _source_table="crm.rfqs"), event("rfq", 2, id="1", enquiry_type="bid", _source_table="crm.enquiries"),
             event("lead", 3, id="7", message="hi"), event("deal", 4, id="7"), event("risk_flag", 5, account_uid="A", risk_type="spam"),
             *[event("email", 10 + n, lead_uid="x", email_event="bounce") for n in range(12)], event("session", 6, id="9")]
    second = [event("rfq", 0, id="1", status="draft", _source_table="crm.rfqs"), event("lead", 30, id="7", status="won"), event("risk_flag", 31, account_uid="A", risk_type="bot"),
              event("email", 32, lead_uid="x", email_event="Open"), event("email", 33, lead_uid="y", email_event="click")]
    for n, batch in enumerate((first, second, second)):  # the second is delivered twice
        records.apply(spark.createDataFrame(batch, schema), min(n, 1))
    got = {r.source_ref: (r.lead_type, r.score_final) for r in records.leads().collect()}
    assert got == {"rfq:1": ("quote_ready", 90), "enquiry:1": ("rfq_submitted", 88), "crm_lead:7": ("quote_ready", 90), "deal:7": ("engaged_account", 70)}
    leads = spark.createDataFrame([("x", "A", 90), ("y", "B", 99), ("z", None, 40)], "lead_uid string, account_uid string, score_final int").selectExpr(
        "*", "'t' AS lead_type", "false AS suppressed", "true AS seller_visible", "'' AS distribution_status")
    assert {r.lead_uid: r.score_final for r in records.scored(leads).collect()} == {"x": 15, "y": 100, "z": 40}
    assert {r.lead_uid: r.suppression_reason for r in records.suppressed(leads).collect()} == {"x": "bot", "y": None, "z": None}


def test_profiles_grow_by_what_arrives(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), st.PROFILES, ["user_id"])
    schema = "user_id string, handler string, element_type string, button_identity string, _polled_at timestamp"
    data = [(str(n % 4), "click" if n % 2 else "session", "Get Quote" if n % 3 else "x", "contact-seller", dt.datetime(2024, 1, 1, n % 24)) for n in range(60)]
    for n in range(3):
        delta = st.profile_totals(spark.createDataFrame(data[20 * n:20 * n + 20], schema))
        st.merge_totals(table, delta, ["total_sessions", "total_clicks", "high_intent_score"], highs=["last_activity_at"], source="e", batch=n)
    assert rows(table.read()) == rows(st.profile_totals(spark.createDataFrame(data, schema)).select(*table.schema.names))
    assert rows(table.read()) == rows(ev.stream_profiles(spark.createDataFrame(data, schema)).select(*table.schema.names))


# --- message sink --------------------------------------------------------------------------------------------------

def test_a_failed_and_a_repeated_batch_leave_each_message_once(spark, tmp_path):
    from leadloom.streaming import messages as ms
    path = str(tmp_path / "out")
    writer = ms._StreamWriter(path, "s")
    rows_of = lambda *values: iter([{"topic": "t", "key": k, "value": v} for k, v in values])
    lost = writer.write(rows_of(("a", "half"), ("b", "half")))  # a task that wrote and then failed
    writer.abort([lost, None], 0)
    writer.write(rows_of(("z", "never committed")))
    writer.commit([writer.write(rows_of(("a", "1"), ("b", "1"), ("a", "2"))), writer.write(iter(()))], 0)
    writer.commit([writer.write(rows_of(("a", "1"), ("b", "1"), ("a", "2")))], 0)  # the batch again after a lost driver
    assert ms.published(spark, path).count() == 3
    assert rows(ms.latest_messages(spark, path)) == [("t", "a", "2"), ("t", "b", "1")]
    writer.commit([writer.write(rows_of(("b", None), ("é", "x")))], 1)
    assert rows(ms.latest_messages(spark, path)) == [("t", "a", "2"), ("t", "b", None), ("t", "é", "x")]


def test_messages_through_a_stream(spark, tmp_path):
    from leadloom.streaming import messages as ms
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    frame = spark.createDataFrame([("u1", 50), ("u2", 60), (None, 1)], "user_id string, behavioral_score int")
    for n in range(2):
        ms.messages(frame.withColumn("behavioral_score", F.col("behavioral_score") + n), "kg.buyer_profiles", AS_OF).write.mode("append").parquet(source)
        ms.publish_stream(spark.readStream.schema(ms.MESSAGE).parquet(source), out, str(tmp_path / "state"))
    assert ms.published(spark, out).count() == 6
    got = {r.key: json.loads(r.value) for r in ms.latest_messages(spark, out).collect()}
    assert got["u1"]["behavioral_score"] == 51 and got["u1"]["event_type"] == "buyer_profile.score_updated" and got["u1"]["org_id"] is None
    with pytest.raises(KeyError):
        ms.messages(frame, "kg.other", AS_OF)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(n).getName() for n in range(files.size()) if files.apply(n).getName().startswith("shuffle_")}


def test_a_written_version_leaves_no_shuffle_files(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "id long, n long", ["id"])
    before = shuffle_files(spark)
    table.upsert(spark.range(500).withColumn("n", F.col("id") % 7), parts=3)
    assert not shuffle_files(spark) - before
    table.upsert(spark.range(490, 510).withColumn("n", F.lit(9).cast("long")))
    assert rows(table.read()) == sorted([(n, n % 7 if n < 490 else 9) for n in range(510)], key=repr)


def test_repeats_are_found_in_parts_and_no_copy_is_left(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "PART", 1)
    asked, write = [], VersionedTable._write
    monkeypatch.setattr(VersionedTable, "_write", lambda self, some, number, parts=1: asked.append(parts) or write(self, some, number, parts))
    seen = st.seen_table(spark, str(tmp_path / "seen"))

    def batch(*numbers):
        return spark.createDataFrame([(f"k{n}", dt.datetime(2024, 1, 1), n) for n in numbers], "event_key string, _polled_at timestamp, n int")
    assert rows(st.fresh_rows(seen, batch(*range(40), 3, 3), 0).select("n")) == rows(batch(*range(40)).select("n"))
    assert rows(st.fresh_rows(seen, batch(*range(30, 50)), 1).select("n")) == rows(batch(*range(40, 50)).select("n"))
    assert rows(st.fresh_rows(seen, batch(*range(30, 50)), 1).select("n")) == rows(batch(*range(40, 50)).select("n"))  # again after a failure
    assert asked == [16, 16] and seen.read().count() == 50
    assert not [p for p in (tmp_path / "seen" / "dealt").iterdir() if p.name.startswith("_bucket=")]
    st.forget_arrived(seen)
    assert not (tmp_path / "seen" / "arrived").exists()


def test_landed_lines_are_packed_and_bounded(spark, tmp_path, monkeypatch):
    from leadloom.checks import queries_views
    monkeypatch.setattr(queries_views, "LINES", 10)
    made = spark.range(95).select(F.format_string("k%d", "id").alias("event_key"), (F.col("id") / 3).alias("value"))
    queries_views.land_packed(made, str(tmp_path / "in"), {}, 3)
    files = [p for p in (tmp_path / "in").iterdir() if p.name.startswith("part-")]
    assert all(p.name.endswith(".gz") for p in files)
    assert all(spark.read.text(str(p)).count() <= 10 for p in files)
    assert rows(spark.read.schema("event_key string, value double").json(str(tmp_path / "in"))) == rows(made)
