import datetime as dt
import json

from pyspark.sql import functions as F

from leadloom.operators import health, trade
from leadloom.streaming import events as ev
from leadloom.streaming import trade as st
from tests.conftest import rows

AS_OF = "2024-01-31 00:00:00"


def line(key, day, qty, code="6802"):
    return json.dumps({"event_key": key, "buyer_id": "B", "buyer_name": "b", "supplier_id": "S", "supplier_name": "s", "hs_code": code,
                       "quantity": qty, "value": 1.0, "ship_date": f"{day}T00:00:00", "_polled_at": "2024-01-30T00:00:00"})


def test_stream_equals_batch_with_repeats_and_late_rows(spark, tmp_path):
    first = [line("a", "2023-05-01", 5.0), line("b", "2023-07-01", 6.0), "not json"]
    second = [line("a", "2023-05-01", 5.0), line("c", "2023-01-15", 50.0, '["6802"]'), line("d", "2023-07-09", 1.0)]
    (tmp_path / "in").mkdir()
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    for n, lines in enumerate((first, second)):
        (tmp_path / "in" / f"{n}.json").write_text("\n".join(lines))
        st.stream_trade(spark, str(tmp_path / "in"), log, state, AS_OF)
    data = [("B", "b", "S", "s", "6802", q, 1.0, dt.datetime.fromisoformat(d)) for d, q in (
        ("2023-05-01", 5.0), ("2023-07-01", 6.0), ("2023-01-15", 50.0), ("2023-07-09", 1.0))]
    batch = trade.monthly_trade(spark.createDataFrame(data, "buyer_id string, buyer_name string, supplier_id string, supplier_name string, "
                                                      "hs_code string, quantity double, value double, ship_date timestamp"), AS_OF)
    streamed = st.months_of(spark, log).select(*batch.columns)
    assert rows(streamed) == rows(batch)
    want = health.stress_rules(trade.trade_relationships(batch), trade.trade_snapshots(batch), AS_OF)
    assert rows(st.stream_stress(spark, log, AS_OF)) == rows(want)
    last = spark.read.parquet(log).agg(F.max("batch")).first()[0]
    assert rows(st.stream_stress(spark, log, AS_OF, batch=last)) == rows(want)


def test_bad_lines_go_aside(spark):
    lines = spark.createDataFrame([(line("a", "2023-05-01", 1.0),), ("{broken",), ("",)], "value string")
    good, bad = ev.parse_events(lines, st.SHIPMENT)
    assert good.count() == 1 and {r.value for r in bad.collect()} == {"{broken", ""}


def test_email_scores_clamp_in_order(spark):
    leads = spark.createDataFrame([("x", 12), ("y", 98), ("z", 50)], "lead_uid string, score_final int")
    at = dt.datetime(2024, 1, 1)
    data = [(1, "x", "bounce", at), (2, "x", "open", at + dt.timedelta(days=1)), (3, "y", "open", at), (4, "y", "spam", at + dt.timedelta(hours=1)),
            (5, "y", "CLICK", at + dt.timedelta(days=2)), (6, "z", "sent", at)]
    emails = spark.createDataFrame(data, "event_id int, lead_uid string, event_type string, at timestamp")
    assert rows(ev.email_scores(leads, emails).select("lead_uid", "score_final")) == [("x", 15), ("y", 95), ("z", 50)]


def test_windows_run_as_a_stream(spark, tmp_path):
    schema = "user_id long, ts timestamp, value double"
    data = [(1, dt.datetime(2024, 1, 1, 0, m), 1.0) for m in (0, 10, 50)]
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    ev.run_to_log(ev.activity_windows(stream, "tumbling", "1 hour", late="1 hour"), str(tmp_path / "log"), str(tmp_path / "state"))
    got = ev.current(spark, str(tmp_path / "log"), ["user_id", "start", "end"])
    assert got.select("events").collect()[0].events == 3


def test_routing_doubles_visits_with_an_element(spark):
    rows_in = [("crm.buyer_sessions", "crm.page_visits", "", "send-query"), ("crm.buyer_sessions", "crm.page_event_trackings", "send-query", None),
               ("crm.lead_updates", "crm.deals", "", None), ("other", "t", "", None)]
    df = spark.createDataFrame(rows_in, "topic string, _source_table string, button_identity string, element_name string")
    got = ev.route_events(df).groupBy("handler").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r.handler: r.n for r in got} == {"click": 2, "session": 1, "deal": 1, "none": 1}
