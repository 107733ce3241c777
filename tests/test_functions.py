import hashlib

from pyspark.sql import functions as F

from leadloom.functions.ids import hash_key, stable_id
from leadloom.functions.rank import best_row, top_k
from leadloom.functions.values import first_present, parse_date, to_number, whole_days
from tests.conftest import rows


def expected_id(*parts):
    text = "\x00".join(f"{len(p or '')}:{p or ''}" for p in parts)
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def test_stable_id_matches_definition(spark):
    cases = [("a", "b"), ("é|", None), ("", "a||b"), (None, None)]
    df = spark.createDataFrame(cases, "a string, b string")
    got = {(r.a, r.b): r.id for r in df.withColumn("id", stable_id("a", "b")).collect()}
    assert got == {c: expected_id(*c) for c in cases}
    assert len(set(got.values())) == 4


def test_hash_key_keeps_positions(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert df.select(hash_key("x", "y", "z").alias("k")).distinct().count() == 2


def test_best_row_breaks_ties_fully(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, None, "c"), (2, 1, "d")], "k int, v int, t string")
    assert rows(best_row(df, ["k"], [F.col("v")])) == [(1, 5, "b"), (2, 1, "d")]


def test_top_k_is_exact_on_a_hot_key(spark):
    data = [(0 if i % 3 else i, (i * 7919) % 1000, i) for i in range(900)]
    df = spark.createDataFrame(data, "k int, v int, i int")
    got = rows(top_k(df, ["k"], [F.col("v"), F.col("i")], 5, salts=8).select("k", "i", "rank"))
    want = []
    for key in {d[0] for d in data}:
        best = sorted((d[1], d[2]) for d in data if d[0] == key)[:5]
        want += [(key, i, n) for n, (_, i) in enumerate(best, start=1)]
    assert got == sorted(want, key=repr)


def test_value_helpers(spark):
    df = spark.createDataFrame([("1,234.5", "2024-02-30", None, "x"), ("bad", "2024-02-29 10:00", "", "y")],
                               "n string, d string, ID string, uid string")
    got = df.select(to_number("n"), parse_date("d"), first_present(df, ["id", "uid"])).collect()
    assert [tuple(map(str, r)) for r in got] == [("1234.5", "None", "x"), ("None", "2024-02-29", "y")]
    days = spark.sql("select timestamp'2024-01-02 00:00:00' a, timestamp'2024-01-01 00:00:01' b").select(
        whole_days(F.col("a"), F.col("b")), whole_days(F.col("b"), F.col("a"))).first()
    assert tuple(days) == (0, -1)
