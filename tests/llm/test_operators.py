"""The operators against plain Python versions, on whole small tables and on edge rows."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import compare
from leadloom.llm import decontam, ngram_join, packing, pii, pitman_yor, quality, toxicity, url_filters, warc
from leadloom.llm.chunk_dedup import repeats
from leadloom.llm.decontam import clean_documents, decontamination
from leadloom.llm.oracles import ORACLES
from leadloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
PASSAGE = " ".join(f"passage{i} the of" for i in range(25))
EDGE = [(1, None, "x"), (2, "", "x"), (3, "one", None), (4, "one two", "x"), (5, "a b c d e f g h " * 20, "x"), (5, "a b c d e f g h " * 20, "x"),
        (6, LONG, "x"), (7, LONG + " end", "x"), (None, "no key here", "x"), (8, f"before it {PASSAGE} after", "x"),
        (9, f"other words {PASSAGE} follow", "x"), (10, "ONE Two", "x"), (11, "\n\t \x0b", "x")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, "doc_id long, text string, score string").selectExpr("*", "'y' AS n_words", "1 AS id")


@pytest.fixture(scope="module")
def empty(edge):
    return edge.where("1 = 0")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    line = compare.compare(spark, compare.duck(FOLDER), FOLDER, name, QUERIES[name], ORACLES[name])
    assert line.startswith("ok"), line


def plain_sets(texts, n):
    out = []
    for text in texts:
        words = (text or "").encode().lower().split()
        out.append({tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()})
    return out


def plain_components(rows, n, percent):
    sets, root = plain_sets([t for _, t in rows], n), {}
    for key, _ in rows:
        root.setdefault(key, key)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, (a, _)), (j, (b, _)) in itertools.combinations(enumerate(rows), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted((key, len(s), find(key)) for (key, _), s in zip(rows, sets))


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (1, 50)])
def test_components_are_exact(spark, documents, words, percent):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = ngram_join.jaccard_components(documents, words=words, percent=percent).collect()
    assert sorted(map(tuple, got)) == plain_components(rows, words, percent)


def test_components_of_a_large_family_and_small_tiles(spark):
    rng = np.random.default_rng(3)
    base = [f"t{i}" for i in range(60)]
    rows = []
    for k in range(150):
        words = list(base)
        for p in rng.choice(60, int(rng.integers(0, 5)), replace=False):
            words[p] = f"new{k}_{p}"
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, ngram_join.jaccard_components(df, words=1, percent=90, tile=16).collect()))
    assert got == plain_components(rows, 1, 90)


def test_tree_pairs_equal_all_pairs():
    rng = np.random.default_rng(5)
    bits = rng.integers(0, 2**63, (70, 8), dtype=np.uint64) & rng.integers(0, 2**63, (70, 8), dtype=np.uint64)
    bits[35:] = bits[:35]
    n = np.sort(rng.integers(90, 140, 70))
    leaves = (bits, np.bitwise_count(bits).sum(1, dtype=np.int64), n, n, np.arange(70))
    i, j = np.triu_indices(70, 1)
    ok = ngram_join._possible(leaves, i, leaves, j, 80)
    a, b = ngram_join.tree_pairs(ngram_join._Tree(leaves), None, 80)
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(zip(i[ok].tolist(), j[ok].tolist()))


def test_join_edges(edge, empty):
    got = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.jaccard_components(edge, words=3, percent=90).collect()}
    assert got[(1, 0)] == 1 and got[(2, 0)] == 2 and got[(11, 0)] == 11 and got[(5, 8)] == 5
    assert got[(4, 1)] == 4 and got[(10, 1)] == 4 and got[(None, 1)] is None
    assert ngram_join.jaccard_components(empty).count() == 0
    kept = ngram_join.one_of_each_group(edge, words=3, percent=90)
    assert kept.columns == edge.columns and Counter(r.doc_id for r in kept.collect())[5] == 1
    assert {r.doc_id for r in kept.collect()} >= {1, 2, 3, None} and 10 not in {r.doc_id for r in kept.collect()}


def test_quality_edges(edge, empty):
    rows = {r.doc_id: r for r in quality.quality(edge).collect()}
    assert rows[1].n_words == 0 and rows[1].base_failed and not rows[1].kept
    assert rows[5].n_repeat_words == 160 and rows[5].base_failed
    assert rows[6].n_words == 30_000 and rows[6].n_repeat_words == 0
    assert quality.quality(edge).count() == len(EDGE) and quality.quality(empty).count() == 0


def check_packing(rows, texts):
    from tokenizers import Tokenizer
    encoder = Tokenizer.from_file(packing.tokenizer_paths()[0])
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for key, text in texts:
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[key], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and (at & (at - 1) == 0 or 2048 - at < packing.LEAST)  # no padding, or less than a piece that is cut


def test_rests_fill_bins_by_their_class():
    rng = np.random.default_rng(5)
    for capacity, n in ((2048, 3000), (64, 400), (100, 400)):
        sizes = np.minimum(rng.lognormal(np.log(capacity / 4), 1, n).astype(int) + 1, capacity - 1)
        bins, done = packing.Bins(capacity, least=max(1, capacity // 120)), []
        for doc, size in enumerate(sizes.tolist()):
            done += bins.add(packing.Piece(doc, 0, np.arange(size, dtype="<u4"), size))
        closed = len(done)
        done += bins.close()
        by_doc = {}
        for bin_ in done:
            assert sum(len(p.ids) for p in bin_.pieces) == capacity - bin_.gap >= 1
            for p in bin_.pieces:
                by_doc.setdefault(p.doc, []).append(p)
        for doc, size in enumerate(sizes.tolist()):
            at = 0
            for p in sorted(by_doc[doc], key=lambda p: p.start):
                assert p.start == at and p.ids.tolist() == list(range(at, at + len(p.ids)))
                at += len(p.ids)
            assert at == size
        # a class 1/k takes k rests of lengths from C/(k+1) to C/k before anything fills its gap
        for bin_ in done[:closed]:
            assert all(capacity // (bin_.share + 1) < p.total <= capacity // bin_.share or len(p.ids) < p.total for p in bin_.pieces[:bin_.share])
        assert sum(b.gap for b in done if (capacity - b.gap) & (capacity - b.gap - 1)) < 0.01 * sizes.sum()
        assert np.median([len(v) for v in by_doc.values()]) == 1 and sum(map(len, by_doc.values())) < 2 * n


def test_pieces_are_few_and_padding_little(spark):
    rows = packing.pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(8)).toPandas()
    per_doc, per_sequence = rows.groupby("doc_id").size(), rows.groupby("sequence_id")["length"].sum()
    padded = per_sequence[(per_sequence & (per_sequence - 1)) != 0]
    assert per_doc.median() == 1 and per_doc.mean() < 1.7 and (rows["length"] < 17).mean() < 0.05
    assert (2048 - padded).sum() < 0.02 * rows["length"].sum()


def test_packing(documents, edge, empty):
    check_packing(packing.pack(documents).collect(), [(r.doc_id, r.text) for r in documents.collect()])
    single = edge.where("doc_id IS NULL OR doc_id <> 5")
    check_packing(packing.pack(single).collect(), [(k, t) for k, t, _ in EDGE if k != 5])
    assert packing.pack(empty).count() == 0
    special = documents.sparkSession.createDataFrame([(1, "a<|endoftext|>b  it's  x\n\n 12345 " + "z" * 300)], "doc_id long, text string")
    check_packing(packing.pack(special).collect(), [(1, special.first().text)])


def test_language_model(documents, edge, empty):
    got = pitman_yor.score(documents, buckets=3).collect()
    train, docs = Counter(), {}
    for r in documents.collect():
        docs[r.doc_id] = [*(r.text or "").encode().lower().split(), None]
        if zlib.crc32(str(r.doc_id).encode()) % 10:
            train.update(docs[r.doc_id])
    n, v = sum(train.values()), len(train)
    for r in got:
        tokens = docs[r.doc_id]
        want = sum(math.log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        assert r.n_tokens == len(tokens) and r.train_tokens == n and r.n_known == sum(train[t] > 0 for t in tokens)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert abs(r.base_score - want) < 1e-6 * abs(want)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    rows = pitman_yor.score(edge, buckets=2).collect()
    assert len(rows) == len(EDGE) and all(r.score < 0 for r in rows) and pitman_yor.score(empty).count() == 0
    assert [r.score for r in rows if r.doc_id == 1] == [r.score for r in rows if r.doc_id == 2]


def test_predictions_add_up_to_one():
    rng = np.random.default_rng(1)
    n = 4000
    word, context = np.minimum(rng.zipf(1.5, n), 300).astype(np.uint64), rng.integers(0, 40, n)
    bucket = pitman_yor.Bucket(word, context, np.ones(n, np.int64))
    totals = bucket.estimated(np.bincount(context, minlength=pitman_yor.FINE).astype(float))
    for _ in range(3):
        bucket.sweep(totals, pitman_yor.Levels())
        totals = pitman_yor.Totals(totals.fine_c, np.bincount(bucket.context, bucket.fine_t, pitman_yor.FINE),
                                   np.bincount(bucket.pair_context, bucket.pair_t, pitman_yor.COARSE), bucket.kind_t.sum(), bucket.known())
    p0, p1, p2, unknown = bucket.predict(totals, pitman_yor.Levels())
    assert abs(p0.sum() + unknown - 1) < 1e-9
    assert (bucket.fine_t <= bucket.count).all() and (bucket.fine_t >= 1).all() and (p2 > 0).all()


def test_toxicity(spark, documents, empty):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(got[k], y) for k, y in truth.items() if got[k].held_out]
    assert all(g.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, g in got.items())
    assert not [g for g, y in held if not y and g.predicted]
    assert sum(g.predicted for g, y in held if y) >= 0.5 * sum(y for _, y in held)
    assert toxicity.toxicity(empty, labels).count() == 0
    plain = toxicity.toxicity(spark.createDataFrame(EDGE, "doc_id long, text string, lang string"), labels.where("1 = 0"))
    assert plain.count() == len(EDGE) and plain.where("score IS NULL OR score < 0 OR score > 1").count() == 0


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a.example/x", "same"), (2, None, "same"), (3, "http://b.example/ y", ""), (4, "u", None),
            (5, "http://c.example", "<p>\r\nWARC/1.1\r\n\r\n</p> ü"), (6, "http://c.example", LONG)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("value", pytest.importorskip("pyspark.sql.functions").lit(1))
    for compression in ("gzip", "none"):
        path = str(tmp_path / compression)
        warc.write_warc(pages.repartition(3), path, compression=compression)
        got = {int(re.search(r"\d+", r.record_id)[0]): r for r in warc.read_warc(spark, path).collect()}
        assert {k: r.record_type for k, r in got.items()} == {1: "revisit", 2: "response", 3: "revisit", 4: "response", 5: "response", 6: "response"}
        assert got[1].refers_to == "<urn:page:2>" and got[5].payload.decode() == rows[4][2] and got[6].payload.decode() == LONG
        import base64
        assert all(r.payload_digest == base64.b32encode(hashlib.sha1((dict((a, c) for a, _, c in rows)[k] or "").encode()).digest()).decode()
                   for k, r in got.items())
        some = warc.read_warc(spark, path).where("record_type = 'revisit'")
        assert some.count() == 2 and warc.read_warc(spark, path, payload=False).where("payload IS NOT NULL").count() == 0
    warc.write_warc(pages.where("1 = 0"), str(tmp_path / "empty"))
    assert warc.read_warc(spark, str(tmp_path / "empty")).count() == 0


def test_warc_is_the_same_with_few_and_many_repeated_payloads(spark, tmp_path, monkeypatch):
    rows = [(1, "same"), (2, "same"), (None, "same"), (None, "own"), (None, "twice"), (None, "twice"), (3, "more"), (None, "more"), (4, "other")]
    pages = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "'u' AS url")
    got = []
    for k, most in enumerate((warc.BROADCAST_DIGESTS, 0)):
        monkeypatch.setattr(warc, "BROADCAST_DIGESTS", most)
        warc.write_warc(pages, str(tmp_path / str(k)))
        got.append(sorted((r.record_id, r.record_type, r.refers_to or "", bytes(r.payload or b"")) for r in warc.read_warc(spark, str(tmp_path / str(k))).collect()))
    assert got[0] == got[1] and len(got[0]) == len(rows)
    assert [r for r in got[0] if "null" in r[0]] == sorted([
        ("<urn:page:null>", "revisit", "<urn:page:2>", b""), ("<urn:page:null>", "revisit", "<urn:page:3>", b""), ("<urn:page:null>", "response", "", b"own"),
        ("<urn:page:null>", "response", "", b"twice"), ("<urn:page:null>", "response", "", b"twice")])


def test_leaks(spark, edge, empty):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    words = item.split()
    rows = [(1, f"Some text. {item.upper()}! More."), (2, " ".join(words[:4] + ["other"] + words[5:])), (3, " ".join(words[:6])),
            (4, "nothing here"), (5, None), (None, item), (6, "short test item of six"), (7, "x " * 50 + item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'z' AS item")
    bench = spark.createDataFrame([(10, item), (11, "short test item of six"), (12, None), (13, ""), (14, "too short")], "item_id long, text string")
    got = {r.doc_id: (r.contaminated, r["items"]) for r in decontamination(docs, bench).collect()}
    assert got == {1: (True, [10]), 2: (True, [10]), 3: (False, []), 4: (False, []), 5: (False, []), None: (False, []), 6: (True, [11]), 7: (True, [10])}
    assert {r.doc_id for r in clean_documents(docs, bench).collect()} == {3, 4, 5, None}
    assert decontamination(empty, bench).count() == 0 and clean_documents(edge, bench.where("1 = 0")).count() == len(EDGE)


def tolerated(n):
    """The sets of disagreeing places that the rule allows among n <= 13 item tokens."""
    most = n - math.ceil(0.8 * n)
    return [set(c) for k in range(most + 1) for c in itertools.combinations(range(n), k)]


def test_masks_hit_every_tolerated_pattern():
    assert sorted(decontam.MASKS) == list(range(decontam.MIN_TOKENS, decontam.WINDOW + 1))
    for n, masks in decontam.MASKS.items():
        for wrong in tolerated(n):
            assert any(not wrong & {s + p for p in mask} for mask in masks for s in range(n - mask[-1])), (n, wrong)


@pytest.mark.parametrize("around", ["", "before it "])
def test_leaks_of_every_tolerated_pattern(spark, around):
    items = {n: [f"i{n}t{k}" for k in range(n)] for n in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 16)}
    rows, want = [], {}
    for n, words in items.items():
        more = [set(range(n - 4 - k, n - 1 - k)) for k in range(2)] if n < 16 else []  # one more than any rule allows
        for wrong in (tolerated(n) if n < 14 else [w | {13, 14, 15} for w in tolerated(13)]) + more:
            want[len(rows)] = [n] if n > 4 and wrong not in more else []
            rows.append((len(rows), around + " ".join("other" if k in wrong else w for k, w in enumerate(words))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    assert {r.doc_id: r["items"] for r in decontamination(docs, bench).collect()} == want
    assert decontamination(docs, bench.where("item_id = 4")).where("contaminated").count() == 0


def test_repeated_passages(edge, empty):
    rows = {r.doc_id: r for r in repeats(edge).collect()}
    assert rows[9].first_docs == [8] and rows[9].repeated_bytes > 0.7 * len(PASSAGE) and not rows[8].spans and rows[8].shared_bytes > 0
    assert rows[7].first_docs == [6] and rows[7].repeated_bytes > 0.99 * len(LONG) and rows[1].n_chunks == rows[2].n_chunks == 0
    assert repeats(empty).count() == 0 and repeats(edge).count() == len(EDGE)


def luhn(s):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(s)))) % 10 == 0


def test_pseudonyms(spark, edge, empty):
    texts = ["mail anna.b12@site.example.com now", "card 4111111111111111 ok", "card 4111 1111 1111 1112!", "call +1 (017) 555-7713",
             "from 10.200.3.44.", "born 1999-02-28 or 31/12/2001 or 30.02.2001", 'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"', "id 078-05-1120", "plain 12 text", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = [r.text for r in pii.replace_pii(df, "k").orderBy("doc_id").collect()]
    assert out == [r.text for r in pii.replace_pii(df, "k").orderBy("doc_id").collect()] and out[8:] == texts[8:]
    assert out[2] == texts[2]  # no valid card number
    for old, new in zip(texts[:2] + texts[3:8], out[:2] + out[3:8]):
        assert old != new and (len(old) == len(new) or "10.200" in old)
    assert luhn(re.sub(r"\D", "", out[1])) and out[3].startswith("call +1 (")
    assert all(int(o) < 256 for o in re.search(r"from ([\d.]+)\.", out[4])[1].split("."))
    import datetime
    dates = re.findall(r"\d{4}-\d\d-\d\d|\d\d/\d\d/\d{4}", out[5])
    assert datetime.date.fromisoformat(dates[0]) and datetime.datetime.strptime(dates[1], "%d/%m/%Y") and "30.02.2001" in out[5]
    many = spark.range(3000).selectExpr("id AS doc_id", "concat('n ', lpad(cast(id AS string), 13, '0')) AS text")
    assert pii.replace_pii(many, "k").select("text").distinct().count() == 3000
    assert pii.replace_pii(edge, "k").columns == edge.columns and pii.replace_pii(empty, "k").count() == 0


def test_url_filters(spark):
    import datetime
    day = datetime.date
    captures = spark.createDataFrame([(1, "http://a.b.example.com/x/y", day(2024, 1, 5)), (1, "http://a.b.example.com/x/y", day(2024, 3, 5)),
                                      (2, "http://good.example.com:80/", day(2024, 3, 1)), (3, None, day(2024, 1, 1)), (4, "http://a.b.example.com/x", None)],
                                     "page_id long, url string, fetched_on date").selectExpr("*", "1 AS pattern")
    entries = spark.createDataFrame([(".example.com", day(2024, 1, 1), "block", "c"), ("good.example.com", day(2024, 2, 1), "allow", None),
                                     ("a.b.example.com/x/", day(2024, 2, 1), "block", "p"), ("a.b.example.com/x/", day(2024, 3, 5), "remove", "p"),
                                     (None, day(2024, 1, 1), "block", "c")], "pattern string, listed_on date, action string, category string")
    got = sorted((r.page_id, r.blocked, r.pattern or "") for r in url_filters.filter_urls(captures, entries).collect())
    assert got == [(1, True, ".example.com"), (1, True, ".example.com"), (2, False, "good.example.com"), (3, False, ""), (4, False, "")]
    assert url_filters.filter_urls(captures.where("1 = 0"), entries).count() == 0


def test_url_filter_paths_keep_their_case(spark):
    import datetime
    day = datetime.date(2024, 1, 5)
    urls = ["http://Example.com/Private/x", "http://example.com/private/x", "http://b.example/A/x", "http://b.example/a/x", "http://c.example/"]
    captures = spark.createDataFrame([(k, u, day) for k, u in enumerate(urls)], "page_id long, url string, fetched_on date")
    entries = spark.createDataFrame([(p, day, a, "c") for p, a in (("EXAMPLE.com/Private/", "block"), ("b.example/A/", "block"), ("B.example/a/", "allow"),
                                                                   ("C.Example", "block"))], "pattern string, listed_on date, action string, category string")
    got = {r.page_id: (r.blocked, r.pattern) for r in url_filters.filter_urls(captures, entries).collect()}
    assert got == {0: (True, "example.com/Private/"), 1: (False, None), 2: (True, "b.example/A/"), 3: (False, "b.example/a/"), 4: (True, "c.example")}


def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    kept = {r.doc_id for r in quality.quality(docs).where("kept").collect()}
    texts = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in kept]
    heads = {k for k, _, c in plain_components(texts, 5, 80) if k == c}
    leaked = {r.doc_id for r in decontamination(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).where("contaminated").collect()}
    assert {r.doc_id for r in rows} == heads - leaked
