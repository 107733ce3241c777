"""Texts of a million characters without a break, and input columns named like the operators' own: every result is defined and quick."""

import math
import re
import time

import pytest
from pyspark.sql import functions as F

from leadloom.llm import packing, pii, quality, toxicity
from leadloom.llm.decontam import clean_documents
from leadloom.llm.ngram_join import one_of_each_group

MEGA = 1_000_000
RUNS = {
    "letters": "q" * MEGA, "letters, a digit and an at": "q" * MEGA + "7" + "q" * 100 + "@", "at in front": "x@" + "a." * (MEGA // 2),
    "dotted words": "a." * (MEGA // 2) + "@x", "blanks": " " * MEGA + "x", "line feeds": "\n" * (2 * MEGA), "digits": "4" * MEGA, "hex": "beef" * (MEGA // 4),
    "ats": "@" * MEGA, "mails": "a.b@c.example " * (MEGA // 14), "signs": "a" + "-" * MEGA + "b1c", "disguised": "id1ot" * (MEGA // 5), "dashes": "-" * MEGA,
    "points": "x@y" + "." * MEGA, "pluses": "+1 " * (MEGA // 3), "insults": "you idiot " * (MEGA // 10)}


@pytest.fixture(scope="module")
def long_rows(spark):
    return spark.createDataFrame(list(enumerate(RUNS.values())), "doc_id long, text string").repartition(4)


def timed(df, columns):
    start = time.time()
    rows = {r[0]: r for r in df.select("doc_id", *columns).collect()}
    assert len(rows) == len(RUNS) and time.time() - start < 60
    return [rows[k] for k in range(len(RUNS))]


def test_pseudonyms_of_long_runs(long_rows):
    got = timed(pii.replace_pii(long_rows, "k", values="found"), ["text", F.size("found")])
    for (name, old), (_, new, n) in zip(RUNS.items(), got):
        assert len(new) == len(old) and (n == MEGA // 14) == (name == "mails") and (name == "mails" or new == old and not n), name


def test_packing_of_long_runs(long_rows):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(packing.tokenizer_paths()[0])
    rows = long_rows.where("doc_id IN (4, 5, 8)")
    for (doc,) in rows.select("doc_id").distinct().collect():
        pieces = packing.pack(rows.where(F.col("doc_id") == doc)).orderBy("start").collect()
        want = len(library.encode(list(RUNS.values())[doc], add_special_tokens=False).ids) + 1
        assert {p.doc_tokens for p in pieces} == {want} and sum(p.length for p in pieces) == want


def test_ids_are_the_library_s_whichever_encodes(long_rows):
    ranks, file = packing.tokenizer_paths()[1], packing.tokenizer_paths()[0]
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(file)
    for text in (" " * MEGA + "x y<|endoftext|>", "some words\n" + "\n" * (2 * MEGA) + "more", "plain <|endoftext|> text"):
        assert packing.encode(text, ranks, file) == library.encode(text, add_special_tokens=False).ids


def plain_features(text, learned):
    """The toxicity features of one text, word by word."""
    text = text or ""
    tokens = [w for w in re.split(r"[^\w']+|[\d_]+", text.lower()) if w]  # letters and apostrophes
    marks = [i for i, w in enumerate(tokens) if w in toxicity.SECOND_PERSON]
    insults = [i for i, w in enumerate(tokens) if w in toxicity.INSULTS]
    disguised, table = 0, str.maketrans(*toxicity.DISGUISE)
    for run in re.findall(r"[^\W\d_@$!|+*.0-9-]*(?:[@$!|+*.0-9_-]|[^\W\d_])+", text):
        if re.search(r"[^\W\d_][@$!|+*.0-9_-]", run):
            plain = "".join(c for c in run.lower().translate(table) if c.isalpha())
            ends = re.sub(r"^[\W\d_]+|[\W\d_]+$", "", run.lower())
            disguised += plain in toxicity.INSULTS and ends not in toxicity.INSULTS
    if not re.search(r"[^\W\d_][@$!|+*.0-9_-]+[^\W\d_]", text):
        disguised = 0
    words, size = max(len(tokens), 1), max(len(text), 1)
    near = sum(any(abs(i - j) <= toxicity.NEAR for j in marks) for i in insults)
    known = sum(w in learned for w in tokens)
    count = {"capitals": sum(c.isupper() for c in text), "shouted": sum(c in "!?" for c in text), "punctuation": sum(c in ".,;:" for c in text),
             "signs": sum(c in "#*$%&|<>@" for c in text), "digits": sum(c in "0123456789" for c in text)}
    rates = {"fixed": len(insults) / words, "learned": known / words, "any_fixed": min(len(insults), 5), "any_learned": min(known, 5),
             "near": min(near, 5), "disguised": min(disguised, 5), "length": math.log1p(len(tokens))}
    return rates | {k: v / size for k, v in count.items()}


def test_toxicity_features_against_plain_python(spark, long_rows):
    insults = sorted(toxicity.INSULTS)[:3]
    odd = insults[0].replace("i", "1").replace("o", "0").replace("e", "3")
    texts = [None, "", f"You are an {insults[0]}! {odd} you", f"{odd}... {insults[1]}! x {insults[1].upper()} YOU", "a-b c_d 1a2 ...x", "#*$ <b> 100%"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    lexicon = [("the", 1.0), (insults[2], 2.0)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in toxicity.features(df, lexicon).collect():
        want = plain_features(texts[row.doc_id], {w for w, _ in lexicon})
        assert all(abs(row[k] - want[k]) < 1e-9 for k in toxicity.FEATURES), (row, want)
    assert all(math.isfinite(v) for r in timed(toxicity.features(long_rows, lexicon), list(toxicity.FEATURES)) for v in r)


def plain_feistel(values, radix, key, tweak):
    import hashlib
    left, right = values[:len(values) // 2], values[len(values) // 2:]
    for i in range(1, pii.ROUNDS + 1):
        pad = hashlib.sha256("|".join([key, tweak, str(i), ",".join(map(str, right))]).encode()).digest()
        left, right = right, [(a + pad[j % 32]) % radix for j, a in enumerate(left)]
    return left + right


def luhn_digit(payload):
    total = sum((2 * int(d) - 9 * (int(d) > 4)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(payload)))
    return str((10 - total % 10) % 10)


def test_pseudonyms_against_plain_python(spark):
    """Cards, social security numbers, addresses and secrets by a Feistel network in Python, invalid ones untouched."""
    def card(digits):
        new = "".join(map(str, plain_feistel([int(c) for c in digits[:-1]], 10, "k", f"card{len(digits)}")))
        return new + luhn_digit(new)

    def ssn(v):
        digits = v.replace("-", "")
        while True:
            digits = "".join(map(str, plain_feistel([int(c) for c in digits], 10, "k", "ssn")))
            if not re.match("000|666|9|...00|.....0000", digits):
                return f"{digits[:3]}-{digits[3:5]}-{digits[5:]}"

    def secret(v):
        mixed = v not in (v.lower(), v.upper())
        alphabet = pii.MIXED_HEX if mixed else pii.HEX
        kind = "mixed" if mixed else "hex" if v == v.lower() else "HEX"
        new = "".join(alphabet[x] for x in plain_feistel([alphabet.index(c) for c in (v if mixed else v.lower())], len(alphabet), "k", f"{kind}{len(v)}"))
        return new.upper() if kind == "HEX" else new
    low, up, mixed = "0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "0123456789abCDef" * 2
    want = {"4111111111111111": card("4111111111111111"), "1700000000123": None, "9780306406157": None, "4111111111111112": None,
            "078-05-1120": ssn("078-05-1120"), "219-09-9999": ssn("219-09-9999"), "000-12-3456": None, "666-12-3456": None, "900-12-3456": None, "123-00-4567": None,
            "123-45-0000": None, "10.0.0.1": ".".join(map(str, plain_feistel([10, 0, 0, 1], 256, "k", "ip"))), low: secret(low), up: secret(up), mixed: secret(mixed),
            "30.02.2001": None, "q" * 70 + "@x.example": None}
    df = spark.createDataFrame([(i, f"see {v} here") for i, v in enumerate(want)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.replace_pii(df, "k", values="found").collect()}
    for i, (old, new) in enumerate(want.items()):
        shown = old if new is None else new
        assert got[i].text == f"see {shown} here", (old, got[i].text)
        assert got[i].found == ([] if new is None and not old.startswith("30.02") else [old])
    assert len({secret(v) for v in (low, up, mixed)}) == 3


def test_addresses_keep_their_shape_and_ends(spark):
    texts = ["..anna.b@site.example.com...", "x@y.com, a@b.c.org.", "no@host", "@x.com", "a@-b.com", "a@b..com", "ANNA@Site.Example and anna@Site.Example"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r for r in pii.replace_pii(df, "k", values="found").orderBy("doc_id").collect()]
    assert [r.found for r in got] == [["anna.b@site.example.com"], ["x@y.com", "a@b.c.org"], [], [], [], [], ["ANNA@Site.Example", "anna@Site.Example"]]
    assert got[0].text.startswith("..") and got[0].text.endswith("@site.example.com...") and all(len(r.text) == len(t) for r, t in zip(got, texts))


CLASH = ["q_words", "q_lines", "__q_words", "_gone", "gone", "marked", "_twice", "head", "found", "__pii_found", "GONE"]


def test_columns_named_like_the_operators_own(spark):
    rows = [(1, "one two three four five six seven " * 9), (2, "one two three four five six seven " * 9), (3, "mail a.b@c.example"), (3, "mail a.b@c.example"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *[f"'{c}' AS `{c}`" for c in CLASH if c != "GONE"], "map('k', 1) AS m")
    bench = spark.createDataFrame([(1, "mail a b c example")], "item_id long, text string")
    for out in (quality.quality(df).select(*df.columns), clean_documents(df, bench), one_of_each_group(df), pii.replace_pii(df, "k")):
        assert out.columns == df.columns and all(r["q_words"] == "q_words" and r["__pii_found"] == "__pii_found" and r.m == {"k": 1} for r in out.collect())
    assert one_of_each_group(df).count() == 3 and clean_documents(df, bench).count() == 3
