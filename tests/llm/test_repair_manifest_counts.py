"""Conversation repair, Merkle manifest and token counts against plain Python versions, on whole small tables and edge rows."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest

from leadloom.llm import conversation_repair, merkle, token_counts
from leadloom.llm.queries import QUERIES

FOLDERS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def result(df, columns):
    return sorted(map(tuple, df.select(columns).collect()), key=repr)


# --- conversation repair -------------------------------------------------------------------------------------------

REPAIR = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def cheapest(symbols):
    """Least (cost, audit) over all edit sequences, row by row; a symbol is (role letter, fault)."""
    @cache
    def go(i, last, inserted):
        found = [(0, "")] if i == len(symbols) and last in ("", "a") else []

        def add(cost, letter, rest):
            found.append((cost + rest[0], letter + rest[1]))
        if inserted < 3:
            add(2, "I", go(i, NEXT[last], inserted + 1))
        if i < len(symbols):
            letter, fault = symbols[i]
            add(3, "D", go(i + 1, last, 0))
            if fault in ("fine", "cut"):
                if letter and letter in ("su" if last == "" else NEXT[last]):
                    add(fault == "cut", "K", go(i + 1, letter, 0))
                add(2 + (fault == "cut"), "R", go(i + 1, NEXT[last], 0))
        return min(found, default=(10**9, ""))
    return go(0, "", 0)


def plain_damage(rows):
    for conv, turn, role, text in rows:
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if what:
            text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
            yield from [(conv, turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)


def plain_repair(rows):
    out, after = [], list(plain_damage(rows))
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r, x) for c, t, r, x in after if c == conv), key=lambda g: (
            g[0] is not None, g[0] or 0, g[1].encode(), hashlib.sha256(f"{len(g[1])}:{g[1]}{g[2]}".encode()).digest()))
        seen, symbols = set(), []
        for _, role, text in own:
            end = text.rstrip(" \t\n\x0b\f\r")
            symbols.append((role[:1], "blank" if not end else "twice" if (role, text) in seen else "fine" if end[-1] in ".!?" else "cut"))
            seen.add((role, text))
        cost, audit = cheapest(tuple(symbols))
        lines, waiting, last = [], list(own), ""
        for letter in audit:
            _, role, text = (None, None, "") if letter == "I" else waiting.pop(0)
            if letter != "D":
                role = role if letter == "K" else NAMES[NEXT[last]]
                last = role[0]
                lines.append(f"{role}:{text}")
        assert not waiting and re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
        turns, faults = [t for t, _, _ in own if t is not None], [f for _, f in symbols]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("twice"),
                    faults.count("cut"), sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(symbols)),
                    cost, audit, sha("\n".join(lines))))
    return sorted(out, key=repr)


def test_runs_give_the_cheapest_and_least_audit():
    rnd, fault = random.Random(5), {"fine": 0, "cut": 4, "twice": 8, "blank": 12}
    for _ in range(1500):
        symbols = [s for _ in range(rnd.randint(0, 6)) for s in [(rnd.choice("suax"), rnd.choice(["fine", "fine", *fault]))] * rnd.choice([1, 1, 2, 3, 7])][:14]
        runs = [("suax".index(k) + fault[f], len(list(g))) for (k, f), g in itertools.groupby(symbols)]
        assert conversation_repair.solve(runs) == cheapest(tuple(symbols)), symbols


def test_long_runs_are_passed_in_steps_of_powers():
    n = 3_000_001
    assert conversation_repair.solve([(1, n), (8, n), (2, n)])[0] == 2 * (n - 1) + 3 * n  # the odd ones meet, every second other is made the other role
    for cut in (1, 2, 7):  # a run in parts is the run
        assert conversation_repair.solve([(1, 40)]) == conversation_repair.solve([(1, cut), (1, 40 - cut)])


@pytest.mark.parametrize("folder", FOLDERS)
def test_repair_of_a_whole_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(QUERIES["op11_conversation_repair"](spark, folder), REPAIR) == plain_repair(rows)


def test_repair_of_edge_rows(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice([None, 1, 2, 3, 4, -5]), rnd.choice([None, 0, 1, 2, 3, 4, 5, 2**40]),
             rnd.choice([None, "", "user", "assistant", "system", "assistant", "tool", "Ü"]),
             rnd.choice([None, "", " \n", "a.", "b?", "c", "d! ", "é", "w. " * 300_000])) for _ in range(60)] + [(77, 3, "user", "same.")] * 9
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'x' AS conv", "1 AS digest", "2 AS n", "'y' AS audit").repartition(5)
    assert result(conversation_repair.repair_damaged(df), REPAIR) == plain_repair(rows)
    assert conversation_repair.repair_damaged(df.where("1 = 0")).count() == 0


def test_repair_of_a_conversation_cut_into_ranges(spark):
    """One conversation holds nearly all rows and lies in several ranges."""
    rows = [(1, t, "user" if t % 3 else "assistant", f"{t % 50}.") for t in range(3000)] + [(c, 0, "system", "s.") for c in range(2, 9)]
    got = result(conversation_repair.repair_damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), REPAIR)
    assert [g for g in got if g[0] > 1] == plain_repair([r for r in rows if r[0] > 1])
    after = list(plain_damage(rows))
    own, seen, symbols = sorted((t, r, x) for c, t, r, x in after if c == 1), set(), []
    for _, role, text in own:
        symbols.append(("suax".index(role[0])) + (12 if not text else 8 if (role, text) in seen else 0 if text.endswith(".") else 4))
        seen.add((role, text))
    cost, audit = conversation_repair.solve([(s, 1) for s in symbols])
    mine = next(g for g in got if g[0] == 1)
    assert mine[6:8] == (cost, audit) and mine[2:5] == tuple(sum(s // 4 == f for s in symbols) for f in (3, 2, 1))


# --- Merkle manifest -----------------------------------------------------------------------------------------------

MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def plain_manifest(rows):
    def leaf(row, add=0):
        doc, source, lang, n, text = row
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n if n is None else n + add, text)])

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def path(tree, i):
        for level in tree[:-1]:
            yield ([level[i ^ 1]] if i ^ 1 < len(level) else []), i % 2
            i //= 2
    trees = {}
    for lang in sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode())):
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = own, levels([leaf(r) for r in own])
    top, out = levels([tree[-1][0] for _, tree in trees.values()]), []
    for k, (own, tree) in enumerate(trees.values()):
        for i, row in enumerate(own):
            proof = [*path(tree, i), *path(top, k)]
            folded = leaf(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0)
            for others, on_the_left in proof:
                folded = sha(*others, folded) if on_the_left else sha(folded, *others)
            root = top[-1][0]
            out.append((row[0], leaf(row), tree[-1][0], root, sha(*[d for others, _ in proof for d in others]), folded, folded == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("height", [10, 2])
@pytest.mark.parametrize("folder", FOLDERS)
def test_manifest_of_a_whole_table(spark, folder, height, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*merkle.FIELDS).collect()]
    got = result(QUERIES["op12_merkle"](spark, folder), MANIFEST)
    assert got == plain_manifest(rows) and 0 < sum(not r[-1] for r in got) < len(got) / 4


@pytest.mark.parametrize("height", [10, 2])
def test_manifest_of_edge_rows(spark, height, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rnd = random.Random(3)
    langs = [None, "", "é", "z", "𐥀", "￿"] + [f"l{i}" for i in range(20)]
    rows = [(rnd.choice([None, 1, 2, 3, -5]), rnd.choice([None, "", "s"]), rnd.choice(langs), rnd.choice([None, 3]),
             rnd.choice([None, "", "a", "long " * 200_000])) for _ in range(150)] + [(9, "s", "z", 1, "same")] * 30
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").selectExpr(
        "*", "'x' AS leaf", "1 AS place", "2 AS size", "'y' AS group")
    assert result(merkle.document_manifest(df), MANIFEST) == plain_manifest(rows)
    assert merkle.document_manifest(df.where("1 = 0")).count() == 0
    assert result(merkle.document_manifest(df.limit(1)), MANIFEST) == plain_manifest([tuple(r)[:5] for r in df.limit(1).collect()])


# --- token counts --------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(token_counts.vocabulary_path())


def library_sizes(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("folder", FOLDERS)
def test_counts_of_a_whole_table(spark, library, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r[0], len((r[1] or "").encode()), n, n > 512) for r, n in zip(rows, library_sizes(library, [r[1] for r in rows])))
    assert sorted(map(tuple, QUERIES["op13_token_counts"](spark, folder).collect())) == want


def test_whole_tokens_encode_alone_as_themselves(library):
    vocab = token_counts.vocabulary(token_counts.vocabulary_path())
    whole = sorted(token_counts.whole_tokens(vocab))
    assert len(whole) > 45_000 and set(library_sizes(library, whole)) == {1}


@pytest.mark.parametrize("stretch", [1 << 20, 3])
def test_counts_of_odd_texts(library, stretch, monkeypatch):
    """Special strings, contractions, blanks, and characters that Unicode versions class differently, in any order."""
    monkeypatch.setattr(token_counts, "STRETCH", stretch)
    rnd, sizes = random.Random(1), None
    vocab = token_counts.vocabulary(token_counts.vocabulary_path())
    sizes = token_counts.Sizes(vocab, token_counts.whole_tokens(vocab))
    pool = ["<|endoftext|>", "<|endo", " ", "  ", "\n", "\t", "'s", "'ll", "'", "a", "é", "ß", "中", " ", " ", "1", "²", "½", "٣", "!", "...",
            "\U0001f600", "́", "﻿", "\x00", "word", "tion", "՘", "࢏", "₏", "᠎", "\x85", "\x1c", "​"]
    pool += [chr(c) for c in rnd.sample([c for c in range(0x300, 0x110000) if not 0xD800 <= c < 0xE000], 300)]
    texts = ["".join(rnd.choices(pool, k=rnd.randint(1, 20))) for _ in range(5000)]
    assert [sizes.of(t) for t in texts] == library_sizes(library, texts)


def test_counts_of_edge_rows(spark, library):
    texts = [None, "", " ", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", " " * 1_000_000 + "x", "\n" * 2_000_000, "a" * 1_000_000, "one", "one", "word " * 400_000]
    rows = [(None if i == 8 else i % 9, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS n_tokens", "1 AS key", "2 AS n_bytes")
    want = sorted(((k, len((t or "").encode()), n, n > 512) for (k, t), n in zip(rows, library_sizes(library, texts))), key=repr)
    assert sorted(map(tuple, token_counts.token_counts(df).collect()), key=repr) == want
    assert token_counts.token_counts(df.where("1 = 0")).count() == 0
