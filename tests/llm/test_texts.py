"""Operators 2, 3, 4, 6, 7, 8 and 9 against plain versions and edge cases."""

import base64
import bz2
import gzip
import lzma
import math
import random
import re
import zlib
from fractions import Fraction
from urllib.parse import quote

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tickweave.llm import bpe, chat, mixing, quality, secrets, topk, urls
from tickweave.llm.queries import MIX_WEIGHTS, URL_RULES, mix_levels

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ENC = bpe.encoder(PATH, public_tokenizers.PATTERN)
TRUE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ENC.ranks, special_tokens={})
TEXTS = ["", "a", "don't  stop\n\n 'll re'", "漢字 और é", "a" * 700, " " * 300 + "x", "<|endoftext|>", "th" * 400 + "1234567", "\x1c\x85\xa0 　 tab\t\tend "]


def test_bpe_joins_anywhere():
    rng = random.Random(1)
    parts = ["a", "aa", " ", "  ", "\n", "'", "s", "'re", "th", "1", "é", "the", "ing", "!", "漢", "x" * 50]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.choice([5, 60, 200])))
        got = [t for p in ENC.pieces(text, rng.choice([1, 2, 3, 7, 16])) for t in ENC.match(p)]
        assert got == TRUE.encode_ordinary(text)
    for text in TEXTS + ["ea" * 3000, "".join(rng.choice("ea") for _ in range(4000))]:
        assert ENC.encode(text) == TRUE.encode_ordinary(text)
        assert ENC.decode(ENC.encode(text)).decode() == text


@pytest.mark.parametrize("split", [1 << 18, 5])
def test_bpe_documents(spark, split):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, None), (None, "null id text"), (7, TEXTS[7]), (7, TEXTS[7])]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, node int")
    got = sorted(((r.doc_id or -1), r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in bpe.encode_documents(df, PATH, public_tokenizers.PATTERN, split_chars=split).collect())
    want = sorted((i or -1, len(x := TRUE.encode_ordinary(t or "")), bpe._packed(x), (t or "").encode()) for i, t in rows)
    assert got == want
    assert bpe.encode_documents(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_secret_layers():
    inner = 'token = "abcDEF123456"'
    wrapped = base64.b64encode(gzip.compress(quote(base64.b64encode(inner.encode()).decode()).encode())).decode()
    text = f"é see {wrapped} and AKIA{'Z9' * 10} secret:short password=longenough {'0af' * 9}"
    base, spans, layers, _ = secrets.scan_text(text)
    assert {(k, text[a:b]) for k, a, b in base} >= {("access", "AKIA" + "Z9" * 10), ("assign", "password=longenough"), ("hex", "0af" * 9)}
    assert set(base) <= set(spans) and any(k == "assign" and text[a:b] == wrapped for k, a, b in spans) and layers >= 2
    esc = "x pass\\u0077ord\\u003d12345678 y"
    assert [esc[a:b] for _, a, b in secrets.scan_text(esc)[1]] == ["pass\\u0077ord\\u003d12345678"]
    assert secrets.redacted("pw password=12345678 end", "#") == "pw # end"
    loop = quote(quote("token%3Dabcdefgh"))
    assert [loop[a:b] for _, a, b in secrets.scan_text(loop)[1]] == [loop]
    assert secrets.scan_text(None) == ([], [], 0, 0) == secrets.scan_text("")


def test_secrets_in_large_layers(monkeypatch):
    monkeypatch.setattr(secrets, "MAX_LAYER", 1 << 14)
    b64 = lambda data: base64.b64encode(data).decode()
    rng = np.random.default_rng(0)
    prose = " ".join(map(str, rng.integers(0, 999, 40_000))).encode()
    for at in (0, 40_000, 65_530, len(prose)):
        body = prose[:at] + b" password = longenough " + prose[at:]
        for data in (gzip.compress(body), gzip.compress(gzip.compress(body)), gzip.compress(zlib.compress(bz2.compress(body)))):
            run = b64(data)
            assert ("assign", 2, 2 + len(run)) in secrets.scan_text(f"x {run} y")[1]
    inner = b64(gzip.compress(rng.bytes(10_000) + b"token=abcdefgh"))  # a run that a stretch of 16 KiB would cut
    run = b64(gzip.compress(prose[:12_000] + b" " + inner.encode() + b" " + prose))
    assert ("assign", 0, len(run)) in secrets.scan_text(run)[1] and secrets.scan_text(run)[3] == 0
    assert secrets.scan_text(b64(gzip.compress(b"ab" * 100_000)))[3] > 0  # a run too long for one piece is counted


def test_secrets_wrapped_members_and_bytes():
    lines = lambda run, width, end="\n": end.join(run[k : k + width] for k in range(0, len(run), width))
    b64 = lambda data: base64.b64encode(data).decode()
    noise = np.random.default_rng(1).bytes(500)
    for width, end in ((64, "\n"), (76, "\r\n")):
        for head, tail in (("", ""), ("key: ", "\nand so on"), ("-----BEGIN CERTIFICATE-----\n", "\n-----END CERTIFICATE-----")):
            plain = lines(b64(b"some words before it " * 2 + b"the password=longenough " + b"and some more " * 9), width, end)
            assert any(k == "assign" for k, *_ in secrets.scan_text(head + plain + tail)[1])
            packed = lines(b64(gzip.compress(noise + b" password=longenough")), width, end)
            assert any(k == "assign" and (head + packed + tail)[a:b].startswith(packed[:-76]) for k, a, b in secrets.scan_text(head + packed + tail)[1])
    for pack in (gzip.compress, bz2.compress, lzma.compress):
        run = b64(pack(b"first") + pack(b"password=longenough"))
        assert ("assign", 0, len(run)) in secrets.scan_text(run)[1]
    run = b64("Clé password=longenough é".encode("latin-1"))
    assert [k for k, *_ in secrets.scan_text(run)[1]] == ["assign"]
    run = b64(gzip.compress("Clé password=longenough é".encode("latin-1")))
    assert secrets.scan_text(run)[1] == [("assign", 0, len(run))]
    assert [k for k, *_ in secrets.scan_text("caf%E9%70assword=longenough")[1]] == ["assign"]


def test_secrets_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "", "a"), (2, "token: abcdefgh", "b"), (2, "token: abcdefgh", "b")], "doc_id long, text string, base string")
    assert sorted((r.doc_id, r.spans) for r in secrets.scan_secrets(df).collect()) == [(1, ""), (1, ""), (2, "assign:0:15"), (2, "assign:0:15")]
    out = secrets.redact_secrets(df)
    assert out.columns == df.columns and {r.text for r in out.collect()} == {None, "", "[secret]"}


def test_chat_round_trip(spark):
    turns = [(1, 0, "user", "</s>[INST] \x10 <s>"), (1, 1, "user", ""), (1, 2, "assistant", "[NEXT]\x101\x10"), (1, 600, "assis\ntant", None), (2, None, None, "x"), (None, 1, "assistant", "y"), (1, 2, "assistant", "[NEXT]\x101\x10")]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, parts int")
    got = {r.conv_id: ([(t.role, t.text) for t in r.turns], r.masked) for r in chat.read_chat(chat.format_chat(df)).collect()}
    assert got == {
        1: ([("user", "</s>[INST] \x10 <s>"), ("user", ""), ("assistant", "[NEXT]\x101\x10"), ("assistant", "[NEXT]\x101\x10"), ("assis\ntant", "")], "[NEXT]\x101\x10" * 2),
        2: ([("", "x")], ""), None: ([("assistant", "y")], "y"),
    }
    assert chat.format_chat(df.limit(0)).count() == 0


def test_url_rules_and_list(spark):
    pages = [(1, "http://A.example.com/en/x?q"), (2, "https://www.example.com/en/"), (3, "x://b.net/es/"), (4, "http://c.org/p.html#f"), (5, None), (6, "nothing"), (4, "http://www.c.org/p/"), (7, "http://c.org/q")]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, block int")
    listing = spark.createDataFrame([("c.org/p",), ("c.org/p",), (None,)], "u string")
    got = sorted((r.page_id, r.rule or "", r.verdict) for r in urls.filter_urls(df, URL_RULES, listing).collect())
    assert got == [(1, "example.com/en/", "block"), (2, "www.example.com/en/", "allow"), (3, "net/es/", "block"), (4, "", "block"), (4, "", "block"), (5, "", "allow"), (6, "", "allow"), (7, "", "allow")]
    assert {r.verdict for r in urls.filter_urls(df.filter("page_id > 3"), URL_RULES, listing.limit(0)).collect()} == {"allow"}
    many = spark.range(4000).select(F.concat(F.lit("u"), "id").alias("u"))
    inside, outside = urls.listed(many, "u", many.filter("cast(substring(u, 2) AS int) % 3 = 0"))
    assert inside.count() == 1334 and outside.count() == 2666


def test_quality_counts(spark):
    rng = random.Random(2)
    texts = [None, "", " \n ", "a b", "x y z " * 40, "one\n\none\n# two $\none", " ".join(rng.choice("abcdefgh") for _ in range(300)), " ".join(f"v{rng.random()}" for _ in range(80)), "\x0bword\x1cword é漢"]
    df = spark.createDataFrame([(i, t, rng.choice(["en", None, "xx"]), 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, quality_words int")
    for r in quality.quality_rules(df).collect():
        t = texts[r.doc_id] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        twice = {k + d for k, g in enumerate(grams) if grams.count(g) > 1 for d in range(5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(twice))
        assert r.base_failed == (len(w) < 10 or 100 * len(twice) > 20 * len(w)) and (r.kept is False or not r.base_failed)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.quality_rules(df).filter("kept").collect()}
    assert quality.quality_rules(df.limit(0)).count() == 0 == quality.keep_good(df.limit(0)).count()


def test_quality_distances(spark):
    rng = random.Random(8)
    prose = quality.COMMON_WORDS["en"] + ["river", "stone", "Walked,", "cloud.", "green"]
    pick = lambda words, n: " ".join(rng.choice(words) + rng.choice("abcdefgh") * (k % 5 == 0) for k in range(n))
    texts = [pick(prose, 120) for _ in range(12)]
    texts += [" ".join(f"x{rng.random()}" for _ in range(60)) for _ in range(3)] + [pick(["$$#", "&%|", "12345", "the"], 90), pick(["漢字", "é"], 150), pick(prose, 30), pick(["of"], 100) + " end"]
    docs = [(i, t, "en" if i % 4 else rng.choice(["de", None, "xx"])) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    patterns = ["[A-Z]", "[0-9]", "[#*$%&|<>]", r"[.,;:!?'\"()\[\]{}/_=+@~^`\\-]", r"[^\x00-\x7F]", r"[\x20\x09-\x0D]"]
    counts = {}
    for i, t, lang in docs:
        key = lang if lang in quality.COMMON_WORDS else ""
        words, listed = re.findall(r"[^\x20\x09-\x0D]+", t), quality.COMMON_WORDS.get(key, [])
        chars = [len(re.findall(p, t)) for p in patterns]
        hits = [words.count(w) for w in listed]
        counts[i] = key, [*chars, len(t) - sum(chars)], [*hits, len(words) - sum(hits)], len(t), len(words)

    def distance(i, which):
        key, own = counts[i][0], counts[i][which]
        ref = [sum(c[which][k] for c in counts.values() if c[0] == key) for k in range(len(own))]
        p, q = [x / sum(own) for x in own], [x / sum(ref) for x in ref]
        half = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x) / 2
        return math.sqrt(max(0.0, half(p, q) + half(q, p)))

    verdicts = set()
    for r in quality.quality_rules(df).collect():
        chars = distance(r.doc_id, 1) if counts[r.doc_id][3] >= 200 else None
        words = distance(r.doc_id, 2) if counts[r.doc_id][4] >= 50 else None
        for got, want in ((r.class_distance, chars), (r.word_distance, words)):  # too short for a distance: greatest() makes the null 0
            assert got in (None, 0.0) if want is None else got == pytest.approx(want, abs=1e-7)
        odd = (chars is not None and chars > 0.34) or (words is not None and words > 0.45)
        assert r.kept == (not r.base_failed and not odd)
        verdicts.add((r.base_failed, odd))
    assert {(False, True), (False, False)} <= verdicts


def test_mixture(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * 3 for _ in range(rng.randrange(30))) if i % 17 else None, rng.choice(["en", "de", None]), f"src{min(i % 40, 5)}" if i % 19 else None) for i in range(400)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, tokens int")
    levels = mix_levels()
    plan = mixing.plan(df, levels, MIX_WEIGHTS, 0.6).collect()
    total = sum(p.tokens for p in plan)
    assert sum(p.budget for p in plan) <= int(total * 0.6) <= sum(p.budget for p in plan) + 40 and all(p.budget <= 2 * p.tokens for p in plan)
    out = mixing.mix(df, levels, MIX_WEIGHTS, 0.6)
    taken = {}
    for r in out.collect():
        taken[r.source] = taken.get(r.source, 0) + len((r.text or "").split())
    want = {}
    for p in plan:
        want[p.source or None] = want.get(p.source or None, 0) + p.budget
    assert out.columns == df.columns and all(want[s] - 30 * 9 <= n <= want[s] for s, n in taken.items())
    assert mixing.mix(df.limit(0), levels, MIX_WEIGHTS, 0.6).count() == 0


@pytest.mark.parametrize("block, slab", [(16384, 2048), (20, 3)])
def test_top_k(spark, block, slab):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1.0, 0.25, 0.5, 0.0, rng.uniform(-2, 2)]) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, rows[7][1]) for i in range(30)] + [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6), (304, [float("inf")] * 6), (305, [1.0] * 3), (7, rows[7][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, block int")
    q = topk.quantised(df)
    got = {}
    for r in topk.top_k(q, q.filter("vec_id % 10 = 0"), 10, block, slab).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    vecs = [(r.vec_id, r.v) for r in q.collect()]  # the row 7 is there twice and counts twice
    for i, own in ((i, v) for i, v in vecs if i % 10 == 0):
        best = sorted((-sum(a * b for a, b in zip(own, v)), j) for j, v in vecs if j != i and len(v) == len(own))[:10]
        assert sorted(got.get(i, [])) == [(n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert topk.top_k(q.limit(0), q.limit(0)).count() == 0


def test_top_k_of_repeated_rows(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, 0.5, 0.25]) for _ in range(4)]) for i in range(40)]
    rows += [rows[3]] * 25 + [rows[8]] * 2 + [rows[10]] * 3 + [(10, [2.0] * 4), (20, rows[20][1])]  # 10 asks in two ways
    q = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    vecs = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want = []
    for i, v in vecs:
        if i % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vecs if j != i)[:10]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    for block in (16384, 7):
        got = topk.top_k(q, q.filter("vec_id % 10 = 0"), 10, block, 2).select("query_id", "rank", "vec_id", "score")
        assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("kind, largest", [("float", 3e38), ("double", 1e30)])
def test_top_k_of_large_components(spark, kind, largest):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(5)]) for i in range(40)]
    rows += [(40 + i, [rng.uniform(-2, 2) * rng.choice([1.0, 2e5, 1e9, 1e18, largest / 2]) for _ in range(5)]) for i in range(60)]
    rows += [(100, [131072.0, 0.0, 0.0, 0.0, 0.0]), (101, [-131072.0, 1.0, 0.0, 0.0, 0.0]), (102, [largest] * 5), (103, [-largest] * 5)]
    rows += [(104, [float("inf")] + [0.0] * 4), (200, [100_000.0] * 600), (201, [100_000.0] * 600), (202, [-100_000.0] * 600)]  # 600 squares pass 2**63
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    vecs = {r.vec_id: [math.floor(Fraction(x) * 1024) for x in r.embedding] for r in df.collect() if r.vec_id != 104}
    q = topk.quantised(df)
    got = {}
    for r in topk.top_k(q, q.filter("vec_id % 20 < 3"), 7, 100, 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, int(r.wide_score) if r.score is None else r.score))
    assert set(got) == {i for i in vecs if i % 20 < 3}
    for i in got:
        best = sorted((-sum(a * b for a, b in zip(vecs[i], v)), j) for j, v in vecs.items() if j != i and len(v) == len(vecs[i]))[:7]
        assert sorted(got[i]) == [(n + 1, j, -s) for n, (s, j) in enumerate(best)]
