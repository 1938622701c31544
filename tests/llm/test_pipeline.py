"""The pipeline as a whole against five plain stages, and secrets against a plain recursion over layers."""

import base64
import bz2
import gzip
import hashlib
import lzma
import os
import random
import struct
import time
import zlib
from collections import Counter
from urllib.parse import quote

import public_tokenizers
import pytest
import tiktoken
import zstandard
from llm import plain
from llm.conftest import near_groups

import corpus_pipeline
from tickweave.llm import bpe, quality, secrets
from tickweave.llm.queries import MIX_DOMAINS, MIX_WEIGHTS, VOCABULARY

SMALLEST = "/root/testdata/sf0.001"
SECRETS = ["password=longenough", 'api_key: "Zz09+/._=-x"', "AKIA" + "Q7" * 9, "0123456789abcdef" * 2, "token=short", "secret : 'abcdefgh'", "passwd = é", "tokentoken=abcdef password=b password=abcdefg", "AKIAAKIA" + "A" * 14]


def b64(data):
    return base64.b64encode(data).decode()


WRAPS = [
    lambda t: b64(t.encode()), lambda t: base64.urlsafe_b64encode(t.encode()).decode().rstrip("="), lambda t: quote(t), lambda t: "".join(f"%{b:02x}" for b in t.encode()),
    lambda t: "".join(f"\\u{ord(c):04x}" for c in t), lambda t: b64(gzip.compress(t.encode(), mtime=0)), lambda t: b64(bz2.compress(t.encode())), lambda t: b64(zlib.compress(t.encode())),
    lambda t: b64(lzma.compress(t.encode())), lambda t: b64(zstandard.ZstdCompressor().compress(t.encode())), lambda t: b64(gzip.compress(zlib.compress(t.encode()), mtime=0)), lambda t: b64(t.encode("latin-1", "replace")),
]


def wrapped(rng, depth=3):
    t = f"{rng.choice(['', 'x ', 'é, ', 'see: '])}{rng.choice(SECRETS)}{rng.choice(['', ' end', ', é'])}"
    for _ in range(rng.randrange(depth + 1)):
        t = rng.choice(["", "so ", "%41 "]) + rng.choice(WRAPS)(t) + rng.choice(["", " on", "="])
    return t


def test_secret_spans_equal_a_plain_recursion():
    rng = random.Random(11)
    deep = 0
    for n in range(400):
        text = " ".join(rng.choice(["word", "naïve", "%zz", "\\u12", "aa%20b", wrapped(rng)]) for _ in range(rng.randrange(1, 6)))
        base, spans, _, over = secrets.scan_text(text)
        assert spans == plain.secret_spans(text), text
        assert sorted(base) == sorted(plain.secrets_of(text)) and over == 0
        assert secrets.redacted(text, "[secret]") == plain.without_secrets(text)
        deep += len(spans) > len(base)
    assert deep > 60


def test_compressed_over_and_over_is_cheap():
    run = b64(gzip.compress(gzip.compress(bytes(100 << 20) + b"password=longenough")))
    began = time.monotonic()
    assert secrets.scan_text(f"x {run} y")[1] == [("assign", 2, 2 + len(run))]
    assert time.monotonic() - began < 5  # half a second where nothing else runs; 40 before


def test_idle_bytes_do_not_hide_neighbours(monkeypatch):
    monkeypatch.setattr(secrets, "BLOCK", 1 << 8)
    for filler in (b"\0", b"~", b" ", b"a", b".", b"\n"):
        for n in (255, 256, 257, 1024, 5000):
            for body in (filler * n + b" password=longenough", b"password=longenough " + filler * n, b"password" + filler * n + b"=longenough", b"token=abc" + filler * n + b"def"):
                run = b64(gzip.compress(body, mtime=0))
                want = {kind for kind, *_ in plain.secrets_of(body.decode())}
                assert {kind for kind, *_ in secrets.scan_text(f"({run})")[1]} == want, body[:300]


def test_what_is_not_decoded_is_taken_out(monkeypatch):
    monkeypatch.setattr(secrets, "MAX_DEPTH", 3)
    data = b"password=longenough"
    for _ in range(5):
        data = gzip.compress(data)
    text = f"left {b64(data)} right"
    assert secrets.scan_text(text)[1:] == ([], 0, 1) and secrets.redacted(text, "#") == "left # right"


def planted():
    """Prose in two languages with near copies, junk, secrets in layers, and texts without words."""
    rng = random.Random(5)
    listed = {k: quality.COMMON_WORDS[k] for k in ("en", "de")}
    prose = lambda lang, n: " ".join(rng.choice(listed[lang]) if rng.random() < 0.45 else f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.choice(['', 'en', 'er', 'ing'])}" for _ in range(n))
    docs = []
    for i in range(90):
        lang = rng.choice(["en", "en", "de"])
        text = prose(lang, rng.randrange(12, 160))
        if i % 6 == 1:
            cut = rng.randrange(len(text))
            text = f"{text[:cut]} {wrapped(rng)} {text[cut:]}"
        docs.append((i, text, lang, f"src{i % 7 if i % 3 else 0}" if i % 11 else None))
    for i in range(30):  # copies, some with words changed
        _, text, lang, source = docs[rng.randrange(60)]
        words = text.split(" ")
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = "other"
        docs.append((200 - i, " ".join(words), lang, source))
    docs += [(300, None, "en", "src1"), (301, "", None, None), (302, "too short", "en", "src1"), (303, "$$# &%| <> ** " * 30, "en", "src2"), (304, "one two three four five six " * 20, "de", "src0")]
    return [{"doc_id": i, "text": t, "lang": lang, "source": s, "n_chars": len(t or "")} for i, t, lang, s in docs]


def five_plain_stages(docs):
    kept = plain.good(docs, quality.COMMON_WORDS)
    docs = [d for d in docs if d["doc_id"] in kept]
    after_rules = len(docs)
    groups = near_groups([(d["doc_id"], d["text"]) for d in docs])
    docs = [d for d in docs if groups[d["doc_id"]][1] == d["doc_id"]]
    after_dedup = len(docs)
    changed = 0
    for d in docs:
        clean = plain.without_secrets(d["text"])
        changed += clean != d["text"]
        d["text"] = clean

    def path(d):
        source = d["source"] or ""
        number = source[3:] if source.startswith("src") and source[3:].isdigit() else None
        return MIX_DOMAINS[int(number) % 3] if number else "other", d["lang"] or "", source

    taken = plain.mixture(docs, path, list(MIX_WEIGHTS.items()), 0.6)
    true = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.encoder(VOCABULARY, public_tokenizers.PATTERN).ranks, special_tokens={})
    out = Counter()
    for d in docs:
        ids = true.encode_ordinary(d["text"])
        row = d["doc_id"], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(d["text"].encode()).hexdigest()
        out[row] += taken[d["doc_id"]]
    return +out, (after_rules, after_dedup, changed)


def test_pipeline_equals_five_plain_stages(spark, tmp_path):
    docs = planted()
    spark.createDataFrame([tuple(d.values()) for d in docs], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want, (rules, dedup, changed) = five_plain_stages(docs)
    assert len(docs) > rules > dedup > 60 and changed > 8  # every stage has work to do
    assert Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == want


@pytest.mark.skipif(not os.path.exists(SMALLEST), reason="test tables are not there")
def test_pipeline_on_the_smallest_tables(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SMALLEST}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    want, _ = five_plain_stages(docs)
    assert Counter(map(tuple, corpus_pipeline.run(spark, SMALLEST).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == want


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
