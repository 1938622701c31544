"""Operators 11, 12 and 13 against plain versions and edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.llm import licenses, merkle, periods
from tickweave.llm.queries import with_planted_periods

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWERED = {c: c + 32 for c in range(65, 91)}


# ---- license scans


def plain_licenses(text, phrases, templates, min_pct, block):
    t = (text or "").translate(LOWERED)
    w = LICENSE_WORD.findall(t)
    places, base = [], set()
    for p, label in phrases.items():
        p = p.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    more, best = set(), 0.0
    for line in t.split("\n"):
        lw = LICENSE_WORD.findall(line)
        k = 0
        while True:
            b = set(lw[k : k + block])
            for label, text_ in templates:
                has = set(LICENSE_WORD.findall(text_.translate(LOWERED)))
                if has and 100 * len(has & b) >= min_pct * len(has):
                    more.add(label)
                    best = max(best, len(has & b) / len(has))
            if k + block >= len(lw):
                break
            k += block // 2
    return len(w), len(places), min(places, default=None), max(places, default=None), sorted(base), sorted(base | more), 1.0 if places else best


def scanned(df, **how):
    return [tuple(r) for r in licenses.scan_licenses(df, **how).collect()]


@pytest.mark.parametrize("min_pct", [60, 80, 100])
def test_license_join_loses_nothing(spark, min_pct):
    rng = random.Random(min_pct)
    words = [f"w{k}" for k in range(14)] + ["É", "x1"]
    weights = [2**-k for k in range(len(words))]  # common and rare words
    draw = lambda n: rng.choices(words, weights, k=n)
    templates = [(f"t{k % 7}", " ".join(draw(rng.randint(1, 9)))) for k in range(12)] + [("none", "  -- ")]
    texts = ["\n".join(rng.choice([" ", ", ", "-"]).join(draw(rng.choice([0, 3, 8, 20, 45, 90]))) for _ in range(rng.randint(1, 4))) for _ in range(150)]
    phrases = {"w0 w0": "twice", "w1 x1": "odd"}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r[0]: r[1:] for r in scanned(df, phrases=phrases, templates=templates, min_pct=min_pct, block_words=20)}
    assert got == {i: plain_licenses(t, phrases, templates, min_pct, 20) for i, t in enumerate(texts)}
    assert any(r[4] != r[5] for r in got.values())


def test_license_cases(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    rows = [
        (1, None), (2, ""), (3, "CC-BY cc.by"), (4, "All Rights\nReserved"), (5, "é" + "general public license"), (6, f"x {mit.upper()} y"),
        (7, mit.replace("hereby", "now")), (8, ("lorem ipsum " * 40_000) + mit + " lorem" * 50_000), (9, "all rights"), (None, "cc by"), (6, f"x {mit.upper()} y"), (10, "cc by-nc 4.0 licensed under"),
    ]
    df = spark.createDataFrame([(*r, "l", "w") for r in rows], "doc_id int, text string, label string, words string")
    got = sorted(scanned(df), key=str)
    want = sorted([(i, *plain_licenses(t, licenses.PHRASES, licenses.TEMPLATES, 90, 64)) for i, t in rows], key=str)
    assert got == want
    by_id = {r[0]: r for r in got}
    assert by_id[3][2:5] == (2, 0, 2) and by_id[4][5] == ["reserved"] and by_id[5][2] == 0
    assert by_id[6][6] == ["mit"] and by_id[7][6] == ["mit"] and by_id[8][6] == ["mit"] and by_id[10][6] == ["cc-by", "cc-by-nc-4.0"]
    assert scanned(df.limit(0)) == [] and len(scanned(df, templates=[])) == len(rows)
    with pytest.raises(ValueError):
        licenses.scan_licenses(df, templates=[("long", "a " * 40)])


def test_licenses_stay_native(spark):
    df = spark.createDataFrame([(1, "cc by")], "doc_id long, text string")
    plan = licenses.scan_licenses(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", plan)


# ---- periodic runs


def plain_runs(w, min_length=6, min_exponent=4):
    n, out = len(w), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_exponent * q):
                s = w[i : j + q]
                if not any(all(s[k] == s[k + p] for k in range(len(s) - p)) for p in range(1, q)):
                    out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [(6, 4), (3, 3), (9, 3), (2, 5)])
def test_runs_equal_plain_search(least):
    rng = random.Random(str(least))
    for _ in range(400):
        n = rng.randint(0, 50)
        w = rng.choices("abc"[: rng.randint(1, 3)], k=n)
        if n and rng.random() < 0.5:
            a, p = rng.randrange(n), rng.randint(1, 6)
            w = w[:a] + [w[min(n - 1, a + (i - a) % p)] for i in range(a, n)]
        if rng.random() < 0.4:
            w = w[:9] + rng.choices("abc", k=rng.randint(1, 4)) * rng.randint(3, 8) + w[9:] + rng.choices("ab", k=3) * 5
        assert periods.runs_of(w, *least) == plain_runs(w, *least)


def test_suffix_order():
    rng = random.Random(5)
    for n in [*range(1, 12), 60, 200]:
        w = rng.choices(range(3), k=n)
        order, common = periods.suffix_order(np.array(w))
        suffixes = sorted(range(n), key=lambda i: w[i:])
        assert order.tolist() == suffixes
        for k in range(1, n):
            a, b = w[suffixes[k - 1] :], w[suffixes[k] :]
            assert common[k] == next((x for x in range(min(len(a), len(b))) if a[x] != b[x]), min(len(a), len(b)))


def test_places_in_many_chunks():
    rng = random.Random(2)
    places = rng.sample(range(100_000), 6000)
    have, known = periods.Places(places[0]), [places[0]]
    for k, p in enumerate(places[1:], 1):
        before, after = have.add(p)
        if k % 97 == 0:
            assert before == max((x for x in places[:k] if x < p), default=None) and after == min((x for x in places[:k] if x > p), default=None)
    assert list(have) == sorted(places) and have.size == 6000


def test_run_documents(spark):
    long = " ".join(["x y z"] * 30_000 + ["end"])
    rows = [(1, None), (2, " \n\t"), (3, "go " * 6), (4, "go go go go go stop"), (5, "a b A B " + "c d e\x0bf " * 4 + "c d g"), (6, long), (None, "no " * 9), (3, "go " * 6)]
    df = spark.createDataFrame([(*r, 1, "r") for r in rows], "doc_id int, text string, n_words int, runs string")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periods.periodic_runs(df).collect()), key=str)
    want = []
    for i, t in rows:
        w = WORD.findall(t or "")
        runs = plain_runs(w) if len(w) < 1000 else [(0, 90_000, 3)]
        live = [not any(s + q <= k < s + n for s, n, q in runs) for k in range(len(w))]
        want.append((i, len(w), runs, " ".join(x for x, y in zip(w, live) if y)))
    assert got == sorted(want, key=str)
    assert periods.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.periodic_runs(df, min_exponent=2)


def test_planted_periods(spark):
    texts = [" ".join(f"w{k}" for k in range(n)) for n in range(400)]
    df = spark.createDataFrame([*enumerate(texts), (None, "a b"), (1000, None)], "doc_id long, text string")
    changed = 0
    for r in with_planted_periods(df).collect():
        if r.doc_id is None or r.doc_id == 1000:
            assert r.text in ("a b", "")
            continue
        w, h = texts[r.doc_id].split(), zlib.crc32(str(r.doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            changed += 1
        assert WORD.findall(r.text) == w
    assert changed > 20


# ---- Merkle manifest


def sha(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def plain_leaf(fields):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def plain_tree(leaves):
    paths, own, now = [[] for _ in leaves], [[i] for i in range(len(leaves))], leaves
    while len(now) > 1:
        runs = [now[k : k + 3] for k in range(0, len(now), 3)]
        for k, run in enumerate(runs):
            for j in range(len(run)):
                for i in own[3 * k + j]:
                    paths[i].append((run[:j], run[j + 1 :]))
        now, own = [sha(*run) for run in runs], [sum(own[k : k + 3], []) for k in range(0, len(own), 3)]
    return now[0], paths


def plain_manifest(rows, changed):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
    trees = [plain_tree([plain_leaf(r) for r in groups[s]]) for s in names]
    root, above = plain_tree([t[0] for t in trees])
    out = []
    for s, (subroot, paths), up in zip(names, trees, above):
        for r, path in zip(groups[s], paths):
            at, proof = plain_leaf(changed(r)), ""
            for left, right in path + up:
                at, proof = sha(*left, at, *right), proof + "".join(left + right)
            out.append((r[0], plain_leaf(r), subroot, root, proof, at, at == root))
    return out


def manifest_rows(df, **how):
    fields = ["doc_id", "source", "text"]
    text = F.replace("text", F.lit("\n"), F.lit(""))
    out = merkle.merkle_manifest(df, [F.col(c) for c in fields], found=[F.col("doc_id"), F.col("source"), text], **how)
    return [tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", merkle.proof_of("path"), "folded_root", "verified").collect()]


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest_equals_plain_trees(spark, height):
    rng = random.Random(height)
    sizes = {"hot": 250, "ü": 9, "z": 3, "y": 1, "": 10, None: 28, **{f"s{k}": 1 + k % 4 for k in range(12)}}
    rows = [(rng.randint(-5, 90) if rng.random() < 0.9 else None, s, rng.choice([None, "", "a\nb", "é", f"t{rng.random()}"])) for s, n in sizes.items() for _ in range(n)]
    rows += [(7, "hot", "same")] * 40  # repeated rows are leaves of their own
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, source string, text string, pos int, grp string, _file int").repartition(4)
    got = manifest_rows(df, height=height)
    assert sorted(got, key=str) == sorted(plain_manifest(rows, lambda r: (r[0], r[1], None if r[2] is None else r[2].replace("\n", ""))), key=str)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_small(spark):
    df = spark.createDataFrame([(1, None, None)], "doc_id long, source string, text string")
    [row] = manifest_rows(df)
    assert row == (1, plain_leaf((1, None, None)), row[1], row[1], "", row[1], True)
    assert manifest_rows(df.limit(0)) == []
    long = spark.createDataFrame([(1, "s", "x\n" * 2_000_000), (2, "s", "y")], "doc_id long, source string, text string")
    assert sorted(r[-1] for r in manifest_rows(long)) == [False, True]


@pytest.mark.parametrize("height", range(8))
def test_van_emde_boas_addresses(height):
    places = merkle.addresses(height)
    assert sorted(np.concatenate(places).tolist()) == list(range((3 ** (height + 1) - 1) // 2))
    assert places[0].tolist() == [0]
    if height >= 3:  # a lower subtree lies together
        top = (height + 1) // 2
        for k in range(3**top):
            below = [places[d][k * 3 ** (d - top) : (k + 1) * 3 ** (d - top)] for d in range(top, height + 1)]
            flat = sorted(np.concatenate(below).tolist())
            assert flat == list(range(flat[0], flat[0] + len(flat)))
