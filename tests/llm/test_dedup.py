"""Operators 1, 5 and 10 against brute force, with nulls, empty texts, ties, repeats, long texts and clashing columns."""

import importlib.util
import os
import random
from dataclasses import replace

import numpy as np
import pytest

from tickweave.llm import components, hashing, neardup, substrings, suffixes

spec = importlib.util.spec_from_file_location("brute", os.path.join(os.path.dirname(__file__), "conftest.py"))
brute = importlib.util.module_from_spec(spec)
spec.loader.exec_module(brute)

VOCAB = [f"w{i}" for i in range(60)] + ["Ünï", "THE", "the"]


def corpus(n=60, seed=3):
    rng = random.Random(seed)
    base = [" ".join(rng.choice(VOCAB) for _ in range(rng.randrange(1, 120))) for _ in range(n // 3)]
    docs = []
    for i in range(n):
        w = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, 9])):
            w[rng.randrange(len(w))] = rng.choice(VOCAB)
        docs.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    shared = " ".join(rng.choice(VOCAB) for _ in range(50))
    docs += [(n + k, f"{k} {shared} tail{k}") for k in range(12)]
    docs += [(n + 20, None), (n + 21, ""), (n + 22, " \n "), (n + 23, "a" * 3000), (n + 24, "one two"), (n + 25, "ONE two"), (n + 26, "x y " * 300)]
    return docs


def frame(spark, docs):
    """Rows with further columns whose names the operators use inside."""
    return spark.createDataFrame([(*d, 1, "x", 2.5) for d in docs], "doc_id long, text string, n int, kind string, node double").repartition(3)


def test_suffix_array_and_prefixes():
    rng = random.Random(0)
    for _ in range(150):
        s = [rng.randrange(2, 2 + rng.choice([1, 2, 26])) for _ in range(rng.randrange(60))] + [0]
        t = np.array(s, np.uint16)
        want = sorted(range(len(s)), key=lambda i: s[i:])
        assert suffixes.suffix_array(t, 258).tolist() == want
        assert suffixes._plain(s, 300) == want
        before, length = suffixes.common_prefixes(t, np.array(want), np.arange(len(s))[::-1])
        for a, b in zip(want, want[1:]):
            k = 0
            while s[a + k] == s[b + k]:
                k += 1
            assert (before[b], length[b]) == (a, k)


@pytest.mark.parametrize("hot", [4000, 3])
def test_repeated_bytes(spark, hot):
    search = replace(suffixes.SEARCH, width=40, gram_sizes=(20, 30, 36, 40), hot_kinds=hot, shard_units=3000)
    docs = corpus()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.dedup_bytes(frame(spark, docs), search).collect()}
    assert got == dict(zip([i for i, _ in docs], brute.repeated_bytes([t for _, t in docs], 40)))


@pytest.mark.parametrize("hot", [4000, 3])
def test_later_words(spark, hot):
    search = replace(substrings.SEARCH, hot_kinds=hot, shard_units=300)
    docs = corpus(seed=5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.dedup_substrings(frame(spark, docs), search).collect()}
    assert got == brute.later_words(docs, 20)


def test_near_duplicates(spark):
    docs = corpus(seed=7)
    rows = neardup.near_duplicates(frame(spark, docs)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.near_groups(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "STRAGGLERS", 2)
    monkeypatch.setattr(neardup, "CROWD", 3)
    rng = random.Random(1)
    words, docs = [f"v{k}" for k in range(400)], []
    for i in range(80):  # a chain: neighbours are linked, ends are not
        docs.append((i, " ".join(words)))
        at = rng.randrange(300)
        words[at : at + 18] = [f"v{rng.random()}" for _ in range(18)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(frame(spark, docs)).collect()}
    assert got == brute.near_groups(docs)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"r{k}" for k in range(90))
    df = frame(spark, [(5, text), (5, text), (None, text), (None, text), (4, "short")])
    near = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in neardup.near_duplicates(df).collect())
    assert near == [(-1, -1, True), (-1, -1, True), (4, 4, True), (5, 5, True), (5, 5, True)]
    assert neardup.keep_one(df).columns == df.columns
    assert sorted(r.doc_id or -1 for r in neardup.keep_one(df).collect()) == [-1, 4, 5]
    later = sorted((r.doc_id or -1, r.n_removed) for r in substrings.dedup_substrings(df).collect())
    assert later == [(-1, 0), (-1, 0), (4, 0), (5, 90), (5, 90)]
    sizes = sorted((r.doc_id or -1, r.n_removed) for r in suffixes.dedup_bytes(df, replace(suffixes.SEARCH, width=100, gram_sizes=(50, 100))).collect())
    assert sizes == [(-1, len(text)), (-1, len(text)), (4, 0), (5, len(text)), (5, len(text))]


def test_empty_tables(spark):
    df = frame(spark, [(1, "a")]).limit(0)
    assert suffixes.dedup_bytes(df).count() == substrings.dedup_substrings(df).count() == neardup.near_duplicates(df).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(200, 201)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(31)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}


def test_very_long_text_in_slices(monkeypatch):
    monkeypatch.setattr("tickweave.llm.repeats.SLICE", 500)
    from tickweave.llm import repeats

    rng = random.Random(2)
    raw = np.array([rng.randrange(97, 100) for _ in range(7000)], np.uint8)
    text, start, n, *_ = repeats.byte_segments(raw, np.array([0, len(raw)]), 40, 20)
    assert n.sum() == len(raw) - 39 and sorted(np.concatenate([np.arange(a, a + k) for a, k in zip(start, n)]).tolist()) == list(range(len(raw) - 39))
    assert len(hashing.grams(np.zeros(3, hashing.U), 5)) == 0


def test_registers_estimate():
    rng = np.random.default_rng(4)
    for n in (50, 400, 5000):
        sets = rng.integers(0, 2**63, (2, 2 * n), dtype=np.int64).view(hashing.U)
        a, b = np.unique(sets[0, :n]), np.unique(np.concatenate([sets[0, : int(0.8 * n)], sets[1, : int(0.2 * n)]]))
        ra, rb = neardup.registers(np.sort(hashing.mixed(a))), neardup.registers(np.sort(hashing.mixed(b)))
        j, sd = neardup.estimate(ra[None], rb[None], np.array([n]), np.array([n]))
        assert abs(j[0] - 2 / 3) < 5 * sd[0]


def thue_morse(n, flip=False):
    """A word of n letters for which, with its complement, polynomials modulo powers of two give one hash."""
    return "".join("ab"[(bin(k).count("1") + flip) % 2] for k in range(n))


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_that_polynomials_confuse(spark, n):
    one, two = thue_morse(n), thue_morse(n, True)
    docs = [(1, one), (2, two), (3, " ".join([one, *"cdefghijklmnopqrstuvwxyz"])), (4, " ".join([two, *"cdefghijklmnopqrstuvwxyz"]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df).collect()}
    assert got == {i: (len(s), c) for (i, s), c in zip(((i, brute.shingles(t)) for i, t in docs), (x[1] for x in brute.near_groups(docs).values()))}
    assert got[1][1] != got[2][1]
    kept = {r.doc_id: (r.n_removed, r.kept) for r in substrings.dedup_substrings(df).collect()}
    assert kept == {i: (n_, k) for i, (_, n_, k) in brute.later_words(docs, 20).items()}
    raw = np.frombuffer((one + " " + two).encode(), np.uint8)
    starts, ends, _ = hashing.words(raw, np.array([0, len(raw)]))
    assert len(set(hashing.word_hashes(raw, starts, ends).tolist())) == 2


def test_buckets_in_blocks(spark, monkeypatch):
    """Buckets cut into blocks of pairs of parts lose no likely pair."""
    docs = corpus(120, seed=8)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute.near_groups(docs)
    for block in (4096, 3, 1):
        monkeypatch.setattr(neardup, "BLOCK", block)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df).collect()} == want


def test_forest_holds_likely_pairs_together():
    rng = np.random.default_rng(4)
    base = [np.unique(rng.integers(0, 2**63, 300).astype(np.uint64)) for _ in range(6)]
    sets = [np.unique(np.concatenate([b[rng.random(len(b)) < p], rng.integers(0, 2**63, 20).astype(np.uint64)])) for b in base for p in (1, 0.95, 0.9, 0.6, 0.55, 0.5)]
    order = rng.permutation(len(sets))
    sets = [sets[k] for k in order]
    regs, n = np.array([neardup.registers(s) for s in sets]), np.array([len(s) for s in sets])
    shares, first = neardup._shares(n.astype(float)), np.array([0, 15, 17, 18, 36])
    bucket = np.repeat(np.arange(4), np.diff(first))
    pairs = [(i, j) for i in range(36) for j in range(i) if bucket[i] == bucket[j] and neardup._alike(regs, n, shares, np.array([i]), np.array([j]))[1][0]]
    told = [(int(a), int(b)) for x, y, _ in neardup._forest(regs, n, shares, first) for a, b in zip(x, y)]

    def groups(edges):
        label = list(range(36))
        for a, b in edges:
            label = [label[a] if x == label[b] else x for x in label]
        return label

    assert {(max(p), min(p)) for p in told} <= set(pairs) and len(told) == 36 - len(set(groups(told)))
    same = lambda label: {(i, j) for i in range(36) for j in range(i) if label[i] == label[j]}
    assert same(groups(told)) == same(groups(pairs))
