"""Suffix-array dedup on bytes, with suffix arrays built by induced sorting.

Kinds of segments under an anchor (see ``repeats``) are laid end to end in shards. A shard's suffix array is made by induced
sorting: suffixes are classified as smaller or larger than their right neighbour, the substrings between leftmost smaller
ones are sorted (recursively where they tie), and all other suffixes are induced from them in two linear passes. Permuted
common prefixes then tell each suffix's common length with its predecessor: windows that share ``width`` bytes with a
neighbour are repeats.

The first level works bucket by bucket with numpy, the reduced strings below it with plain loops.

Defined results: null texts are empty; rows alike in id and text are one document, each of them with its result; texts
shorter than a window stay whole. Kept bytes need not be valid UTF-8, since a repeat may end inside a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tickweave.llm.common import real_id
from tickweave.llm.hashing import text_bytes
from tickweave.llm.repeats import Search, repeated, span_arrays, with_spans

WINDOW = 400
SEARCH = Search("bytes", WINDOW, (200, 300, 360, 400), hot_kinds=4000, shard_units=2_000_000)


def _smaller(t: np.ndarray) -> np.ndarray:
    """Whether a suffix is smaller than the next one; equal neighbours have the same class."""
    step = np.sign(np.diff(t.astype(np.int64)))
    n = len(t)
    where = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(where[::-1])[::-1]
    out = np.ones(n, bool)  # the end mark is smallest
    known = following < n
    out[:-1][known] = step[following[known]] > 0
    return out


def _dealt(buckets: list[list[np.ndarray]], t: np.ndarray, places: np.ndarray) -> None:
    """Appends places to the buckets of their characters, keeping their order."""
    if not len(places):
        return
    chars = t[places]
    order = np.argsort(chars, kind="stable")
    places, chars = places[order], chars[order]
    edges = np.flatnonzero(np.diff(chars)) + 1
    for c, part in zip(chars[np.concatenate([[0], edges])].tolist(), np.split(places, edges), strict=True):
        buckets[c].append(part)


def _induced(t: np.ndarray, seeds: np.ndarray, alphabet: int) -> np.ndarray:
    """All suffixes in order, from the order of the leftmost smaller ones."""
    larger: list[list[np.ndarray]] = [[] for _ in range(alphabet)]
    seeded: list[list[np.ndarray]] = [[] for _ in range(alphabet)]
    smaller: list[list[np.ndarray]] = [[] for _ in range(alphabet)]
    none = np.zeros(0, np.int64)
    _dealt(seeded, t, seeds)
    done: list[np.ndarray] = [none] * alphabet
    for c in range(alphabet):  # forward: larger suffixes follow from what stands before them
        front = np.concatenate(larger[c]) if larger[c] else none
        rows = [front]
        while len(front):
            before = front[front > 0] - 1
            front = before[t[before] == c]
            rows.append(front)
        done[c] = np.concatenate(rows)
        scan = np.concatenate([done[c], *seeded[c]])
        before = scan[scan > 0] - 1
        _dealt(larger, t, before[t[before] > c])
    out: list[np.ndarray] = []
    for c in range(alphabet - 1, -1, -1):  # backward: smaller ones follow from what stands behind them
        front = np.concatenate(smaller[c]) if smaller[c] else none
        rows = [front]
        while len(front):
            before = front[front > 0] - 1
            front = before[t[before] == c]
            rows.append(front)
        behind = np.concatenate(rows)
        scan = np.concatenate([behind, done[c][::-1]])
        before = scan[scan > 0] - 1
        before = before[t[before] < c]
        _dealt(smaller, t, before)
        if c == 0:
            behind = np.array([len(t) - 1])  # the end mark
        out.append(np.concatenate([done[c], behind[::-1]]))
    return np.concatenate(out[::-1])


def _names(t: np.ndarray, ordered: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Numbers for the sorted substrings between marks, equal ones alike."""
    end = np.full(len(t), len(t) - 1)
    end[marks[:-1]] = marks[1:]
    size = end[ordered] - ordered + 1
    differs = size[1:] != size[:-1]
    alike = np.flatnonzero(~differs)
    k = 0
    while len(alike):
        a, b = ordered[alike], ordered[alike + 1]
        wrong = t[a + k] != t[b + k]
        differs[alike[wrong]] = True
        alike = alike[~wrong & (size[alike] > k + 1)]
        k += 1
    return np.concatenate([[0], np.cumsum(differs)])


def suffix_array(t: np.ndarray, alphabet: int) -> np.ndarray:
    """Order of the suffixes of ``t``, whose last character is 0 and comes nowhere else."""
    if len(t) < 3:
        return np.arange(len(t))[::-1]
    if alphabet > 1024:
        return np.array(_plain(t.tolist(), alphabet))
    t = t.astype(np.uint16)  # a stable sort of short integers is a radix sort
    small = _smaller(t)
    marks = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    ordered = _induced(t, marks, alphabet)
    is_mark = np.zeros(len(t), bool)
    is_mark[marks] = True
    ordered = ordered[is_mark[ordered]]
    names = _names(t, ordered, marks)
    if names[-1] + 1 < len(marks):  # ties: sort the string of names
        of = np.zeros(len(t), np.int64)
        of[ordered] = names
        ordered = marks[suffix_array(of[marks], int(names[-1]) + 1)]
    return _induced(t, ordered, alphabet)


def _plain(t: list[int], alphabet: int) -> list[int]:
    """Induced sorting with loops, for reduced strings with many different names."""
    n = len(t)
    if n < 3:
        return [*range(n)][::-1]
    small = bytearray(n)
    small[n - 1] = 1
    for i in range(n - 2, -1, -1):
        small[i] = t[i] < t[i + 1] or (t[i] == t[i + 1] and small[i + 1])
    marks = [i for i in range(1, n) if small[i] and not small[i - 1]]
    sizes = [0] * alphabet
    for c in t:
        sizes[c] += 1
    tails, total = [0] * alphabet, 0
    for c in range(alphabet):
        total += sizes[c]
        tails[c] = total
    heads = [tails[c] - sizes[c] for c in range(alphabet)]

    def induced(seeds: list[int]) -> list[int]:
        out = [-1] * n
        at = tails[:]
        for i in reversed(seeds):
            c = t[i]
            at[c] -= 1
            out[at[c]] = i
        at = heads[:]
        for i in out:  # grows ahead of the loop
            if i > 0 and not small[i - 1]:
                c = t[i - 1]
                out[at[c]] = i - 1
                at[c] += 1
        at = tails[:]
        for r in range(n - 1, -1, -1):
            i = out[r]
            if i > 0 and small[i - 1]:
                c = t[i - 1]
                at[c] -= 1
                out[at[c]] = i - 1
        return out

    of, is_mark, end = [-1] * n, bytearray(n), {}
    for k, i in enumerate(marks):
        is_mark[i] = 1
        end[i] = (marks[k + 1] if k + 1 < len(marks) else n - 1) + 1
    name, before = -1, None
    ordered = [i for i in induced(marks) if is_mark[i]]
    for i in ordered:
        if before is None or t[i : end[i]] != t[before : end[before]]:
            name += 1
        of[i] = name
        before = i
    if name + 1 < len(marks):
        ordered = [marks[k] for k in _plain([of[i] for i in marks], name + 1)]
    return induced(ordered)


def common_prefixes(t: np.ndarray, order: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Permuted: for each place its predecessor in suffix order and their common length, which ends with either's piece.

    ``left`` is the number of characters up to the end of a place's piece.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    most = np.minimum(left, np.where(before >= 0, left[before], 0))
    # where the characters in front are equal, the length is one less than the one in front
    place = np.arange(n)
    fresh = (place == 0) | (before <= 0)
    fresh[1:] |= t[place[1:] - 1] != t[np.maximum(before[1:], 1) - 1]
    fresh[1:] |= left[:-1] <= 0
    at = np.flatnonzero(fresh)
    wide = np.zeros(n + 8, np.uint64)
    padded = np.concatenate([t.astype(np.uint64), np.zeros(16, np.uint64)])
    for k in range(4):  # four characters of up to 16 bits in one word
        wide[: n + 8] |= padded[k : k + n + 8] << np.uint64(16 * k)
    length = np.zeros(n, np.int64)
    live = at[most[at] > 0]
    k = 0
    while len(live):
        equal = wide[np.minimum(live + k, n + 7)] == wide[np.minimum(before[live] + k, n + 7)]
        stop = live[~equal]
        exact = np.full(len(stop), k)
        on = np.ones(len(stop), bool)
        for d in range(4):
            on &= padded[np.minimum(stop + k + d, n + 15)] == padded[np.minimum(before[stop] + k + d, n + 15)]
            exact += on
        length[stop] = exact
        live = live[equal]
        k += 4
        over = most[live] <= k
        length[live[over]] = k
        live = live[~over]
    length[at] = np.minimum(length[at], most[at])
    source = np.maximum.accumulate(np.where(fresh, place, 0))
    return before, np.minimum(np.maximum(length[source] - (place - source), 0), most)


def solve(pdf: pd.DataFrame, width: int) -> pd.DataFrame:
    """Stretches of the kinds with one row whose windows another kind holds too."""
    parts = [np.frombuffer(u, np.uint8) for u in pdf["units"]]
    sizes = np.array([len(p) + 1 for p in parts])
    ends = np.cumsum(sizes)
    t = np.ones(ends[-1] + 1, np.uint16)  # 0 ends the shard, 1 a piece, bytes follow from 2
    for p, e in zip(parts, ends.tolist(), strict=True):
        t[e - 1 - len(p) : e - 1] = p
        t[e - 1 - len(p) : e - 1] += 2
    t[-1] = 0
    piece = np.append(np.repeat(np.arange(len(parts)), sizes), len(parts) - 1)
    left = np.maximum(ends[piece] - 1 - np.arange(len(t)), 0)
    before, length = common_prefixes(t, suffix_array(t, 258), left)
    again = np.zeros(len(t), bool)
    hit = np.flatnonzero(length >= width)
    again[hit] = True
    again[before[hit]] = True
    at = np.flatnonzero(again & (pdf["n_rows"].to_numpy() == 1)[piece])
    run = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(piece[at]) != 0)])) if len(at) else np.zeros(0, np.int64)
    start, stop = at[run], at[np.append(run[1:], len(at)) - 1] + width if len(at) else at
    rows = pdf.iloc[piece[start]]
    base = rows["start"].to_numpy() + start - (ends - sizes)[piece[start]]
    return pd.DataFrame({"doc_id": rows["doc_id"].to_numpy(), "fp": rows["fp"].to_numpy(), "start": base.astype(np.int32), "stop": (base + (stop - start)).astype(np.int32)})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 512):
            part = batch.slice(first, 512)
            raw, offsets = text_bytes(part.column(1))
            data, gone, spans, kept = raw.tobytes(), [], [], []
            for i in range(part.num_rows):
                lo, hi = int(offsets[i]), int(offsets[i + 1])
                starts, stops = span_arrays(part.column(2), i)
                edges = [lo, *[lo + int(x) for s in zip(starts, stops, strict=True) for x in s], hi]
                kept.append(b"".join(data[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2)))
                gone.append(int((stops - starts).sum()))
                spans.append(len(starts))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def dedup_bytes(df: DataFrame, search: Search = SEARCH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` per row: bytes under windows that start elsewhere too are left out of ``kept``."""
    docs, spans = repeated(df, search, lambda pdf, w=search.width: solve(pdf, w), False, doc_id, text)
    out = with_spans(docs, spans).select("doc_id", "text", "spans").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(real_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")
