"""Substring dedup on words with fixed-block anchors.

Kinds of segments under one anchor (see ``repeats``) are compared like this: the reference's words are indexed by
non-overlapping blocks of half a window, every rolling window of a block's size probes the index, and where a probe hits,
the windows around it are extended word by word to the earliest equal one. A window of 20 words holds a whole block of 10,
wherever the blocks' grid lies, so no repeat is missed. Runs of equal windows are the maximal exact repeats.

Defined results: null and blank texts have no words and keep nothing; rows alike in id and text are one document, each of
them with its result; rows without id come before all others; texts below a window's length stay whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tickweave.llm.common import real_id
from tickweave.llm.hashing import U, grams, mixed, text_bytes, words
from tickweave.llm.repeats import Search, repeated, span_arrays, with_spans

WINDOW = 20
SEARCH = Search("words", WINDOW, (3, 12, 17, 20), hot_kinds=4000, shard_units=300_000)


def solve(pdf: pd.DataFrame, width: int) -> pd.DataFrame:
    """Stretches of the given kinds whose windows come earlier in another kind of the same anchor."""
    block = width // 2
    pdf = pdf.sort_values(["doc_id", "start"], kind="stable")
    parts = [np.frombuffer(u, U) for u in pdf["units"]]
    sizes = np.array([len(p) for p in parts])
    units, ends = np.concatenate(parts), np.cumsum(sizes)
    piece = np.repeat(np.arange(len(parts)), sizes)
    left = ends[piece] - np.arange(len(units))  # words up to the piece's end
    place = np.arange(len(units)) - (ends - sizes)[piece]
    group = mixed(pdf["anchor"].to_numpy().astype(np.int64).view(U))[piece]
    rolling = grams(units, block)
    probes = np.flatnonzero(left[: len(rolling)] >= block)
    keys = rolling[probes] ^ group[probes]
    # the index: blocks on a grid, with the first and last piece that has such a block
    grid = place[probes] % block == 0
    order = np.lexsort((piece[probes][grid], keys[grid]))
    index, owner = keys[grid][order], piece[probes][grid][order]
    if not len(index):
        return pd.DataFrame({"doc_id": [], "fp": [], "start": [], "stop": []}).astype({"doc_id": "int64", "fp": "int64", "start": "int32", "stop": "int32"})
    at = np.searchsorted(index, keys)
    last = np.searchsorted(index, keys, "right") - 1
    inside = last >= at
    other = inside & ((owner[np.minimum(at, len(index) - 1)] != piece[probes]) | (owner[np.maximum(last, 0)] != piece[probes]))
    # a window that repeats holds a whole block of the other's grid, so it lies around a hit
    hit = np.zeros(len(units) + 1, np.int64)
    hit[probes[other]] = 1
    near = np.concatenate([[0], np.cumsum(hit[:-1])])
    full = np.flatnonzero(left >= width)
    candidates = full[(near[full + width - block + 1] - near[full]) > 0]
    # extension: equal windows are found by hash and confirmed word by word against the earliest
    rolled = grams(units, width)
    key = rolled[candidates] ^ group[candidates]
    order = np.lexsort((candidates, key))
    c, k = candidates[order], key[order]
    new = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
    first = c[np.flatnonzero(new)][np.cumsum(new) - 1] if len(k) else c
    same = first != c
    for d in range(width):
        same &= units[c + d] == units[first + d]
    again = np.sort(c[same])
    run = np.flatnonzero(np.concatenate([[True], (np.diff(again) != 1) | (np.diff(piece[again]) != 0)])) if len(again) else np.zeros(0, np.int64)
    start, stop = again[run], again[np.append(run[1:], len(again)) - 1] + width if len(again) else again
    rows, base = pdf.iloc[piece[start]], place[start] + pdf["start"].to_numpy()[piece[start]]
    return pd.DataFrame({"doc_id": rows["doc_id"].to_numpy(), "fp": rows["fp"].to_numpy(), "start": base.astype(np.int32), "stop": (base + (stop - start)).astype(np.int32)})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            raw, offsets = text_bytes(part.column(1))
            starts, ends, first = words(raw, offsets)
            data, total, gone, kept = raw.tobytes(), np.diff(first), [], []
            for i in range(part.num_rows):
                live = np.ones(total[i], bool)
                for a, b in zip(*span_arrays(part.column(2), i), strict=True):
                    live[a:b] = False
                w = np.flatnonzero(live) + first[i]
                gone.append(int(total[i] - len(w)))
                kept.append(b" ".join([data[a:b] for a, b in zip(starts[w].tolist(), ends[w].tolist(), strict=True)]))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total.astype(np.int64)), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])


def dedup_substrings(df: DataFrame, search: Search = SEARCH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` per row: words whose window starts earlier elsewhere are left out of ``kept``."""
    docs, spans = repeated(df, search, lambda pdf, w=search.width: solve(pdf, w), True, doc_id, text)
    out = with_spans(docs, spans).select("doc_id", "text", "spans").mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string")
    return out.select(real_id().alias("doc_id"), "n_words", "n_removed", "kept")
