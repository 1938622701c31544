"""Finding stretches of ``width`` units (bytes or words) that documents hold more than once, without comparing pairs.

Every window of ``width`` units belongs to one segment: the run of neighbouring windows that share an anchor, the gram of
lowest hash inside them. Equal windows have equal anchors, so only segments under an anchor that comes twice can hold a
repeat. Equal segments fold into one kind with a count and its earliest place, before and after the shuffle. What is left
are anchors with several kinds; a solver compares these kinds' units exactly, in shards of bounded size. An anchor with very
many kinds is cut into shorter segments by a longer gram, and so on; with grams of a whole window each kind is one window,
and folding alone decides. So no group, however hot, is brought to one task, and no pair of documents is ever built.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickweave.llm.common import keyed, settled, unique_ids, used_up
from tickweave.llm.hashing import BYTES, POLY, SLICE, U, anchored, grams, mixed, text_bytes, word_hashes, words

SEGMENT = "doc_id long, fp long, start int, n int, anchor long, kind long"
_SEGMENT = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("anchor", pa.int64()), ("kind", pa.int64())])


@dataclass(frozen=True)
class Search:
    """What repeats are looked for and how: units are ``bytes`` or ``words``; grams lengthen level by level up to ``width``."""

    units: str
    width: int
    gram_sizes: tuple[int, ...]
    hot_kinds: int  # an anchor with more kinds goes to the next level
    shard_units: int


def byte_segments(raw: np.ndarray, offsets: np.ndarray, width: int, gram: int):
    """Segments of texts laid end to end: text number, start within the text, windows, anchor hash, kind hash."""
    out, d = [], 0
    while d < len(offsets) - 1:
        upto = min(len(offsets) - 1, max(d + 1, int(np.searchsorted(offsets, offsets[d] + SLICE))))
        if upto == d + 1 and offsets[upto] - offsets[d] > 4 * SLICE:  # a very long text, by overlapping slices
            lo, hi = int(offsets[d]), int(offsets[upto])
            for at in range(lo, hi - width + 1, SLICE):
                text, start, *rest = _slice_segments(raw[at : min(hi, at + SLICE + width - 1)], np.array([0, min(hi, at + SLICE + width - 1) - at]), width, gram)
                out.append((text + d, start + (at - lo), *rest))
        else:
            text, *rest = _slice_segments(raw[offsets[d] : offsets[upto]], offsets[d : upto + 1] - offsets[d], width, gram)
            out.append((text + d, *rest))
        d = upto
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 5


def _slice_segments(raw: np.ndarray, offsets: np.ndarray, width: int, gram: int):
    places = max(0, len(raw) - gram + 1)
    sums = POLY[0].sums(BYTES[0][raw])
    hashes = mixed((sums[gram : gram + places] - sums[:places]) * POLY[0].down[:places])
    text, start, n, anchor = anchored(hashes, offsets[:-1], np.diff(offsets) - width + 1, width - gram + 1)
    kinds = POLY[1].of(POLY[1].sums(BYTES[1][raw]), start, start + n + width - 1) + n.astype(U)
    return text, start - offsets[text], n, hashes[anchor], kinds


def word_segments(hashes: np.ndarray, first: np.ndarray, width: int, gram: int):
    """The same for words: their hashes, and the number of each text's first word (one more at the end)."""
    out, d = [], 0
    while d < len(first) - 1:
        upto = min(len(first) - 1, max(d + 1, int(np.searchsorted(first, first[d] + SLICE))))
        own, lo = hashes[first[d] : first[upto]], first[d : upto + 1] - first[d]
        g = grams(own, gram)
        text, start, n, anchor = anchored(g, lo[:-1], np.diff(lo) - width + 1, width - gram + 1)
        kinds = POLY[1].of(POLY[1].sums(own), start, start + n + width - 1) + n.astype(U)
        out.append((text + d, start - lo[text], n, g[anchor], kinds))
        d = upto
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 5


def _of_texts(column: pa.Array, search: Search, gram: int):
    raw, offsets = text_bytes(column)
    if search.units == "bytes":
        return byte_segments(raw, offsets, search.width, gram)
    starts, ends, first = words(raw, offsets)
    return word_segments(word_hashes(raw, starts, ends), first, search.width, gram)


def _pieces(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that hold a few megabytes of text each, whatever the texts' lengths."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _segments(search: Search, gram: int, only_anchor: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch):
                text, start, n, anchor, kind = _of_texts(part.column(2), search, gram)
                if only_anchor:
                    a, c = np.unique(anchor, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(c.astype(np.int64))], names=["anchor", "c"])
                else:
                    take = pa.array(text)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(take), part.column(1).take(take), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(kind.view(np.int64))], schema=_SEGMENT)

    return run


KIND = "anchor long, kind long, n_rows long, doc_id long, fp long, start int, n int, units binary"


def _extract(search: Search):
    """Units of the wanted segments of each text: its bytes, or its words' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch):
                raw, offsets = text_bytes(part.column(2))
                if search.units == "bytes":
                    units, first = raw, offsets
                else:
                    starts, ends, first = words(raw, offsets)
                    units = word_hashes(raw, starts, ends)
                wanted = part.column(3)
                rows = wanted.flatten()  # structs anchor, kind, n_rows, start, n
                text = np.repeat(np.arange(part.num_rows), np.diff(wanted.offsets.to_numpy()))
                start, n = rows.field("start").to_numpy(), rows.field("n").to_numpy()
                at = first[text] + start
                cut = [units[a : a + k + search.width - 1].tobytes() for a, k in zip(at.tolist(), n.tolist(), strict=True)]
                take = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [rows.field("anchor"), rows.field("kind"), rows.field("n_rows"), part.column(0).take(take), part.column(1).take(take), rows.field("start"), rows.field("n"), pa.array(cut, pa.binary())],
                    names=["anchor", "kind", "n_rows", "doc_id", "fp", "start", "n", "units"])

    return run


def _again(search: Search, gram: int):
    """Segments by a longer gram of segments whose units are at hand; the same columns, the units cut to fit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = [np.frombuffer(u, np.uint8 if search.units == "bytes" else U) for u in pdf["units"]]
            first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
            units = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
            cut = byte_segments if search.units == "bytes" else word_segments
            text, start, n, anchor, kind = cut(units, first, search.width, gram)
            at = first[text] + start
            yield pd.DataFrame({
                "anchor": anchor.view(np.int64), "kind": kind.view(np.int64), "n_rows": pdf["n_rows"].to_numpy()[text], "doc_id": pdf["doc_id"].to_numpy()[text], "fp": pdf["fp"].to_numpy()[text],
                "start": (pdf["start"].to_numpy()[text] + start).astype(np.int32), "n": n.astype(np.int32),
                "units": [units[a : a + k + search.width - 1].tobytes() for a, k in zip(at.tolist(), n.tolist(), strict=True)],
            })

    return run


INTERVAL = "doc_id long, fp long, start int, stop int"
Solver = Callable[[pd.DataFrame], pd.DataFrame]


def _solved(kinds: DataFrame, search: Search, solver: Solver) -> DataFrame:
    """Shards of whole anchors go to the solver; how many follows the amount of units."""
    total = kinds.agg(F.coalesce(F.sum(F.col("n") + search.width), F.lit(0))).first()[0]
    shards = max(1, -(-total // search.shard_units))
    return kinds.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInPandas(lambda pdf: solver(pdf), INTERVAL)


def _kinds(segments: DataFrame, *carried: str) -> DataFrame:
    """Folds equal segments: ``n_rows`` and the earliest place; then says how many kinds an anchor has."""
    first = F.min(F.struct("doc_id", "start", "fp", "n", *carried)).alias("f")
    folded = segments.groupBy("anchor", "kind").agg(F.sum("n_rows").alias("n_rows"), first)
    folded = folded.select("anchor", "kind", "n_rows", *[f"f.{c}" for c in ("doc_id", "fp", "start", "n", *carried)])
    folded = settled(folded, "repeat-kinds")
    several = folded.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n_rows").alias("fewest"))
    out = settled(folded.join(several.filter("kinds > 1 OR fewest > 1"), "anchor"), "repeat-groups")
    used_up(folded)
    return out


def _copies(found: DataFrame, groups: DataFrame, width: int, keep_earliest: bool) -> DataFrame:
    """Stretches of the segments that have copies: all of them, or all but the earliest, are covered throughout."""
    many = groups.filter("n_rows > 1").select("anchor", "kind", F.col("doc_id").alias("d0"), F.col("fp").alias("f0"), F.col("start").alias("s0"))
    copies = found.join(many, ["anchor", "kind"])
    if keep_earliest:
        copies = copies.filter("NOT (doc_id = d0 AND fp = f0 AND start = s0)")
    return settled(copies.select("doc_id", "fp", "start", (F.col("start") + F.col("n") + width - 1).alias("stop")), "repeat-copies")


def repeated(df: DataFrame, search: Search, solver: Solver, keep_earliest: bool, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The keyed documents, and the stretches ``doc_id, fp, start, stop`` (in units) that repeated windows cover.

    With ``keep_earliest`` the earliest of equal windows is spared, otherwise all of them count. The solver gets kinds
    under anchors with several (columns of ``KIND``) and returns the covered stretches of those kinds' earliest places.
    """
    unique = unique_ids(df, doc_id)
    every = keyed(df, doc_id, text, unique)
    docs = every if unique else every.dropDuplicates(["doc_id", "fp"])
    gram = search.gram_sizes[0]
    counts = docs.mapInArrow(_segments(search, gram, True), "anchor long, c long").groupBy("anchor").agg(F.sum("c").alias("c"))
    twice = settled(counts.filter("c > 1").select("anchor"), "repeat-anchors")
    found = settled(docs.mapInArrow(_segments(search, gram, False), SEGMENT).join(twice, "anchor"), "repeat-segments")
    used_up(twice)
    groups = _kinds(found.withColumn("n_rows", F.lit(1).cast("long")))
    out = [_copies(found, groups, search.width, keep_earliest)]
    used_up(found)
    unsolved = "kinds > 1" if keep_earliest else "kinds > 1 AND fewest = 1"
    wanted = groups.filter(unsolved).groupBy("doc_id", "fp").agg(F.collect_list(F.struct("anchor", "kind", "n_rows", "start", "n")).alias("wanted"))
    kinds = docs.join(wanted, ["doc_id", "fp"]).select("doc_id", "fp", "text", "wanted").mapInArrow(_extract(search), KIND)
    kinds = settled(kinds, "repeat-units")
    used_up(groups)
    for gram in search.gram_sizes[1:]:
        hot = settled(kinds.groupBy("anchor").agg(F.count("*").alias("k")).filter(F.col("k") > search.hot_kinds).select("anchor"), "repeat-hot")
        out.append(settled(_solved(kinds.join(hot, "anchor", "left_anti"), search, solver), "repeat-solved"))
        if hot.isEmpty():
            break
        again = settled(kinds.join(hot, "anchor").select(*kinds.columns).mapInPandas(_again(search, gram), KIND), "repeat-again")
        used_up(kinds)
        groups = _kinds(again, "units")
        out.append(_copies(again, groups, search.width, keep_earliest))
        used_up(again)
        kinds = settled(groups.filter(unsolved).select(*kinds.columns), "repeat-units")
        used_up(groups)
    else:
        out.append(settled(_solved(kinds, search, solver), "repeat-solved"))
    used_up(kinds)
    spans = out[0]
    for more in out[1:]:
        spans = spans.unionByName(more)
    return every, spans


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of stretches as maximal runs."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]]) if len(starts) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return starts[first], reach[np.append(first[1:], len(starts)) - 1] if len(first) else reach[:0]


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, fp, text, spans``: every document with its stretches (null: none)."""
    gathered = spans.groupBy("doc_id", "fp").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    return docs.join(gathered, ["doc_id", "fp"], "left").select("doc_id", "fp", "text", "spans")


def span_arrays(column: pa.Array, row: int) -> tuple[np.ndarray, np.ndarray]:
    spans = column[row].values
    if spans is None or not len(spans):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return merged(spans.field("start").to_numpy().astype(np.int64), spans.field("stop").to_numpy().astype(np.int64))
