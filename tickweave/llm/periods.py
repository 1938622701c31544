"""Periodic runs in word sequences: descending-LCP Kruskal over suffix classes.

A run of ``words[start : start + length]`` has smallest period ``q`` (words ``q`` apart are identical), at least
``max(min_length, min_exponent * q)`` words, and no neighbouring word extends it under that period.

The suffixes of a document are sorted, and every neighbouring pair of the order is an edge whose weight is their longest
common prefix. Edges are taken by decreasing weight; union-find joins the classes, each an ordered set of positions. When
the smaller class enters the larger, every position meets its new neighbours: two positions ``d`` apart that are joined at
weight ``l >= d`` seed a run of period ``d`` and length ``l + d``. A run's first position and the one a period later are
joined at exactly ``length - period`` and nothing lies between them, or the period would not be the smallest; so each run is
seeded there, once, and neighbours that extend to the left or are too short are passed over.

Only edges of at least ``least`` common words can seed a run, so documents in which no ``least`` words in a row come twice
hold none and are not sorted. That, like all the rest, compares words, not hashes. Documents are independent: one pass
over the rows and no shuffle. Time is n log(n)**2 and memory n log(n) in the words of one document that repeats itself.

Defined results: null, empty and blank texts have no words and no runs; repeated rows give repeated results; ids of any
kind (null too) pass through; extra columns do not matter, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect, bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MIN_LENGTH, MIN_EXPONENT = 6, 4
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
BATCH_BYTES = 8 << 20


class Places:
    """An ordered set of positions in chunks, so that adding one moves few others."""

    CHUNK = 512

    def __init__(self, place: int):
        self.chunks, self.last, self.size = [[place]], [place], 1

    def __iter__(self) -> Iterator[int]:
        for chunk in self.chunks:
            yield from chunk

    def add(self, place: int) -> tuple[int | None, int | None]:
        """Adds a position; returns its neighbours."""
        k = min(bisect_left(self.last, place), len(self.chunks) - 1)
        chunk = self.chunks[k]
        at = bisect(chunk, place)
        before = chunk[at - 1] if at else self.last[k - 1] if k else None
        after = chunk[at] if at < len(chunk) else None  # only the last chunk is added to at its end
        chunk.insert(at, place)
        self.last[k] = chunk[-1]
        self.size += 1
        if len(chunk) > 2 * self.CHUNK:
            self.chunks[k : k + 1] = [chunk[: self.CHUNK], chunk[self.CHUNK :]]
            self.last[k : k + 1] = [chunk[self.CHUNK - 1], chunk[-1]]
        return before, after


def suffix_order(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of a sequence of whole numbers and the common prefix of each suffix with the one before it."""
    n = len(units)
    ranks = [np.unique(units, return_inverse=True)[1].astype(np.int64)]
    width = 1
    while ranks[-1].max() < n - 1:  # some ranks are still shared
        key = ranks[-1] * (n + 1)
        key[:-width] += ranks[-1][width:] + 1
        ranks.append(np.unique(key, return_inverse=True)[1].astype(np.int64))
        width *= 2
    order = np.argsort(ranks[-1])
    one, two = order[:-1], order[1:]
    common = np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 2, -1, -1):  # ranks[level] tells stretches of 2**level words apart
        rank = np.append(ranks[level], -1)
        a, b = np.minimum(one + common, n), np.minimum(two + common, n)
        common += np.where((a < n) & (b < n) & (rank[a] == rank[b]), 1 << level, 0)
    return order, np.concatenate([[0], common])


def seeds(order: np.ndarray, common: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Positions ``x < y`` that become neighbours in one suffix class, and the common prefix at which they do."""
    edges = np.flatnonzero(common >= least)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    parent: dict[int, int] = {}
    sets: dict[int, Places] = {}

    def find(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for x, y, weight in zip(order[edges - 1].tolist(), order[edges].tolist(), common[edges].tolist()):
        x, y = find(x), find(y)
        one, two = sets.get(x) or Places(x), sets.get(y) or Places(y)
        if one.size < two.size:
            x, y, one, two = y, x, two, one
        last = follows = None  # what was added last, and its next neighbour out of the larger class
        for place in two:
            before, after = one.add(place)
            if follows is not None and follows < place:
                yield last, follows, weight
            if before is not None and before != last:  # neighbours within the smaller class met before
                yield before, place, weight
            last, follows = place, after
        if follows is not None:
            yield last, follows, weight
        parent[y] = x
        sets[x] = one
        sets.pop(y, None)


def runs_of(words: Sequence, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` by start, then period."""
    # a run of period q is seeded at length - q common words, at least max(min_length - q, (min_exponent - 1) * q)
    least = min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, min_length + 1))
    n = len(words)
    grams = n - least + 1
    if grams < 2 or len(set(zip(*[words[k : k + grams] for k in range(least)]))) == grams:
        return []
    number: dict = {}
    units = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    found = set()
    for x, y, weight in seeds(*suffix_order(units), least):
        period = y - x
        if weight >= (min_exponent - 1) * period and weight + period >= min_length and (x == 0 or units[x - 1] != units[y - 1]):
            found.add((x, weight + period, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words joined by one blank, of each run its first period only."""
    if not runs:
        return b" ".join(words)
    live = np.ones(len(words), bool)
    for start, length, period in runs:
        live[start + period : start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(live)])


def periodic_runs(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``runs`` and ``collapsed``, the text without what runs repeat.

    ``min_exponent`` must be at least 3: from there on runs of one smallest period are told apart by their seeds alone.
    """
    if min_exponent < 3 or min_length < 2:
        raise ValueError("runs need an exponent of 3 and a length of 2 at least")
    kind = df.select(doc_id).schema[0].dataType.simpleString()
    listed = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, out = 0, 0, []
            for k, raw in enumerate(batch.column("text")):
                words = raw.as_py().split()  # of bytes: at blanks and at 9 to 13
                runs = runs_of(words, min_length, min_exponent)
                text = collapsed(words, runs)
                out.append((len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], text))
                held += len(text)
                if held > BATCH_BYTES or k == batch.num_rows - 1:
                    counts, found, texts = zip(*out)
                    columns = [batch.column("doc_id").slice(start, len(out)), pa.array(counts, pa.int64()), pa.array(found, listed), pa.array(texts, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])
                    start, held, out = k + 1, 0, []

    rows = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    found = rows.mapInArrow(scan, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
