"""Byte-level BPE by tree reduction: encode halves, join neighbours.

Encodings of adjoining stretches form a monoid: joining re-encodes a window around the seam and grows it until what lies
outside provably stays. There are two seams:

* between *matches* of the splitting pattern. The pattern never looks back, and a match that ends ``LOOKAHEAD`` characters
  before the end of its stretch cannot change when text is added behind; so the window starts at the last such match of the
  left part, and ends where one of its own settled matches ends where a match of the right part ends.
* between *tokens* of one match. An encoding is right if each pair of adjoining tokens is what BPE makes of the pair's
  bytes; so the window is settled once both pairs at its edges pass that test.

Texts above ``split_chars`` characters are cut into leaves that many tasks encode, and a join per tree level brings
neighbours together. Shorter ones go through the same tree within a task. Decoding concatenates the tokens' bytes.

Defined results: null and empty texts have no tokens; repeated rows give repeated rows; special-token strings are text.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tickweave.llm.common import keyed, real_id

LOOKAHEAD = 4  # a match looks at most this far beyond its end: contractions of three characters, one after white space
LEAF_CHARS, SPLIT_CHARS = 8192, 1 << 18
SHORT, LEAF_BYTES, KEEP, NEVER = 96, 6, 300_000, 1 << 62
# Unicode white space, as \s of the pattern means it.
BLANK = r"\t-\r \x85\xa0  -     　"


class Encoder:
    """BPE with the ranks of a ``.tiktoken`` file and a splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        pattern = pattern.replace(r"[^\s", f"[^{BLANK}").replace(r"\S", f"[^{BLANK}]").replace(r"\s", f"[{BLANK}]")
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}
        self.windows: dict[tuple[int, ...], tuple[int, ...]] = {}
        self.leaves: dict[bytes, tuple[int, ...]] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Plain BPE: merge the pair of lowest rank, leftmost first, until none is left. Used for short windows."""
        ranks = self.ranks
        if len(piece) > SHORT:
            return self._merged_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        costs = [ranks.get(piece[i : i + 2], NEVER) for i in range(len(piece) - 1)]
        while costs and (best := min(costs)) != NEVER:
            at = costs.index(best)
            both = parts[at] + parts[at + 1]
            parts[at : at + 2] = [both]
            del costs[at]
            if at < len(costs):
                costs[at] = ranks.get(both + parts[at + 1], NEVER)
            if at:
                costs[at - 1] = ranks.get(parts[at - 1] + both, NEVER)
        return [ranks[p] for p in parts]

    def _merged_long(self, piece: bytes) -> list[int]:
        """The same with a heap and links, for windows that had to grow."""
        ranks, n = self.ranks, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # by start of a part; end 0: merged away
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= n or end[mid] != stop:
                continue
            end[i], end[mid] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def window(self, ids: tuple[int, ...]) -> tuple[int, ...]:
        """The bytes of adjoining tokens, encoded again."""
        if (known := self.windows.get(ids)) is None:
            if len(self.windows) > KEEP:
                self.windows.clear()
            known = tuple(self.merged(b"".join(map(self.bytes_of.__getitem__, ids))))
            if len(ids) <= 8:
                self.windows[ids] = known
        return known

    def fits(self, a: int, b: int) -> bool:
        """Whether BPE leaves the bytes of two adjoining tokens as these tokens."""
        return self.window((a, b)) == (a, b)

    def tree(self, piece: bytes) -> tuple[int, ...]:
        n = len(piece)
        if n <= LEAF_BYTES:
            if (known := self.leaves.get(piece)) is None:
                if len(self.leaves) > KEEP:
                    self.leaves.clear()
                known = self.leaves[piece] = tuple(self.merged(piece))
            return known
        half = n // 2 if n > 2 * LEAF_BYTES else LEAF_BYTES
        return self.seam(self.tree(piece[:half]), self.tree(piece[half:]))

    def seam(self, a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
        k = 1
        while True:
            left, right = max(0, len(a) - k), min(k, len(b))
            window = self.window(a[left:] + b[:right])
            if (not left or self.fits(a[left - 1], window[0])) and (right == len(b) or self.fits(window[-1], b[right])):
                return a[:left] + window + b[right:]
            k *= 2

    def match(self, piece: str) -> tuple[int, ...]:
        """Tokens of one match of the pattern; a match that is itself in the vocabulary is one token."""
        if (known := self.known.get(piece)) is None:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            known = (whole,) if whole is not None else self.tree(raw)
            if len(raw) <= 64:
                if len(self.known) > KEEP:
                    self.known.clear()
                self.known[piece] = known
        return known

    def pieces(self, text: str, leaf: int = LEAF_CHARS) -> list[str]:
        """Matches of the pattern, by halves."""
        if len(text) <= leaf:
            return self.split(text)
        half = len(text) // 2
        return self.joined(self.pieces(text[:half], leaf), self.pieces(text[half:], leaf))

    def joined(self, a: list[str], b: list[str]) -> list[str]:
        if not a or not b:
            return a or b
        left, loose = len(a), 0
        while left and (loose < LOOKAHEAD or left == len(a)):
            left -= 1
            loose += len(a[left])
        seam, k = sum(map(len, a[left:])), 2
        head = "".join(a[left:])
        while True:
            right = min(k, len(b))
            window = self.split(head + "".join(b[:right]))
            if right == len(b):
                return a[:left] + window
            ends, at = {}, seam
            for j, piece in enumerate(b[:right]):
                at += len(piece)
                ends[at] = j + 1
            length, at = at, 0
            for j, piece in enumerate(window):
                at += len(piece)
                if at > length - LOOKAHEAD:
                    break
                if at in ends:
                    return a[:left] + window[: j + 1] + b[ends[at] :]
            k *= 2

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self.pieces(text):
            out.extend(self.match(piece))
        return out

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_CHARS:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        return self.decode(ids[: len(ids) // 2]) + self.decode(ids[len(ids) // 2 :])


@cache
def encoder(path: str, pattern: str) -> Encoder:
    """One per worker process and vocabulary."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return Encoder(ranks, pattern)


def _packed(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def _whole(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = enc.encode(text.as_py())
                rows.append((doc_id.as_py(), len(ids), _packed(ids), enc.decode(ids)))
                if sum(len(r[3]) for r in rows[-1:]) > 1 << 22 or len(rows) >= 500:
                    yield _rows(rows)
                    rows = []
            if rows:
                yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), names.types, strict=True)], schema=names)


NODE = "doc_id long, fp long, copies long, node long, text string, lengths binary"


def _leaves(path: str, pattern: str):
    """Splits the leaves of long texts into matches; a node holds its text and the matches' lengths."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path, pattern)
        for pdf in batches:
            yield pdf.assign(lengths=[_packed([len(p) for p in enc.pieces(t)]) for t in pdf["text"]])

    return run


def _pieces(text: str, lengths: bytes) -> list[str]:
    ends = np.cumsum(np.frombuffer(lengths, "<u4").astype(np.int64)).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _pairs(path: str, pattern: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        enc = encoder(path, pattern)
        pdf = pdf.drop(columns="up").sort_values("node")
        pieces: list[str] = []
        for text, lengths in zip(pdf["text"], pdf["lengths"], strict=True):
            pieces = enc.joined(pieces, _pieces(text, lengths))
        return pdf.head(1).assign(node=pdf["node"] // 2, text="".join(pdf["text"]), lengths=_packed([len(p) for p in pieces]))

    return run


def _tokens(path: str, pattern: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path, pattern)
        for pdf in batches:
            for r in pdf.itertuples():
                ids = [t for p in _pieces(r.text, r.lengths) for t in enc.match(p)]
                yield pd.DataFrame({"doc_id": [r.doc_id] * int(r.copies), "n_tokens": len(ids), "ids": _packed(ids), "decoded": enc.decode(ids)})

    return run


def encode_documents(df: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text", split_chars: int = SPLIT_CHARS) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` per row: token ids as little-endian 32-bit integers, and the bytes they decode to.

    ``vocabulary`` is the path of a ``.tiktoken`` file that every worker can read.
    """
    rows = keyed(df, doc_id, text)
    out = "doc_id long, n_tokens long, ids binary, decoded binary"
    short = rows.filter(F.length("text") <= split_chars).select("doc_id", "text").mapInArrow(_whole(vocabulary, pattern), out)
    long = rows.filter(F.length("text") > split_chars)
    most = long.agg(F.max(F.length("text"))).first()[0]
    if most is None:
        return short.select(real_id().alias("doc_id"), "n_tokens", "ids", "decoded")
    nodes = long.groupBy("doc_id", "fp").agg(F.first("text").alias("whole"), F.count("*").alias("copies"))
    nodes = nodes.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.length("whole") - 1) / split_chars))).alias("node"))
    nodes = nodes.select("doc_id", "fp", "copies", "node", F.substring("whole", F.col("node").cast("int") * split_chars + 1, F.lit(split_chars)).alias("text"))
    nodes = nodes.repartition("doc_id", "fp", "node").withColumn("lengths", F.lit(None).cast("binary")).mapInPandas(_leaves(vocabulary, pattern), NODE)
    count = (most - 1) // split_chars + 1
    while count > 1:  # one join of neighbours per tree level
        nodes = nodes.withColumn("up", F.shiftright("node", 1)).groupBy("doc_id", "fp", "up").applyInPandas(_pairs(vocabulary, pattern), NODE)
        count = (count + 1) // 2
    out = short.unionByName(nodes.mapInPandas(_tokens(vocabulary, pattern), out))
    return out.select(real_id().alias("doc_id"), "n_tokens", "ids", "decoded")
