"""Exact top-k inner products with a bit-sliced index.

Components are quantised to integers, ``floor(1024 * x)``. A block of rows stores, for every dimension, one bitmap per binary
digit (a *slice*), so that a query adds up all its rows' scores with bitmap arithmetic: slices of equal weight meet in
carry-save adders until one bitmap a digit is left. The best rows are then taken from the most significant digit downward;
rows that tie at the boundary are resolved exactly, by smaller id. Nothing is approximated.

Rows are dealt to blocks of bounded size by hash, queries to slabs of bounded size; each pair of block and slab is one task,
which returns k rows a query. Only queries' slabs and, for many queries, blocks are copied.

Vectors whose scores might not fit 64 bits are *wide*: they have blocks of their own, and whatever meets them is added up in
Python's whole numbers, with the same bitmaps. A score beyond 64 bits is null in ``score`` and stands as text in ``wide_score``.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part; a query meets only
vectors of its own length, and no row with its own id; rows without id take no part. Rows alike in id and vector are one row of
the index, with their number: as candidates each of them has a rank of its own, as queries each of them gets its own ranks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tickweave.session import settle

SCALE, LARGEST = 1024, 1 << 27
LIMB = 32
IN_RANGE = b"\x01"
FOUND = "query_id long, q long, asked long, vec_id long, copies long, score long, beyond binary, wide_score string"
ROWS_PER_BLOCK, QUERIES_PER_SLAB = 16384, 2048
INDEX = "dim int, block int, ids binary, copies binary, low long, slices binary, digits int, sums binary, sum_top long, vectors binary, wide boolean"


def quantised(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, dim, v, w``: the rows that take part, quantised; wide ones have components in ``w`` (not scaled), not in ``v``."""
    x = F.transform(vector, lambda c: c.cast("double"))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = df.filter(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(x, lambda c: F.coalesce(finite(c), F.lit(False))))
    bound = F.least(F.lit(float(LARGEST)), F.sqrt(F.lit(2.0**62) / F.size(vector))) - 1
    fits = F.forall(x, lambda c: F.abs(c) <= bound / SCALE)
    narrow = F.transform(x, lambda c: F.floor(c * SCALE).cast("long"))
    wide = F.transform(x, lambda c: F.when(F.abs(c) < 2.0**40, F.floor(c * SCALE) / F.lit(float(SCALE))).otherwise(c))
    return rows.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.size(vector).alias("dim"),
        F.when(fits, narrow).otherwise(F.array().cast("array<bigint>")).alias("v"), F.when(~fits, wide).alias("w"),
    )


def _whole(components: np.ndarray) -> np.ndarray:
    """Wide components as Python's whole numbers, scaled."""
    flat = [int(x * SCALE) if abs(x) < 2.0**60 else int(x) * SCALE for x in components.ravel().tolist()]
    out = np.empty(len(flat), object)
    out[:] = flat
    return out.reshape(components.shape)


def _bitmaps(values: np.ndarray, digits: int) -> np.ndarray:
    """Slices of non-negative integers, lowest digit first: (..., digits, words of 64 rows)."""
    if values.dtype == object:
        limbs = range(0, digits, LIMB)
        return np.concatenate([_bitmaps(((values >> k) & ((1 << LIMB) - 1)).astype(np.int64), min(LIMB, digits - k)) for k in limbs], axis=-2)
    n = values.shape[-1]
    bits = ((values[..., None, :] >> np.arange(digits, dtype=np.int64)[:, None]) & 1).astype(np.uint8)
    pad = np.zeros((*bits.shape[:-1], -n % 64), np.uint8)
    return np.packbits(np.concatenate([bits, pad], axis=-1), axis=-1, bitorder="little").view(np.uint64)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec_id", kind="stable")
    wide = int(pdf["block"].iloc[0]) < 0
    given = np.array(pdf["w" if wide else "v"].tolist(), dtype=np.float64 if wide else np.int64)
    vectors = _whole(given) if wide else given
    low = int(vectors.min())
    digits = max(1, int(vectors.max() - low).bit_length())
    slices = np.stack([_bitmaps(column - low, digits) for column in vectors.T])  # a dimension at a time: bounded memory
    sums = vectors.sum(axis=1)
    rest = sums.max() - sums
    return pd.DataFrame([{
        "dim": vectors.shape[1], "block": int(pdf["block"].iloc[0]), "ids": pdf["vec_id"].to_numpy(np.int64).tobytes(), "copies": pdf["copies"].to_numpy(np.int64).tobytes(), "low": None if wide else low, "slices": slices.tobytes(),
        "digits": digits, "sums": _bitmaps(rest, max(1, int(rest.max()).bit_length())).tobytes(), "sum_top": None if wide else int(sums.max()),
        "vectors": (given if wide else vectors.astype(np.int32)).tobytes(), "wide": wide,
    }])


def _counted(rows: DataFrame) -> DataFrame:
    """Rows alike in id and vector as one, with their number in ``copies``."""
    return rows.groupBy("vec_id", "dim", "v", "w").agg(F.count("*").alias("copies"))


def build_index(rows: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Bit-sliced index of all rows (``vec_id, dim, v, w``), one row per block; ids ascend within a block, wide blocks are negative."""
    rows = _counted(rows)
    blocks = math.ceil(rows.count() / rows_per_block) or 1
    block = F.pmod(F.xxhash64("vec_id", "v", "w"), F.lit(blocks)).cast("int")
    return rows.withColumn("block", F.when(F.col("w").isNull(), block).otherwise(-1 - block)).groupBy("dim", "block").applyInPandas(_build, INDEX)


def _added(columns: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """Sums bitmaps by weight: three of a weight become one of it and one of the next, until one a weight is left."""
    out, t = [], 0
    while columns:
        parts = columns.pop(t, [])
        x = np.concatenate(parts) if parts else np.zeros((1, words), np.uint64)
        while len(x) > 1:
            if len(x) == 2:
                carry, x = x[:1] & x[1:], x[:1] ^ x[1:]
            else:
                m = len(x) // 3
                a, b, c = x[:m], x[m : 2 * m], x[2 * m : 3 * m]
                half = a ^ b
                carry, x = (a & b) | (half & c), np.concatenate([half ^ c, x[3 * m :]])
            columns.setdefault(t + 1, []).append(carry)
        out.append(x[0])
        t += 1
    return out


def _best(score: list[np.ndarray], live: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k highest sums among the live rows; ties at the boundary go to the lowest numbers."""
    sure, open_ = np.zeros_like(live), live
    count = lambda x: int(np.bitwise_count(x).sum())
    for digit in reversed(score):
        with_one = open_ & digit
        n = count(sure | with_one)
        if n > k:
            open_ = with_one
        else:
            sure, open_ = sure | with_one, open_ & ~digit
            if n == k:
                open_ = np.zeros_like(live)
                break
    rows = lambda x: np.flatnonzero(np.unpackbits(x.view(np.uint8), bitorder="little"))
    chosen = rows(sure)
    return np.concatenate([chosen, rows(open_)[: k - len(chosen)]])


def _scores(scores: list[int]) -> dict[str, list]:
    """Columns of exact scores; ``beyond`` sorts those that do not fit 64 bits before and after all that do."""
    fit = [-(1 << 63) <= x < 1 << 63 for x in scores]

    def key(x: int) -> bytes:
        size = abs(x).bit_length() // 8 + 1
        raw = size.to_bytes(4, "big") + abs(x).to_bytes(size, "big")
        return b"\x02" + raw if x > 0 else b"\x00" + bytes(255 - c for c in raw)

    return {
        "score": pd.array([x if f else None for x, f in zip(scores, fit)], dtype="Int64"), "beyond": [IN_RANGE if f else key(x) for x, f in zip(scores, fit)],
        "wide_score": np.array([None if f else str(x) for x, f in zip(scores, fit)], dtype=object),
    }


def _search(k: int):
    def search(key: tuple, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        for b in index.itertuples() if len(queries) else ():
            ids, copies = np.frombuffer(b.ids, np.int64), np.frombuffer(b.copies, np.int64)
            words = -(-len(ids) // 64)
            slices = np.frombuffer(b.slices, np.uint64).reshape(b.dim, b.digits, words)
            sums = np.frombuffer(b.sums, np.uint64).reshape(-1, words)
            vectors = np.frombuffer(b.vectors, np.float64 if b.wide else np.int32).reshape(-1, b.dim)
            everyone = _bitmaps(np.ones(len(ids), np.int64), 1)[0]
            for q in queries.itertuples():
                wide = q.w is not None
                v = _whole(np.asarray(q.w, np.float64)) if wide else np.asarray(q.v, np.int64)
                shift = max(1, int(np.abs(v).max()).bit_length())  # v + 2**shift is not negative
                bits = (((v + (1 << shift))[:, None] >> np.arange(shift + 2).astype(v.dtype)) & 1).astype(np.int64)
                columns: dict[int, list[np.ndarray]] = {}
                for j in range(shift + 2):
                    dims = np.flatnonzero(bits[:, j])
                    for s in range(b.digits) if len(dims) else ():
                        columns.setdefault(j + s, []).append(slices[dims, s])
                for s in range(len(sums)):  # the offset of the query's components, taken off again
                    columns.setdefault(shift + s, []).append(sums[s : s + 1])
                live = everyone
                at = np.searchsorted(ids, q.query_id), np.searchsorted(ids, q.query_id, "right")
                if at[0] < at[1]:
                    own = np.zeros(words * 64, np.uint8)
                    own[at[0] : at[1]] = 1
                    live = everyone & ~np.packbits(own, bitorder="little").view(np.uint64)
                best = _best(_added(columns, words), live, k)
                if wide or b.wide:
                    rows = _whole(vectors[best]) if b.wide else vectors[best].astype(object)
                    scores = _scores([sum(x * y for x, y in zip(row, v.tolist())) for row in rows.tolist()])
                else:
                    scores = {"score": pd.array(vectors[best].astype(np.int64) @ v, dtype="Int64"), "beyond": IN_RANGE, "wide_score": None}
                found.append(pd.DataFrame({"query_id": q.query_id, "q": q.q, "asked": q.copies, "vec_id": ids[best], "copies": copies[best], **scores}))
        return pd.concat(found).astype({"beyond": object, "wide_score": object}) if found else pd.DataFrame({c.split()[0]: pd.Series(dtype="int64" if c.endswith("long") else object) for c in FOUND.split(", ")})

    return search


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, rows_per_block: int = ROWS_PER_BLOCK, queries_per_slab: int = QUERIES_PER_SLAB) -> DataFrame:
    """``query_id, rank, vec_id, score, wide_score``: the k best of ``rows`` for each of ``queries`` (both as ``quantised`` gives them)."""
    index = settle(build_index(rows, rows_per_block), "bit-slices")
    asked = _counted(queries)
    slabs = math.ceil(asked.count() / queries_per_slab) or 1
    asked = asked.select(F.col("vec_id").alias("query_id"), "dim", "v", "w", "copies", F.xxhash64("v", "w").alias("q"), F.pmod(F.xxhash64("vec_id", "v", "w"), F.lit(slabs)).cast("int").alias("slab"))
    left = index.select(*[F.col(c).alias(c) for c in index.columns]).withColumn("slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))))
    right = asked.join(index.select(F.col("dim").alias("dim"), F.col("block").alias("block")), "dim")
    found = left.groupBy("dim", "block", "slab").cogroup(right.groupBy("dim", "block", "slab")).applyInPandas(_search(k), FOUND)
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("beyond"), F.desc("score"), "vec_id")
    kept = found.select("*", F.row_number().over(order).alias("place")).filter(F.col("place") <= k)
    # copies follow each other in rank; only the k best rows of a query have come this far
    kept = kept.withColumn("upto", F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.col("upto") - F.col("copies") + 1
    kept = kept.filter(first <= k).withColumn("rank", F.explode(F.sequence(first.cast("int"), F.least(F.col("upto"), F.lit(k)).cast("int"))))
    kept = kept.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("asked"))))
    return kept.select("query_id", "rank", "vec_id", "score", "wide_score")
