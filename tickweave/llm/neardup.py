"""Near-duplicate documents with HyperMinHash sketches and exact verification.

A document's set holds its distinct shingles of five lower-cased words. Its sketch has 128 buckets; of the smallest hash in a
bucket the register keeps the number of leading zeros and ten mantissa bits. Bands of four registers bring similar sets
together; a band in which no register is filled brings nothing together. Equal sets are folded into one node first.

A bucket of a band is divided by size, since sets of unlike size cannot be linked, and beyond a number of nodes into blocks of
pairs of its parts. In each, registers alone tell which nodes look alike (share of equal registers, corrected for chance
collisions, with a margin of six standard deviations); a spanning forest of these likely pairs is told, so a bucket yields
fewer pairs than nodes and chance collisions yield none. Each node's best likely pair is verified on the full sets.
Clusters are the components of the likely pairs, so every link lies within one. Where a cluster still has several components, the
nodes beside the largest one are compared with all of the cluster, in blocks of bounded size, through an index of the
blocks' shingles, and a block tells only links that join components. A pair at the threshold misses all 32 bands with a
probability of five in a million if its sets fill the sketch; of sets of three and four shingles about 3 in 100,000 are lost
(all shared registers in the band of the extra one).

Defined results: texts without words have an empty set and are linked with nothing; fewer than five words count as one
shingle; rows alike in id and text are one document; rows without id are linked with nothing and are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickweave.llm.common import NO_ID, fresh, keyed, real_id, settled, unique_ids, used_up
from tickweave.llm.components import components
from tickweave.llm.hashing import U, grams, lowered, mixed, text_bytes, word_hashes, words

SHINGLE, THRESHOLD = 5, 75  # words; per cent of the union
BUCKETS, MANTISSA, BAND, MARGIN = 128, 10, 4, 6.0
BLOCK = 4096  # nodes of a bucket whose registers are compared in one piece
# sides of a block of comparisons, in nodes and in shingles; wide ones, since each side is copied once per block of the other
STRAGGLERS, CROWD, STRAGGLER_SHINGLES, CROWD_SHINGLES = 8192, 4096, 3_000_000, 2_000_000


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw, offsets = text_bytes(column)
    raw = lowered(raw)
    starts, ends, first = words(raw, offsets)
    hashes = word_hashes(raw, starts, ends)
    rolled = grams(hashes, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        else:
            out.append(mixed(grams(hashes[a:b], b - a) + U(b - a)) if b > a else np.zeros(0, U))
    return out


_STARTS = np.arange(BUCKETS, dtype=U) << U(57)


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set: 0 if the bucket is empty, else leading zeros + 1 and the mantissa."""
    at = np.searchsorted(hashes, _STARTS)
    out = np.zeros(BUCKETS, np.uint16)
    filled = at < np.append(at[1:], len(hashes))
    low = hashes[at[filled]] & U((1 << 57) - 1)
    width = np.zeros(len(low), np.int64)  # bits of the smallest hash
    rest = low.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = rest >= (U(1) << U(step))
        width[big] += step
        rest[big] >>= U(step)
    zeros = np.minimum(56 - width, 62)
    mantissa = ((low << (U(57) - width.astype(U))) >> U(57 - MANTISSA)) & U((1 << MANTISSA) - 1)
    out[filled] = ((zeros + 1) << MANTISSA).astype(np.uint16) | mantissa.astype(np.uint16)
    return out


SKETCH = "doc_id long, fp long, n long, sig_a long, sig_b long, registers binary"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            sets = shingle_sets(part.column(2))
            sums = [(int(s.sum(dtype=U)), int(mixed(s + U(7)).sum(dtype=U))) for s in sets]
            both = np.array(sums, U).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array([registers(s).tobytes() for s in sets], pa.binary())],
                names=["doc_id", "fp", "n", "sig_a", "sig_b", "registers"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in shingle_sets(part.column(1))], pa.binary())], names=["node", "hashes"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The filled bands of each node, as one number a band."""
    for batch in batches:
        node = batch.column(0)
        keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64).reshape(len(node), -1)
        row, band = np.nonzero(keys)
        yield pa.RecordBatch.from_arrays([node.take(pa.array(row)), pa.array(band.astype(np.int32)), pa.array(keys[row, band])], names=["node", "band", "key"])


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard similarity by registers (pairs of rows), corrected for chance collisions, and its standard deviation at the threshold."""
    filled = ((a > 0) | (b > 0)).sum(axis=1).astype(float)
    equal = ((a == b) & (a > 0)).sum(axis=1)
    i = np.arange(1, 58)[:, None]
    share = lambda n: (1 - 2.0 ** -i) ** (n / BUCKETS) - (1 - 2.0 ** (1 - i)) ** (n / BUCKETS)  # noqa: E731  a minimum with i - 1 leading zeros
    chance = BUCKETS * (share(na) * share(nb)).sum(axis=0) / 2**MANTISSA
    filled = np.maximum(filled, 1)
    t = THRESHOLD / 100
    return (equal - chance) / np.maximum(filled - chance, 1), np.sqrt(t * (1 - t) / filled)


def _shares(n: np.ndarray) -> np.ndarray:
    """For sets of ``n`` shingles, how likely a bucket's smallest hash has each number of leading zeros."""
    i = np.arange(1, 58)
    each = n[:, None] / BUCKETS
    return (1 - 2.0**-i) ** each - (1 - 2.0 ** (1 - i)) ** each


def _alike(regs: np.ndarray, n: np.ndarray, shares: np.ndarray, i, j) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of nodes ``i`` with nodes ``j``, and whether they may be linked. As ``estimate``."""
    a, b = regs[i], regs[j]
    filled = ((a > 0) | (b > 0)).sum(axis=-1)
    equal = ((a == b) & (a > 0)).sum(axis=-1)
    chance = BUCKETS * (shares[i] * shares[j]).sum(axis=-1) / 2**MANTISSA
    filled, t = np.maximum(filled, 1), THRESHOLD / 100
    like = (equal - chance) / np.maximum(filled - chance, 1)
    small = np.minimum(n[i], n[j]) * 100 >= THRESHOLD * np.maximum(n[i], n[j])
    return like, small & (like + MARGIN * np.sqrt(t * (1 - t) / filled) >= t)


def _forest(regs: np.ndarray, n: np.ndarray, shares: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Likely pairs (two rows and their similarity) that hold each bucket's likely pairs together; ``first`` starts the buckets, with the end."""
    size = np.diff(first)
    head = np.repeat(first[:-1], size)
    rest = np.flatnonzero(np.arange(len(n)) != head)
    passed = np.zeros(len(n), bool)
    for k in range(0, len(rest), 4096):  # all with the first of their bucket
        j = rest[k : k + 4096]
        like, ok = _alike(regs, n, shares, head[j], j)
        passed[j] = ok
        yield head[j][ok], j[ok], like[ok]
    passed[first[:-1]] = True
    failed = np.add.reduceat(~passed, first[:-1]) if len(n) else np.zeros(0, int)
    for k in np.flatnonzero((failed > 0) & (size > 2)):
        lo, hi = first[k], first[k + 1]
        label = np.where(passed[lo:hi], lo, np.arange(lo, hi))
        for i in lo + np.flatnonzero(~passed[lo:hi]):
            j = lo + np.flatnonzero(label != label[i - lo])
            like, ok = _alike(regs, n, shares, i, j)
            j, like = j[ok], like[ok]
            joined, at = np.unique(label[j - lo], return_index=True)
            if len(joined):
                yield j[at], np.full(len(at), i), like[at]
                label[np.isin(label, joined)] = label[i - lo]


def _likely_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning likely pairs of each bucket; rows come in order of the buckets, and the last bucket of a batch waits for the next."""
    held: pa.RecordBatch | None = None

    def forest(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        node, n = (rows.column(c).to_numpy() for c in ("node", "n"))
        regs = np.frombuffer(b"".join(rows.column("registers").to_pylist()), np.uint16).reshape(-1, BUCKETS)
        sizes, which = np.unique(n, return_inverse=True)
        shares = _shares(sizes.astype(float))[which]
        for a, b, like in _forest(regs, n, shares, np.append(_starts_of(rows), len(node))):
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b]), pa.array(like)], names=["a", "b", "j"])

    for batch in batches:
        rows = pa.Table.from_batches([batch] if held is None else [held, batch])
        starts = _starts_of(rows)
        last = int(starts[-1]) if len(starts) else 0
        yield from forest(rows.slice(0, last))
        held = rows.slice(last).combine_chunks().to_batches()[0] if len(rows) else None
    if held is not None:
        yield from forest(pa.Table.from_batches([held]))


def _starts_of(rows: pa.Table) -> np.ndarray:
    if not len(rows):
        return np.zeros(0, np.int64)
    new = np.zeros(len(rows), bool)
    new[0] = True
    for c in ("band", "key", "class", "block"):
        x = rows.column(c).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def likely_pairs(nodes: DataFrame) -> DataFrame:
    """``a, b, j``: pairs of nodes that look alike, enough to hold all likely pairs of each bucket together."""
    bands = nodes.select("node", "registers").mapInArrow(_bands, "node long, band int, key long")
    sizes = nodes.select(F.col("node").alias("of"), "n")
    # sets can only be linked if the smaller has THRESHOLD per cent of the larger: in the same class of size, or the next
    steps = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / THRESHOLD))).cast("int")
    members = bands.join(sizes, F.col("node") == F.col("of")).drop("of")
    members = settled(members.withColumn("class", F.explode(F.array(steps, steps + 1))).drop("n"), "members")
    bucket = ["band", "key", "class"]
    shared = members.groupBy(*bucket).agg(F.count("*").alias("k")).filter("k > 1").withColumn("parts", (2 * F.floor((F.col("k") - 1) / BLOCK) + 1).cast("int"))
    placed = members.join(shared.drop("k"), bucket).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: (x != F.col("part")) | (F.col("parts") == 1))
    placed = placed.withColumn("other", F.explode(others))
    placed = placed.withColumn("block", F.least("part", "other") * F.col("parts") + F.greatest("part", "other")).select("node", *bucket, "block")
    full = placed.join(nodes.select("node", "n", "registers"), "node")
    near = full.repartition(*bucket, "block").sortWithinPartitions(*bucket, "block", "node").select("node", "n", *bucket, "block", "registers")
    out = settled(near.mapInArrow(_likely_pairs, "a long, b long, j double").groupBy("a", "b").agg(F.first("j").alias("j")), "likely")
    used_up(members)
    return out


def _block(key: tuple, few: pd.DataFrame, crowd: pd.DataFrame) -> pd.DataFrame:
    """Links between components, by full sets: each node of ``few`` against all of ``crowd`` through an index of hashes.

    Only links that join what the block's other links have not joined yet are told, so there are fewer than nodes.
    """
    found: list[tuple[int, int]] = []
    if len(few) and len(crowd):
        sets = [np.frombuffer(h, U) for h in crowd["hashes"]]
        sizes, nodes, comps = np.array([len(x) for x in sets]), crowd["node"].to_numpy(), crowd["component"].to_numpy()
        hashes, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(hashes, kind="stable")
        hashes, owner = hashes[order], owner[order]
        label: dict[int, int] = {}

        def top(c: int) -> int:
            while (up := label.get(c, c)) != c:
                c = up
            return c

        for packed, node, comp in zip(few["hashes"], few["node"].tolist(), few["component"].tolist(), strict=True):
            own = np.frombuffer(packed, U)
            lo, hi = np.searchsorted(hashes, own), np.searchsorted(hashes, own, "right")
            many = hi - lo
            at = np.arange(many.sum()) + np.repeat(lo - np.cumsum(many) + many, many)
            both = np.bincount(owner[at], minlength=len(sets))
            linked = (comps != comp) & (100 * both >= THRESHOLD * (len(own) + sizes - both))
            for j in np.flatnonzero(linked):
                x, y = top(comp), top(int(comps[j]))
                if x != y:
                    label[max(x, y)] = min(x, y)
                    found.append((node, int(nodes[j])))
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        ok = []
        for x, y in zip(pdf["x"], pdf["y"], strict=True):
            x, y = np.frombuffer(x, U), np.frombuffer(y, U)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= THRESHOLD * (len(x) + len(y) - both))
        ok = np.array(ok, bool)
        yield pd.DataFrame({"a": pdf["a"][ok], "b": pdf["b"][ok]})


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the threshold."""
    x, y = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    return pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInPandas(_verified, "a long, b long")


def classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The keyed documents, and ``doc_id, fp, n, component_id`` for each of them."""
    unique = unique_ids(df, doc_id)
    every = keyed(df, doc_id, text, unique)
    docs = every if unique else every.dropDuplicates(["doc_id", "fp"])
    sketches = settled(docs.mapInArrow(_sketches, SKETCH), "sketches")
    linked = sketches.filter((F.col("n") > 0) & (F.col("doc_id") != NO_ID))
    nodes = linked.groupBy("sig_a", "sig_b", "n").agg(F.min(F.struct("doc_id", "fp")).alias("first"), F.first("registers").alias("registers"))
    nodes = nodes.select("sig_a", "sig_b", "n", "first.*", "registers").withColumn("node", F.monotonically_increasing_id())
    nodes = settled(nodes, "nodes")  # written once, so the numbers stay
    pairs = likely_pairs(nodes)
    best = pairs.groupBy("b").agg(F.max(F.struct("j", F.col("a").alias("a"))).alias("top")).select("top.a", "b")

    # sets of all nodes that look like another node
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct().join(nodes.select("node", "doc_id", "fp"), "node")
    sets = settled(docs.join(wanted, ["doc_id", "fp"]).select("node", "text").mapInArrow(_sets, "node long, hashes binary"), "sets")
    links = settled(verified(best, sets), "links")
    comps = components(links)

    # clusters are what likely pairs hold together; where one has several components, those beside the largest meet all of it
    clusters = components(pairs)
    labelled = clusters.select("node", F.col("component").alias("cluster")).join(comps, "node", "left").select("cluster", "node", F.coalesce("component", "node").alias("component")).join(nodes.select("node", "n"), "node")
    labelled = settled(labelled, "labelled")
    used_up(clusters, pairs)
    parts = labelled.groupBy("cluster", "component").agg(F.count("*").alias("k"), F.sum("n").alias("s"))
    largest = parts.groupBy("cluster").agg(F.max(F.struct("k", "component", "s")).alias("top"), F.sum("k").alias("k"), F.sum("s").alias("s"), F.count("*").alias("comps"))
    blocks = lambda k, s, side, most: F.greatest(F.floor((k - 1) / side), F.floor((s - 1) / most)).cast("int") + 1
    largest = largest.filter("comps > 1").select(
        "cluster", F.col("top.component").alias("main"), blocks(F.col("k"), F.col("s"), CROWD, CROWD_SHINGLES).alias("cols"),
        blocks(F.col("k") - F.col("top.k"), F.col("s") - F.col("top.s"), STRAGGLERS, STRAGGLER_SHINGLES).alias("rows"),
    )
    apart = labelled.join(largest, "cluster").join(sets, "node")
    need = ["cluster", "row", "col", "node", "component", "hashes"]
    few = apart.filter("component != main").withColumns({"row": F.pmod(F.hash("node"), F.col("rows")), "col": F.explode(F.sequence(F.lit(0), F.col("cols") - 1))})
    crowd = apart.withColumns({"col": F.pmod(F.hash("node"), F.col("cols")), "row": F.explode(F.sequence(F.lit(0), F.col("rows") - 1))})
    place = ["cluster", "row", "col"]
    more = settled(few.select(*[F.col(c).alias(c) for c in need]).groupBy(*place).cogroup(crowd.select(*[F.col(c).alias(c) for c in need]).groupBy(*place)).applyInPandas(_block, "a long, b long"), "more-links")
    if not more.isEmpty():
        used_up(comps)
        comps = components(links.union(more))
    used_up(sets, labelled, links, more)

    of_node = nodes.join(comps, "node", "left").select("sig_a", "sig_b", "n", "doc_id", F.coalesce("component", "node").alias("component"))
    lowest = of_node.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_set = settled(of_node.join(lowest, "component").select("sig_a", "sig_b", "n", "component_id"), "classes")
    used_up(comps, nodes)
    alone = sketches.filter((F.col("n") == 0) | (F.col("doc_id") == NO_ID)).select("doc_id", "fp", "n", F.col("doc_id").alias("component_id"))
    return every, linked.join(of_set, ["sig_a", "sig_b", "n"]).select("doc_id", "fp", "n", "component_id").unionByName(alone)


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row; kept is the document that gives its component the id."""
    unique = unique_ids(df, doc_id)
    _, found = classes(df, doc_id, text)
    if not unique:  # a result row for each of the rows alike
        found = keyed(df, doc_id, text, unique).select("doc_id", "fp").join(found, ["doc_id", "fp"])
    return found.select(real_id().alias("doc_id"), F.col("n").alias("n_shingles"), real_id("component_id").alias("component_id"), (F.col("doc_id") == F.col("component_id")).alias("kept"))


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, all columns unchanged; of rows alike in id and text, one."""
    unique = unique_ids(df, doc_id)
    _, found = classes(df, doc_id, text)
    kept = found.filter("doc_id = component_id").select(F.col("doc_id").alias("kept_id"), F.col("fp").alias("kept_fp"))
    i, f = fresh(df, "dup_id"), fresh(df, "dup_fp")
    own = F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id).cast("long"), F.col(text).isNull(), F.col(text).cast("string"))
    rows = df.withColumns({i: F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)), f: F.lit(0).cast("long") if unique else own})
    out = rows.join(kept, (F.col(i) == F.col("kept_id")) & (F.col(f) == F.col("kept_fp")), "left_semi")
    if not unique:
        out = out.dropDuplicates([i, f])
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
