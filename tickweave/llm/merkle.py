"""Merkle manifest of a dataset: hash trees of arity three, stored as aligned blocks in van Emde Boas layout.

Every row is a leaf. The leaves of a group (a source) are taken in the order of their ids and hashed three by three, level
by level, to the group's subroot; the subroots, in the order of the groups, likewise give the root.

A tree is cut into aligned subtrees of ``HEIGHT`` levels of edges. Each is one row of a table: its nodes lie in one binary
in van Emde Boas order, where the upper half of the levels comes first and then the lower subtrees one after another, each
cut the same way. An address is reckoned from level and number alone (``addresses``), for building as for finding siblings.
The roots of the blocks are the leaves of the next tier, until a group has one block. Blocks have at most 3**HEIGHT leaves,
so a group of any share of the rows is many small pieces of work. Proofs come back down the tiers: a block adds the
siblings inside it to the path of its own root.

A path is text, a line per level: the digests of the siblings on the left, ``.``, those on the right. Without ``.`` and line
ends it is the proof; putting a digest in place of the ``.`` folds it (``folded``).

Positions: rows are dealt by ranges of group, id and leaf and written once; only the first group of a range can have begun
in an earlier one, so its start (one small row per range) is all that ranges must know of each other. Rows that are equal
in all of these are told apart by their place in the written table, so a task that runs again deals them alike.

Defined results: null groups are one group and come first; null ids come first in their group; repeated rows are leaves of
their own; a null field hashes as ``-``, an empty text as ``0:``; an empty table has no rows and no root; extra columns do not
matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from binascii import hexlify
from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tickweave.llm.common import settled, used_up

ARITY, HEIGHT = 3, 6  # a block has at most ARITY**HEIGHT leaves
DIGEST = 32


def field(value: Column) -> Column:
    """How one field enters a leaf: ``-`` for null, else its length in bytes, ``:`` and its text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: Sequence[Column]) -> Column:
    """Digest of a row as lower-case hexadecimal digits."""
    return F.sha2(F.concat(*[field(x) for x in fields]), 256)


def _nodes(levels: int) -> int:
    return (ARITY**levels - 1) // (ARITY - 1)


@lru_cache
def addresses(height: int) -> tuple[np.ndarray, ...]:
    """For each depth (0 is the root) the places of its nodes in a full tree of ``height`` levels of edges."""
    levels = height + 1
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top = levels // 2
    upper, lower = addresses(top - 1), addresses(levels - top - 1)
    first = _nodes(top) + _nodes(levels - top) * np.arange(ARITY**top)[:, None]
    return (*upper, *[(first + x).ravel() for x in lower])


def height_of(block: int, n: int, full: int) -> int:
    """Levels of a block: all of them, but only as many as it takes where a block is alone in its group."""
    if block > 0:
        return full
    return next(h for h in range(full + 1) if ARITY**h >= n)


def build_block(block: int, leaves: list[str], full: int) -> bytes:
    """The nodes of a block by address; places without a node are zero."""
    height = height_of(block, len(leaves), full)
    store = np.zeros((_nodes(height + 1), DIGEST), np.uint8)
    place, digits = addresses(height), "".join(leaves).encode()
    for depth in range(height, -1, -1):
        n = len(digits) // (2 * DIGEST)
        store[place[depth][:n]] = np.frombuffer(bytes.fromhex(digits.decode()), np.uint8).reshape(n, DIGEST)
        step = ARITY * 2 * DIGEST
        digits = b"".join([hashlib.sha256(digits[k : k + step]).hexdigest().encode() for k in range(0, len(digits), step)])
    return store.tobytes()


def block_paths(block: int, n: int, nodes: bytes, above: str, full: int) -> list[str]:
    """Paths of all leaves of a block, where ``above`` is the path of its root."""
    height = height_of(block, n, full)
    store, place = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST), addresses(height)
    paths = [above]
    for depth in range(1, height + 1):
        count = -(-n // ARITY ** (height - depth))
        digits = hexlify(store[place[depth][:count]].tobytes()).decode()
        below = []
        for k in range(count):
            here, first, last = 2 * DIGEST * k, 2 * DIGEST * (k - k % ARITY), 2 * DIGEST * min(k - k % ARITY + ARITY, count)
            below.append(f"{digits[first:here]}.{digits[here + 2 * DIGEST : last]}\n{paths[k // ARITY]}")
        paths = below
    return paths


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and a path give."""
    return F.aggregate(F.split(path, "\n"), leaf, lambda at, line: F.when(line == "", at).otherwise(F.sha2(F.replace(line, F.lit("."), at), 256)))


def proof_of(path: Column) -> Column:
    return F.translate(path, ".\n", "")


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows``, a table as ``settled`` gives it, with ``pos``: 0, 1, ... within each ``grp`` in the order of ``order``."""
    keys = ["grp", *order, "_file", "_row"]
    rows = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    dealt = settled(rows.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("grp", "_part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("grp").alias("_grp"), F.col("_part").alias("_in"), F.sum("n").over(before).alias("_start")).filter("_start > 0")
    starts = F.broadcast(starts)  # at most one row per range
    placed = dealt.withColumn("_at", F.row_number().over(Window.partitionBy("_part", "grp").orderBy(*keys[1:])))
    placed = placed.join(starts, (F.col("_part") == F.col("_in")) & F.col("grp").eqNullSafe(F.col("_grp")), "left")
    pos = (F.coalesce("_start", F.lit(0)) + F.col("_at") - 1).cast("long")
    placed = placed.withColumn("pos", pos).drop("_file", "_row", "_part", "_at", "_in", "_grp", "_start")
    out = settled(placed, "numbered")
    used_up(dealt)
    return out


BLOCKS = "grp string, block bigint, n int, nodes binary, root string"


def tier(leaves: DataFrame, height: int) -> DataFrame:
    """Blocks over rows ``grp, pos, digest``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, out = None, [], []

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_pylist(out, pa.schema([("grp", pa.string()), ("block", pa.int64()), ("n", pa.int32()), ("nodes", pa.binary()), ("root", pa.string())]))
            out.clear()
            return table.combine_chunks().to_batches()[0]

        def close():
            if here is not None:
                nodes = build_block(here[1], held, height)
                out.append({"grp": here[0], "block": here[1], "n": len(held), "nodes": nodes, "root": nodes[:DIGEST].hex()})

        for batch in batches:
            for grp, block, digest in zip(*[batch.column(c).to_pylist() for c in ("grp", "block", "digest")]):
                if (grp, block) != here:
                    close()
                    if len(out) >= 100:
                        yield flush()
                    here, held = (grp, block), []
                held.append(digest)
        close()
        if out:
            yield flush()

    rows = leaves.select("grp", _block(height).alias("block"), "pos", "digest")
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos").select("grp", "block", "digest").mapInArrow(build, BLOCKS)


def with_paths(children: DataFrame, blocks: DataFrame, height: int) -> DataFrame:
    """``children`` (``grp``, ``pos`` and any other columns) with ``path`` and ``top``, the root of the group.

    ``blocks`` have ``above``, the path of their root, and ``top``. A block's row goes ahead of its children's rows, so a
    task holds one block at a time.
    """
    kept = children.columns

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, top = [], None
        for batch in batches:
            rows, told, tops = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("_block", "pos", "_n", "_nodes", "_above", "_top")]
            for k, (block, pos, n, nodes, above, its_top) in enumerate(zip(*columns)):
                if pos is None:
                    paths, top = block_paths(block, n, nodes, above, height), its_top
                else:
                    rows.append(k)
                    told.append(paths[pos - block * ARITY**height])
                    tops.append(top)
            taken = batch.select(kept).take(pa.array(rows, pa.int64()))
            for k in range(0, len(rows), 1000):
                more = [pa.array(x[k : k + 1000], pa.string()) for x in (told, tops)]
                yield pa.RecordBatch.from_arrays([*taken.slice(k, 1000).columns, *more], names=[*kept, "path", "top"])

    heads = blocks.select("grp", *[F.col(c).alias(f"_{c}") for c in ("block", "n", "nodes", "above", "top")])
    rows = children.withColumn("_block", _block(height)).unionByName(heads, allowMissingColumns=True)
    rows = rows.repartition("grp", "_block").sortWithinPartitions("grp", "_block", "pos")  # nulls first: the block, then its children
    return rows.mapInArrow(descend, T.StructType([*children.schema.fields, T.StructField("path", T.StringType()), T.StructField("top", T.StringType())]))


def forest(leaves: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """All tiers of blocks over ``grp, pos, digest``, and the root of each group: ``grp, digest``.

    A block that is alone in its group and not full ends it; all others send their roots to the next tier.
    """
    tiers = []
    while True:
        tiers.append(settled(tier(leaves, height), "blocks"))
        rest = tiers[-1].filter(~_ends(height)).select("grp", F.col("block").alias("pos"), F.col("root").alias("digest"))
        if rest.isEmpty():
            break
        leaves = rest
    ends = [t.filter(_ends(height)).select("grp", F.col("root").alias("digest")) for t in tiers]
    return tiers, reduce(DataFrame.union, ends)


def _ends(height: int) -> Column:
    return (F.col("block") == 0) & (F.col("n") < ARITY**height)


def _block(height: int) -> Column:
    return F.expr(f"pos div {ARITY**height}")


def descended(tiers: list[DataFrame], children: DataFrame, tops: DataFrame, height: int) -> DataFrame:
    """``children`` (``grp``, ``pos``, ...) with ``path`` and ``top`` through all tiers; ``tops`` has ``grp, digest, path`` of each group's root."""
    tops = tops.select(F.col("grp").alias("_grp"), F.col("path").alias("above"), F.col("digest").alias("top"))
    above = None
    for k in range(len(tiers) - 1, -1, -1):
        blocks = tiers[k].filter(_ends(height)).join(tops, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")
        if above is not None:
            parents = above.select(F.col("grp").alias("_grp"), F.col("pos").alias("_pos"), F.col("path").alias("above"), "top")
            going = tiers[k].filter(~_ends(height)).join(parents, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("block") == F.col("_pos"))).drop("_grp", "_pos")
            blocks = blocks.unionByName(going)
        if k == 0:
            return with_paths(children, blocks, height)
        above = settled(with_paths(tiers[k - 1].filter(~_ends(height)).select("grp", F.col("block").alias("pos")), blocks, height), "paths")


def merkle_manifest(
    df: DataFrame, fields: Sequence[Column], doc_id: str = "doc_id", source: str = "source", found: Sequence[Column] | None = None,
    height: int = HEIGHT,
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, leaf, subroot, root, path, folded_root, verified``.

    ``fields`` are hashed into the manifest. ``found`` are the same fields as they are when the rows are verified against it
    (the same ones if not given): their digest is folded along the path, and a row is verified if that gives the root.
    """
    rows = df.select(F.col(source).cast("string").alias("grp"), F.col(doc_id).alias("id"), leaf_of(fields).alias("digest"), leaf_of(fields if found is None else found).alias("found"))
    leaves = settled(rows, "leaves")
    rows = numbered(leaves, ["id", "digest"])
    used_up(leaves)
    tiers, subroots = forest(rows, height)
    groups = numbered(settled(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest"), "subroots"), ["name"])
    upper, root = forest(groups, height)
    root = root.withColumn("path", F.lit(""))  # one row, none if there are no rows
    subroots = settled(descended(upper, groups, root, height).select(F.col("name").alias("grp"), "digest", "path"), "subroot-paths")
    out = descended(tiers, rows, subroots, height)
    top = F.broadcast(root.select(F.col("digest").alias("root")))
    out = out.join(top).withColumn("folded_root", folded(F.col("found"), F.col("path")))
    return out.select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), F.col("top").alias("subroot"), "root", "path", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
