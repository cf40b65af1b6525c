"""A Merkle manifest of a dataset whose versions share what they do not change."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from exposura.llm.common import saved

ARITY = 3
LEVELS = 6


def joined_hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Node:
    """A node that is never changed; versions hold it in common."""

    __slots__ = ("digest", "kids")

    def __init__(self, digest: str, kids: tuple["Node", ...] = ()):
        self.digest, self.kids = digest, kids

    @classmethod
    def over(cls, kids: tuple["Node", ...]) -> "Node":
        return cls(joined_hash([k.digest for k in kids]), kids)


def grown(leaves: list[str], levels: int, arity: int = ARITY) -> Node:
    """The tree over the leaves, `levels` high, every run of `arity` nodes below one."""
    row = [Node(d) for d in leaves]
    for _ in range(levels):
        row = [Node.over(tuple(row[k:k + arity])) for k in range(0, len(row), arity)]
    return row[0]


def path_to(root: Node, leaf: int, levels: int, arity: int = ARITY) -> list[tuple[Node, int]]:
    """(node, which of its kids) from the root down to the leaf's parent."""
    path, node = [], root
    for level in range(levels - 1, -1, -1):
        turn = leaf // arity ** level % arity
        path.append((node, turn))
        node = node.kids[turn]
    return path


def version(root: Node, leaf: int, digest: str, levels: int, arity: int = ARITY) -> Node:
    """The tree with one leaf replaced: its ancestors are copied, all else is shared."""
    node = Node(digest)
    for above, turn in reversed(path_to(root, leaf, levels, arity)):
        node = Node.over((*above.kids[:turn], node, *above.kids[turn + 1:]))
    return node


def siblings(path: list[tuple[Node, int]]) -> list[str]:
    """Of each level from the leaf's up: the digests left of the path, and those right of it."""
    out = []
    for node, turn in reversed(path):
        out.append("".join(k.digest for k in node.kids[:turn]))
        out.append("".join(k.digest for k in node.kids[turn + 1:]))
    return out


def folded(digest: str, path: list[str]) -> str:
    """The digest carried up a path as `siblings` gives it."""
    for k in range(0, len(path), 2):
        digest = joined_hash([path[k], digest, path[k + 1]])
    return digest


def levels_of(n: int, arity: int, levels: int) -> int:
    """Levels a block takes: all of them if the sequence goes on above, else up to its root."""
    if n > arity ** levels:
        return levels
    up = 0
    while n > 1:
        n, up = -(-n // arity), up + 1
    return up


def ranked(rows: DataFrame, group: str, order: list[str], label: str, numbers: DataFrame | None = None) -> DataFrame:
    """The rows with `idx`, their place from 0 within the group, and `n`, the group's size;
    with `numbers`, a row per group, also its other columns.

    A range sort over all tasks, whatever a group's share; it is written, so the
    places stay as they are. Starts of a group in each range are sums over ranges, a
    table of one row per range and one more per further group.
    """
    sorted_ = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = saved(sorted_.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), label)
    counts = placed.groupBy(group, "part").agg(F.min("at").alias("first"), F.count("*").alias("m"))
    by_range = W.partitionBy(group).orderBy("part")
    before = F.coalesce(F.sum("m").over(by_range.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(
        F.col(group).alias("g_"), F.col("part").alias("p_"), (before - F.col("first")).alias("shift"),
        F.sum("m").over(W.partitionBy(group)).alias("n"))
    extra = []
    if numbers is not None:
        extra = [c for c in numbers.columns if c != group]
        starts = starts.join(numbers, starts.g_.eqNullSafe(numbers[group])).drop(group)
    starts = saved(starts, f"{label}-starts")
    met = placed.join(starts, (placed.part == starts.p_) & placed[group].eqNullSafe(starts.g_))
    return met.select(*rows.columns, (F.col("at") + F.col("shift")).alias("idx"), "n", *extra)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one block after the other; a block may go on in the next batch."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, block in groupby(rows, key=lambda r: (r["g"], r["block"])):
        yield list(block)


def _dealt(rows: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """Rows by block, in order; a row of `more` (idx -1) comes before its block's."""
    rows = rows.unionByName(more, allowMissingColumns=True) if more is not None else rows
    return rows.repartition("g", "block").sortWithinPartitions("g", "block", "idx")


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    kept = []
    for row in rows:
        kept.append(row)
        if len(kept) == 2048:
            yield _batch(kept, schema)
            kept = []
    if kept:
        yield _batch(kept, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


ROOTS = pa.schema([("g", pa.int64()), ("idx", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
PATHS = pa.schema([("g", pa.int64()), ("idx", pa.int64()), ("path", pa.list_(pa.string()))])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.string(): "string", pa.list_(pa.string()): "array<string>", pa.int32(): "int", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


class Forest:
    """Trees over sequences: rows (g, idx, n, digest), idx from 0 to n - 1 within each g.

    A block is `arity ** levels` neighbours, aligned, so a block's tree is part of
    the whole tree and is built by one task. The roots of blocks are the sequence
    of the next round; there are as many rounds as the longest sequence needs.
    """

    def __init__(self, nodes: DataFrame, label: str, arity: int = ARITY, levels: int = LEVELS):
        self.arity, self.levels, self.label = arity, levels, label
        self.rounds = [nodes]
        longest = nodes.agg(F.max("n")).first()[0] or 0
        while longest > 1 or len(self.rounds) == 1:
            self.rounds.append(saved(self._roots(self.rounds[-1]), f"{label}-roots"))
            longest = -(-longest // arity ** levels)

    def blocked(self, nodes: DataFrame) -> DataFrame:
        return nodes.withColumn("block", F.floor(F.col("idx") / self.arity ** self.levels))

    def _roots(self, nodes: DataFrame) -> DataFrame:
        arity, levels = self.arity, self.levels

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows():
                for block in _blocks(batches):
                    n = block[0]["n"]
                    root = grown([r["digest"] for r in block], levels_of(n, arity, levels), arity)
                    yield block[0]["g"], block[0]["block"], -(-n // arity ** levels), root.digest
            yield from _batches(rows(), ROOTS)

        return _dealt(self.blocked(nodes).select("g", "block", "idx", "n", "digest")).mapInArrow(run, _ddl(ROOTS))

    def roots(self) -> DataFrame:
        """(g, digest): one root per sequence."""
        return self.rounds[-1].select("g", "digest")

    def paths(self, above: DataFrame, level: int = 0) -> DataFrame:
        """(g, idx, path): what lies beside the way from each node of a round to the root.

        `above` (g, path) is what lies beside the way on from each sequence's root.
        """
        if level == len(self.rounds) - 1:
            ends = self.rounds[level].select("g", "idx").join(above, "g", "left")
            return ends.withColumn("path", F.coalesce("path", F.array().cast("array<string>")))
        return saved(self._down(level, self.block_paths(above, level)), f"{self.label}-paths")

    def block_paths(self, above: DataFrame, level: int = 0) -> DataFrame:
        """(g, block, idx -1, path) of the blocks of a round."""
        return self.paths(above, level + 1).select("g", F.col("idx").alias("block"), F.lit(-1).cast("long").alias("idx"), "path")

    def _down(self, level: int, upper: DataFrame) -> DataFrame:
        arity, levels = self.arity, self.levels

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows():
                for (above, *block) in _blocks(batches):
                    up = levels_of(block[0]["n"], arity, levels)
                    root = grown([r["digest"] for r in block], up, arity)
                    for k, r in enumerate(block):
                        yield r["g"], r["idx"], siblings(path_to(root, k, up, arity)) + above["path"]
            yield from _batches(rows(), PATHS)

        return _dealt(self.blocked(self.rounds[level]).select("g", "block", "idx", "n", "digest"), upper).mapInArrow(run, _ddl(PATHS))


PROVED = pa.schema([
    ("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
    ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])


def framed(column: Column) -> Column:
    """A value with its length, so that neighbouring values cannot be mistaken; null: a dash."""
    value = column.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value), F.lit(":"), value))


def manifest(
    df: DataFrame, id_col: str = "doc_id", source_col: str = "source", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    changed: dict[str, Column] | None = None, where: Column | None = None, arity: int = ARITY, levels: int = LEVELS,
) -> DataFrame:
    """One row per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the SHA-256 of the framed columns. A source's leaves, by id, form a tree
    of which every node covers up to `arity` neighbours; the sources' roots, by name,
    form another above. The proof is what lies beside the way from the leaf to the
    root. A row for which `where` holds is tampered with: `changed` has columns by
    name to take instead. Its version of the tree copies the leaf's ancestors within
    the block and shares all else; above the block it is carried on by the path.
    `folded_root` is where the row's version, or the leaf itself, ends up.

    A null id comes first in its source and is not tampered with unless `where` says
    so; rows of one id are ordered by leaf, equal ones are interchangeable; a null
    source is a source of its own, before all others; null and empty texts differ. An
    empty table gives no rows; columns besides the named ones are not read.

    Texts are hashed where they are read; only ids and digests move. A block has at
    most arity ** levels leaves whatever a source's share, and goes to one task; a
    sequence of blocks goes on in the next round, and so does one of sources.
    """
    def leaf(values: dict[str, Column]) -> Column:
        return F.sha2(F.concat(*[framed(values.get(c, F.col(f"`{c}`"))) for c in columns]), 256)

    tampered = F.when(where, leaf(changed)) if changed and where is not None else F.lit(None).cast("string")
    digests = saved(df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), leaf({}).alias("digest"), tampered.alias("changed")), "merkle-leaves")

    names = digests.groupBy("source").agg(F.count("*").alias("size")).withColumn("all", F.lit(0))
    numbered = saved(ranked(names, "all", ["source"], "merkle-sources"), "merkle-numbers")
    numbers = numbered.select("source", F.col("idx").alias("g"))
    leaves = saved(ranked(digests, "source", ["doc_id", "digest"], "merkle-order", numbers), "merkle-ranked")

    within = Forest(leaves.select("g", "idx", "n", "digest"), "merkle", arity, levels)
    subroots = within.roots()
    sources = Forest(
        subroots.join(numbered.select(F.col("idx").alias("g"), "n"), "g").select(F.lit(0).cast("long").alias("g"), F.col("g").alias("idx"), "n", "digest"),
        "merkle-top", arity, levels)
    nothing = df.sparkSession.createDataFrame([], "g long, path array<string>")
    above = sources.paths(nothing).select(F.col("idx").alias("g"), "path")
    whole = sources.roots().first()
    tops = subroots.select("g", F.col("digest").alias("subroot"), F.lit(whole["digest"] if whole else "").alias("root"))
    blocks = within.block_paths(above).join(tops, "g")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (top, *block) in _blocks(batches):
                up = levels_of(block[0]["n"], arity, levels)
                tree = grown([r["digest"] for r in block], up, arity)
                for k, r in enumerate(block):
                    beside = siblings(path_to(tree, k, up, arity))
                    if r["changed"] is None:
                        here = folded(r["digest"], beside)
                    else:
                        here = version(tree, k, r["changed"], up, arity).digest
                    end = folded(here, top["path"])
                    yield r["doc_id"], r["digest"], top["subroot"], top["root"], joined_hash(beside + top["path"]), end, end == top["root"]
        yield from _batches(rows(), PROVED)

    return _dealt(within.blocked(leaves), blocks).mapInArrow(run, _ddl(PROVED))
