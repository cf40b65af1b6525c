"""Resharding by a minimum-cost flow between old shards and new capacities."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

BUCKETS = 8192
SPLITS = 32
FINE = 64
FILES_PER_SHARD = 64


def min_cost_flow(sizes: list[int], capacities: list[int], cost: np.ndarray) -> np.ndarray:
    """Bytes each old shard sends to each new one, of least total cost.

    Successive shortest paths; sizes and capacities have equal sums. The graph has a
    node per shard and nothing per row.
    """
    n, m = len(sizes), len(capacities)
    flow = np.zeros((n, m), dtype=np.int64)
    supply, room = np.array(sizes, np.int64), np.array(capacities, np.int64)
    while supply.any():
        left = np.where(supply > 0, 0.0, np.inf)
        right, via_left, via_right = np.full(m, np.inf), np.full(m, -1), np.full(n, -1)
        for _ in range(n + m):
            step = left[:, None] + cost
            best = step.argmin(axis=0)
            reach = step[best, np.arange(m)]
            better = reach < right - 1e-12
            right[better], via_left[better] = reach[better], best[better]
            back = np.where(flow > 0, right[None, :] - cost, np.inf)
            best = back.argmin(axis=1)
            reach = back[np.arange(n), best]
            changed = reach < left - 1e-12
            left[changed], via_right[changed] = reach[changed], best[changed]
            if not better.any() and not changed.any():
                break
        j = int(np.where(room > 0, right, np.inf).argmin())
        path, amount, end = [], int(room[j]), j
        while True:
            i = int(via_left[j])
            path.append((i, j, 1))
            if via_right[i] < 0:
                break
            j = int(via_right[i])
            path.append((i, j, -1))
            amount = min(amount, int(flow[i, j]))
        amount = min(amount, int(supply[i]))
        for a, b, sign in path:
            flow[a, b] += sign * amount
        supply[i] -= amount
        room[end] -= amount
    return flow


def near_equal(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def assign_blocks(old: np.ndarray, size: np.ndarray, old_shards: int, capacities: list[int], cost: np.ndarray | None = None) -> np.ndarray:
    """New shard of each block: the flow rounded to whole blocks, then evened out.

    Blocks of an old shard are cut, in their order, into runs as long as its flows,
    the bytes that stay first. Rounding leaves each shard off by parts of blocks;
    blocks then go from the fullest to the emptiest shard while that helps.
    """
    shards = len(capacities)
    if cost is None:
        cost = 1.0 - np.eye(old_shards, shards)
    flow = min_cost_flow([int(size[old == i].sum()) for i in range(old_shards)], capacities, cost)
    to = np.full(len(size), -1)
    for i in range(old_shards):
        at = np.flatnonzero(old == i)
        if not len(at):
            continue
        targets = sorted(np.flatnonzero(flow[i] > 0), key=lambda j: (j != i, j)) or [min(i, shards - 1)]
        ends = np.cumsum([flow[i, j] for j in targets])
        middle = np.cumsum(size[at]) - size[at] / 2
        to[at] = np.array(targets)[np.minimum(np.searchsorted(ends, middle, side="right"), len(targets) - 1)]
    over = np.bincount(to, weights=size, minlength=shards) - np.array(capacities) if len(size) else np.zeros(shards)
    for _ in range(64 * shards):
        full, empty = int(over.argmax()), int(over.argmin())
        at = np.flatnonzero(to == full)
        gap = over[full] - over[empty]
        if gap <= 1 or not len(at):
            break
        best = at[np.abs(size[at] - gap / 2).argmin()]
        if size[best] >= gap or size[best] == 0:
            break
        to[best] = empty
        over[full] -= size[best]
        over[empty] += size[best]
    return to


BLOCKS = T.StructType([
    T.StructField("b_bucket", T.IntegerType()), T.StructField("b_split", T.IntegerType()),
    T.StructField("shard", T.IntegerType()), T.StructField("old_shard", T.IntegerType()), T.StructField("first_slot", T.LongType()),
])


def plan(sized: DataFrame, old_shards: int, shards: int) -> tuple[DataFrame, np.ndarray]:
    """(block table, bytes moved between shards) for rows (bucket, split, old_shard, size).

    A block is a bucket of texts, so equal texts stay together; a bucket above a
    64th of all bytes, such as a text with very many copies, is split by its ids.
    There are at most 8192 + 64 * 32 blocks whatever the data, which bounds both
    what the driver plans over and what is broadcast.
    """
    cells = sized.groupBy("bucket", "split", "old_shard").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    in_bucket, overall = W.partitionBy("bucket"), sized.agg(F.sum("size").alias("total"))
    total = overall.first()["total"] or 0
    marked = cells.withColumn("big", F.sum("bytes").over(in_bucket) > total / FINE)
    blocks = (
        marked.withColumn("split", F.when(F.col("big"), F.col("split")).otherwise(F.lit(-1)))
        .groupBy("bucket", "split").agg(F.min("old_shard").alias("old_shard"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
        .toPandas().sort_values(["old_shard", "bucket", "split"], ignore_index=True)
    )
    size = blocks["bytes"].to_numpy(np.int64)
    blocks["shard"] = assign_blocks(blocks["old_shard"].to_numpy(), size, old_shards, near_equal(int(size.sum()), shards))
    blocks = blocks.sort_values(["shard", "bucket", "split"], ignore_index=True)
    n = blocks["n"].astype("int64")
    blocks["first_slot"] = n.groupby(blocks["shard"]).cumsum() - n
    moved = np.zeros((old_shards, max(shards, old_shards)), dtype=np.int64)
    np.add.at(moved, (blocks["old_shard"].to_numpy(int), blocks["shard"].to_numpy(int)), blocks["bytes"].to_numpy(np.int64))
    out = blocks.rename(columns={"bucket": "b_bucket", "split": "b_split"})[[f.name for f in BLOCKS]]
    rows = [tuple(int(v) for v in r) for r in out.itertuples(index=False)]
    return sized.sparkSession.createDataFrame(rows, BLOCKS), moved


def reshard(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", old_shards: int = 12, shards: int = 16, old_col: str | None = None,
    keep_columns: bool = False,
) -> DataFrame:
    """Rows doc_id, text, size, old_shard, shard, slot; with keep_columns also row, a
    struct of all columns of df.

    Size is the text's UTF-8 bytes plus one, null text: one. Without `old_col` the
    old layout is by text bucket, modulo the old shard count. The new shards have
    near equal bytes; a row moves only as far as the flow of fewest moved bytes
    needs. With `old_col` (int, 0 to old_shards - 1; null: 0) equal texts stay
    together only within one old shard. Slots count from 0 without gaps within a
    shard, in the order of (bucket, split, id). Equal rows share a block and differ
    in the slot; an empty table gives no rows; without keep_columns other columns are
    not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bucket = F.pmod(F.xxhash64(text), F.lit(BUCKETS)).cast("int")
    if old_col is not None:
        old = F.coalesce(F.col(old_col), F.lit(0)).cast("int")
        per = BUCKETS // old_shards
        bucket = (old * per + F.pmod(F.xxhash64(text), F.lit(per))).cast("int")
    else:
        old = F.pmod(bucket, F.lit(old_shards)).cast("int")
    split = F.pmod(F.xxhash64(id_col), F.lit(SPLITS)).cast("int")
    size = (F.octet_length(text) + 1).cast("long")
    kept = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if keep_columns else []
    rows = df.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), size.alias("size"),
        bucket.alias("bucket"), split.alias("split"), old.alias("old_shard"), *kept)
    blocks, _ = plan(rows.select("bucket", "split", "old_shard", "size"), old_shards, shards)
    met = rows.drop("old_shard").join(
        F.broadcast(blocks), (rows.bucket == blocks.b_bucket) & ((blocks.b_split < 0) | (blocks.b_split == rows.split)))
    dealt = met.withColumn("file", F.pmod(F.xxhash64("b_bucket", "b_split"), F.lit(FILES_PER_SHARD))).repartition("shard", "file")
    order = W.partitionBy("shard", "file", "b_bucket", "b_split").orderBy("doc_id")
    slot = (F.col("first_slot") + F.row_number().over(order) - 1).cast("long")
    return dealt.select("doc_id", "text", "size", "old_shard", "shard", slot.alias("slot"), *(["row"] if keep_columns else []))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard."""
    sharded.write.partitionBy("shard").parquet(path)


def rewrite_affected(spark: SparkSession, source: str, target: str, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Reshards a dataset stored as shard=N folders; only affected shards are written,
    with all their columns under their own names.

    A shard no byte enters or leaves keeps its old files. Returns the manifest: shard,
    path, rewritten. The old files stay until the caller switches over to the
    manifest, so a job that dies half way harms nothing.
    """
    old = spark.read.parquet(source)
    count = (old.agg(F.max("shard")).first()[0] or 0) + 1
    moved = reshard(old, id_col, text_col, count, shards, "shard", keep_columns=True)
    tally = moved.groupBy("old_shard", "shard").count().collect()
    touched = sorted({s for r in tally if r["old_shard"] != r["shard"] for s in (r["old_shard"], r["shard"])})
    kept = sorted({r["shard"] for r in tally} - set(touched))
    columns = [F.col(f"row.`{c}`") for c in old.columns if c != "shard"]
    write_shards(moved.where(F.col("shard").isin(touched)).select(*columns, "shard"), target)
    present = {r["shard"] for r in tally}
    listed = [(s, f"{target.rstrip('/')}/shard={s}", True) for s in touched if s in present]
    listed += [(s, f"{source.rstrip('/')}/shard={s}", False) for s in kept]
    return spark.createDataFrame(listed, "shard int, path string, rewritten boolean")
