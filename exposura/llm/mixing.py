"""Mixing sources to target weights by exact cuts in a random order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from exposura.llm.common import WORD, free_name

CELL_DIGITS = 3


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """Rows (source, source_size) get rank, weight and target.

    Sources in code point order, null last, take the weights in turn and share
    `share` of all sizes by weight. No target exceeds `epochs` times its source;
    what is above is shared again among the others. Ordered by the ratio of limit to
    weight, the sources at their limit come first, so prefix sums give the answer
    that repeated sharing ends with. The table has a row per source; that, and no
    row of the data, is what the one ordered pass reads.
    """
    named = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(w) for w in weights])
    limit = F.col("source_size") * epochs
    ranked = (
        sizes.withColumn("rank", F.row_number().over(named))
        .withColumn("weight", F.element_at(turn, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("limit", limit)
    )
    order = W.orderBy(F.col("limit") / F.col("weight"), "rank")
    everything = W.partitionBy()
    level = (share * F.col("total") - F.col("before")) / F.col("weight_left")
    leveled = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("before", F.coalesce(F.sum("limit").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("level", level)
        .withColumn("free", F.col("limit") / F.col("weight") > F.col("level"))
    )
    best = F.max(F.when(F.col("free"), F.col("level"))).over(everything)
    target = F.when(F.col("free"), best * F.col("weight")).otherwise(F.col("limit").cast("double"))
    return leveled.select("source", "source_size", "rank", "weight", target.alias("target"))


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=(3, 1, 2), share: float = 1.5, epochs: int = 2, keep_columns: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken, copies.

    Each row gets a random key, the MD5 of its id. Within a source, rows are taken
    in the order of (key, id, size) until their words reach the target, rounded to
    whole words; a target above the source goes round again. The row at the cut is
    taken in part: `taken` counts words, so a source's sum is its target. `copies`
    is for a caller that cannot cut a text: the number of times the whole row is
    repeated, with the row at the cut in where at least half of it is taken.
    With keep_columns, the input's columns come back with `copies` alone (under a
    free name, the last column).

    The order is a range sort: keys are uniform, so their first digits deal each
    source, however large, into cells of equal share; a cell's start is the sum of
    the cells before it (at most 4096 per source), and only a cell is sorted in one
    task. A null text has size 0, a null source is a source of its own, rows with
    null ids are ordered by size; equal rows are interchangeable. An empty table gives no rows.
    """
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]) if keep_columns else F.lit(None)
    rows = df.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), key.alias("key"), row.alias("row")
    ).select("*", F.substring("key", 1, CELL_DIGITS).alias("cell"))
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    before = F.sum("cell_size").over(W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, -1))
    starts = cells.select("source", "cell", F.coalesce(before, F.lit(0)).alias("cell_start"))
    targets = source_targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, share, epochs)
    plan = starts.join(targets, starts.source.eqNullSafe(targets.source)).select(
        starts.source.alias("s"), F.col("cell").alias("c"), "cell_start", "source_size", "target")

    joined = rows.join(plan, rows.source.eqNullSafe(plan.s) & (rows.cell == plan.c)).drop("s", "c")
    inside = W.partitionBy(F.coalesce("source", F.lit("")), F.col("source").isNull(), "cell").orderBy("key", "doc_id", "size")
    start = F.col("cell_start") + F.coalesce(F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - F.col("rounds") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start")))
    taken = (
        joined.withColumn("start", start).withColumn("rounds", whole).withColumn("rest", rest).withColumn("part", part)
        .withColumn("taken", (F.col("size") * F.col("rounds") + F.col("part")).cast("long"))
        .withColumn("copies", (F.col("rounds") + F.when(
            (F.col("start") < F.col("rest")) & (F.col("part") * 2 >= F.col("size")), 1).otherwise(0)).cast("long"))
    )
    if keep_columns:
        return taken.select("row.*", F.col("copies").alias(free_name(df, "copies")))
    return taken.select("doc_id", "source", "size", "source_size", "target", "taken", "copies")


def mixed_rows(df: DataFrame, **settings) -> DataFrame:
    """The mix itself: the columns of df, each row as often as `copies` says."""
    counted = mix(df, keep_columns=True, **settings)
    copies = counted.columns[-1]
    return counted.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.explode(F.when(F.col(copies) > 0, F.sequence(F.lit(1), F.col(copies))).otherwise(F.array().cast("array<bigint>")))
        .alias(copies)).drop(copies)
