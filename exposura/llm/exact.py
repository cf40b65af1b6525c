"""Exact dedup with salted hot groups, DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from exposura.llm.common import lower_ascii, saved


def exact_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64, shares: int = 1000,
    key: Callable[[Column], Column] = lambda sha: sha,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after lower-casing A-Z; a null text counts
    as empty. The largest id of a group stays. Rows that repeat an id and its text
    count in group_size and share one answer; a null id never wins against another
    and stays only where the whole group has none. An empty table gives no rows;
    columns besides the two named are not read.

    Three stages, each of which compares whole texts and not only digests:

    1. Rows with equal text combine within their task, before anything moves.
    2. What remains meets by (digest, salt, text). Only a digest that more than one
       row in `shares` has is salted, by its ids, so there are fewer than `shares`
       such digests and the list of them is small whatever the input.
    3. The winners of a salted digest, at most `salts` for each text, meet by
       (digest, text).

    Every row then finds its winner by (digest, salt), which carries no text. Digests
    that stand for more than one text, if any, are looked up by the text itself.
    `key` shortens the digest, for tests of that case.
    """
    texts = df.select(F.col(id_col).alias("doc_id"), lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    hashed = texts.withColumn("sha", F.unhex(F.sha2("norm", 256)))
    ids = saved(hashed.select("doc_id", "sha"), "exact-ids").withColumn("digest", key(F.col("sha")))
    least = F.greatest(F.lit(salts), F.floor(F.lit(ids.count() / shares)))
    hot = saved(ids.groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") > least).select("digest"), "exact-hot")

    def salted(rows: DataFrame) -> DataFrame:
        marked = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "digest", "left")
        salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(salts)) + 1).otherwise(F.lit(0))
        return marked.withColumn("salt", salt.cast("int")).drop("hot")

    combined = (
        salted(hashed.withColumn("digest", key(F.col("sha"))).drop("sha"))
        .groupBy("digest", "salt", "norm")
        .agg(F.max("doc_id").alias("top"), F.count("*").alias("n"))
    )
    winners = saved(combined.withColumn("norm", F.when(F.col("salt") > 0, F.col("norm"))), "exact-winners")
    same = W.partitionBy("digest", "norm")
    merged = winners.where("salt > 0").select(
        "digest", "salt", F.max("top").over(same).alias("keep_id"), F.sum("n").over(same).alias("group_size"))
    found = winners.where("salt = 0").select(
        "digest", "salt", F.col("top").alias("keep_id"), F.col("n").alias("group_size")).union(merged)
    rows = salted(ids)

    clash = saved(winners.groupBy("digest", "salt").count().where("count > 1").select("digest", "salt"), "exact-clash")
    if clash.isEmpty():
        return _shaped(rows.join(found, ["digest", "salt"]))
    clear = rows.join(clash, ["digest", "salt"], "left_anti").join(found, ["digest", "salt"])
    unclear = salted(hashed.withColumn("digest", key(F.col("sha")))).join(clash.select("digest").distinct(), "digest", "left_semi")
    by_salt = unclear.groupBy("digest", "salt", "norm").agg(F.max("doc_id").alias("top"), F.count("*").alias("n"))
    winner = by_salt.select(
        "digest", "salt", "norm", F.max("top").over(same).alias("keep_id"), F.sum("n").over(same).alias("group_size"))
    compared = unclear.join(clash, ["digest", "salt"], "left_semi").join(winner, ["digest", "salt", "norm"]).drop("norm")
    return _shaped(clear).union(_shaped(compared))


def _shaped(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
