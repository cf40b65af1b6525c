"""From raw documents to token counts: filter, dedup, near-dedup, mix, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exposura.llm import bpe, exact, minhash, mixing, quality
from exposura.llm.common import free_name, saved, table

ORACLE_SQL = None
SIMILAR = (80, 100)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned on these documents, does not reject."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    return docs.withColumn(score, quality.score_column(model, F.col("text"))).where(F.col(score) >= quality.THRESHOLD).drop(score)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows, written with a number for each, and the number's column."""
    number = free_name(docs, "row_number")
    return saved(docs.withColumn(number, F.monotonically_increasing_id()), "pipeline-numbered"), number


def _one_each(rows: DataFrame, number: str, groups: DataFrame, sign: int) -> DataFrame:
    """The row of each group (doc_id: the row's number, grouped) with the largest id
    (sign 1) or the smallest (sign -1); null ids come last, ties go to the first row.

    Winners combine in every task before they move, without texts.
    """
    known = F.col("doc_id").isNotNull()
    rank = F.struct(known.alias("known"), (F.col("doc_id") if sign > 0 else F.bitwise_not("doc_id")).alias("id"), F.negate(number).alias("first"))
    ranked = rows.select(F.col(number).alias("n"), rank.alias("rank"))
    best = ranked.join(groups.select(F.col("doc_id").alias("n"), "grouped"), "n").groupBy("grouped").agg(F.max("rank").alias("best"))
    return rows.join(best.select(F.negate("best.first").alias(number)), number, "left_semi").drop(number)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: of the largest id, the first of its rows."""
    rows, number = _numbered(docs)
    groups = exact.exact_groups(rows, id_col=number).withColumn("grouped", F.col("keep_id"))
    return _one_each(rows, number, groups, 1)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, linked from a similarity of 0.80 on: of
    the smallest id, the first of its rows; a row without words is a group of its own."""
    rows, number = _numbered(docs)
    groups = minhash.near_duplicates(rows, id_col=number, threshold=SIMILAR).withColumn("grouped", F.col("component_id"))
    return _one_each(rows, number, groups, -1)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; whole documents, the cut to the nearest."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every document of the mix."""
    return bpe.digests(docs)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over all documents, each one's rows written and read again."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = saved(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
