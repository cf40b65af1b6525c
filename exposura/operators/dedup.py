"""Deduplication and keyword matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from exposura import rules
from exposura.functions import text
from exposura.operators.windows import first_per_key, latest_per_key


def thread_hash(title: Column, forum: Column) -> Column:
    return F.sha2(F.concat_ws("|", text.strip(F.lower(title)), forum.cast("string")), 256)


def unique_sparse(df: DataFrame, key: str, order: list[str], cols: list[str]) -> DataFrame:
    """First row per key; rows without a key are all kept.

    One pass over the input: rows without a key group by their own columns, so that
    they are spread over all tasks, and come back as often as they were counted.
    """
    row = F.struct(*cols)
    loose = F.when(F.col(key).isNull(), F.struct(row, F.struct(*order)))
    picked = df.groupBy(F.col(key).alias("_key"), loose.alias("_loose")).agg(
        F.min_by(row, F.struct(*order)).alias("_row"), F.count("*").alias("_n")
    )
    times = F.when(F.col("_key").isNull(), F.col("_n")).otherwise(1)
    repeated = picked.select("_row", F.explode(F.sequence(F.lit(1), times)).alias("_i"))
    return repeated.select(*[F.col(f"_row.{c}").alias(c) for c in cols])


def dedup_composite(df: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """First row per lower-cased combination of columns."""
    lowered = df.withColumns({f"_k_{k}": F.lower(F.col(k).cast("string")) for k in keys})
    return first_per_key(lowered, [f"_k_{k}" for k in keys], order, cols).select(*cols)


def insert_or_ignore(existing: DataFrame, incoming: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Existing rows and the first incoming row of every new key."""
    fresh = first_per_key(incoming, key, order, incoming.columns)
    added = fresh.join(existing.select(*key), key, "left_anti").select(*existing.columns)
    return existing.unionByName(added)


def upsert(existing: DataFrame, incoming: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key, the newest; incoming rows win over existing ones of equal order."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return latest_per_key(both, key, [*order, "_new"], existing.columns).select(*existing.columns)


def entry_dedup(df: DataFrame, site: str, title: str, order: list[str], cols: list[str]) -> DataFrame:
    """First row per site and lower-cased title; blank titles go."""
    named = df.filter(F.coalesce(text.strip(F.col(title)), F.lit("")) != "")
    return dedup_composite(named, [site, title], order, cols)


def parse_keywords(lines: list[str]) -> list[str]:
    """Keyword file to list: stripped, lower case, blank and # lines ignored."""
    return [k.strip().lower() for k in lines if k.strip() and not k.startswith("#")]


def _title_and_content(title: str, content: str) -> Column:
    return F.concat(
        F.coalesce(F.col(title), F.lit("")), F.lit(" "), F.coalesce(F.col(content), F.lit(""))
    )


def keyword_flag(
    df: DataFrame, title: str, content: str, keywords: list[str] = rules.KEYWORDS,
    out: str = "matched_keywords",
) -> DataFrame:
    """Adds the keywords found in title and content, in list order; empty means not flagged."""
    return df.withColumn(out, text.matched_words(_title_and_content(title, content), keywords))


def keyword_flagged(
    df: DataFrame, title: str, content: str, keywords: list[str] = rules.KEYWORDS,
    out: str = "matched_keywords",
) -> DataFrame:
    """Only the flagged rows, with their keywords."""
    found = text.matched_words_or_none(_title_and_content(title, content), keywords)
    return df.select("*", F.explode(found).alias(out))
