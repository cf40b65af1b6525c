"""Counts and summaries; all combine before they shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window

from exposura import rules
from exposura.functions import values


def count_where(pred: Column) -> Column:
    return F.count_if(pred)


def overall_stats(threads: DataFrame, forums: DataFrame, flagged: DataFrame, runs: DataFrame) -> DataFrame:
    """One row of totals; each table is read once, by a scalar subquery of its own."""
    flags = flagged.agg(
        F.struct(F.count("*").alias("n"), F.count_if(~F.col("reviewed")).alias("open")).alias("s")
    ).scalar()
    crawls = runs.agg(
        F.struct(F.max("started_at").alias("last"), F.max(F.col("status") == "running").alias("running")).alias("s")
    ).scalar()
    return threads.agg(F.count("*").alias("total_threads")).select(
        "total_threads",
        forums.filter("is_active").agg(F.count("*")).scalar().alias("active_forums"),
        flags["n"].alias("total_flagged"),
        flags["open"].alias("unreviewed"),
        crawls["last"].alias("last_run"),
        crawls["running"].alias("any_running"),
    )


def messages_span(df: DataFrame) -> DataFrame:
    return df.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("n"))


def media_coverage(df: DataFrame) -> DataFrame:
    media = F.col("media_type").isNotNull() & (F.col("media_type") != "MessageMediaWebPage")
    return df.agg(
        F.count_if(media).alias("media_total"),
        F.count_if(media & (F.coalesce(F.col("media_path"), F.lit("")) != "")).alias("media_with_path"),
    )


def dir_rollup(catalog: DataFrame) -> DataFrame:
    """Per directory: number of children and total size of its files."""
    return catalog.groupBy("parent_path").agg(
        F.count("*").alias("child_count"),
        F.sum(F.when(~F.col("is_directory"), F.col("file_size_bytes")).otherwise(0)).alias("total_size"),
    )


def catalog_totals(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("is_directory").agg(F.count("*").alias("n"))


def file_type_summary(catalog: DataFrame) -> DataFrame:
    """Totals and the tracked extensions that occur.

    The set holds tracked extensions only, so it is as small as their list.
    """
    ext = F.col("extension")
    tracked = F.when(ext.isin(rules.TRACKED_SUFFIXES), ext)
    return catalog.filter(~F.col("is_directory")).agg(
        F.count("*").alias("file_count"),
        F.count_if(ext.isin(rules.SCREENSHOT_SUFFIXES)).alias("image_count"),
        F.array_join(F.sort_array(F.collect_set(tracked)), ",").alias("file_types"),
    )


def skip_rate(df: DataFrame, skipped: Column) -> DataFrame:
    return df.agg(F.count("*").alias("parsed"), F.count_if(skipped).alias("skipped")).select(
        "parsed", "skipped", values.skip_rate(F.col("skipped"), F.col("parsed")).alias("rate")
    )


def canary_skip_rate(
    df: DataFrame, skipped: Column, source: str, ordinal: str, n: int = 20000, threshold: float = 0.60
) -> DataFrame:
    """Per file, the rate over its first n rows and whether it asks for a second schema.

    The ordinal counts the rows of a file from 1, so the probe is a filter that
    reaches the scan, and neither a sort nor a limit.
    """
    rates = df.filter(F.col(ordinal) <= n).groupBy(source).agg(
        F.count("*").alias("parsed"), F.count_if(skipped).alias("skipped")
    )
    rate = values.skip_rate(F.col("skipped"), F.col("parsed"))
    return rates.withColumn("rate", rate).withColumn("second_schema", F.col("rate") > threshold)


def top_by_count(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """Most frequent keys; ties by name."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(n)


def first_names(df: DataFrame, group: str, name: str, n: int = 20) -> DataFrame:
    """The alphabetically first n distinct names of every group, in one column.

    Names are made distinct and ranked before they are gathered, so a group
    brings at most n values to its task.
    """
    ranked = (
        df.select(group, name)
        .filter(F.col(name).isNotNull() & (F.col(name) != ""))
        .distinct()
        .withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(name)))
        .filter(F.col("_rank") <= n)
    )
    return ranked.groupBy(group).agg(F.sort_array(F.collect_list(name)).alias("names"))


def host_statistics(df: DataFrame, host: str, kind: str, count: str, kinds: list[str]) -> DataFrame:
    """Per host a total and a has_ flag for every kind."""
    sums = [F.sum(F.when(F.col(kind) == k, F.col(count)).otherwise(0)).alias(f"total_{k}") for k in kinds]
    totals = df.groupBy(host).agg(*sums)
    return totals.select("*", *[(F.col(f"total_{k}") > 0).alias(f"has_{k}") for k in kinds])


def risk_score(counts: DataFrame, host: str, kind: str, count: str, weights: list[tuple]) -> DataFrame:
    """Score per host out of a weights table (kind, per_unit, cap, flat), capped at 10.

    The counts are summed per host and kind first; a kind then adds its flat
    points once it occurs and its points per unit up to the cap. Points are
    decimals, so that rounding half to even sees exact ties. Hosts without a
    weighted kind score 0.
    """
    weighted = [(F.col(kind) == k, k) for k, *_ in weights]
    totals = counts.groupBy(host).agg(
        *[F.sum(F.when(test, F.col(count)).otherwise(0)).alias(f"_n_{k}") for test, k in weighted]
    )
    exact = "decimal(18,4)"

    def number(x) -> Column:
        return F.lit(str(x)).cast(exact)

    points = [
        F.when(
            F.col(f"_n_{k}") > 0,
            F.least(number(cap), (F.col(f"_n_{k}") * number(per_unit)).cast(exact)) + number(flat),
        )
        .otherwise(number(0))
        .cast(exact)
        for k, per_unit, cap, flat in weights
    ]
    total = reduce(lambda a, b: (a + b).cast(exact), points)
    rounded = values.half_even(F.least(number(10), total), 1).cast("double")
    return totals.select(host, rounded.alias("risk_score"))


def bulk_result_counts(df: DataFrame, status: str) -> DataFrame:
    good = F.col(status).between(200, 299)
    return df.agg(F.count_if(good).alias("ok"), F.count_if(~good).alias("failed"))


def job_summary(df: DataFrame, failed: Column, started: Column, finished: Column) -> DataFrame:
    """total, ok, failed, elapsed seconds and rate of one job."""
    out = df.agg(
        F.count("*").alias("total"),
        F.count_if(failed).alias("failed"),
        F.min(started).alias("_t0"),
        F.max(finished).alias("_t1"),
    )
    elapsed = F.timestamp_diff("SECOND", F.col("_t0"), F.col("_t1"))
    return out.select(
        "total",
        (F.col("total") - F.col("failed")).alias("ok"),
        "failed",
        elapsed.alias("elapsed"),
        F.round(F.coalesce(F.try_divide(F.col("total"), elapsed), F.lit(0.0)), 3).alias("rate"),
    )
