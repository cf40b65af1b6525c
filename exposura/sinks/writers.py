"""Writers. All are plain Spark writes, restarted task by task on loss of an executor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from exposura import rules
from exposura.sources.readers import channel_bucket


def write_index(
    df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None, failed: Column | None = None
) -> dict:
    """Rows to a parquet table; returns the number written, observed on the way.

    Rows for which `failed` holds, if it is given, are counted too and not written.
    """
    seen = Observation()
    if failed is None:
        counted = df.observe(seen, F.count(F.lit(1)).alias("written"))
    else:
        marked = df.withColumn("_failed", F.coalesce(failed, F.lit(False)))
        numbers = F.count_if(~F.col("_failed")).alias("written"), F.count_if("_failed").alias("failed")
        counted = marked.observe(seen, *numbers).filter(~F.col("_failed")).drop("_failed")
    if partition_by:
        _balanced(counted, partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        counted.write.mode(mode).parquet(path)
    return seen.get


def _balanced(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of one output partition side by side, in pieces of the advisory size.

    A rebalance rather than a repartition: a hot partition is split over tasks
    and small ones share a task, so that neither one huge nor countless tiny files
    are written.
    """
    return df.hint("rebalance", *columns)


def upsert_index(df: DataFrame, base: DataFrame, path: str, key: list[str], order: list[str]) -> None:
    """New version of a table at a new path: same key overwrites, newest wins."""
    from exposura.operators.dedup import upsert

    upsert(base, df, key, order).write.mode("errorifexists").parquet(path)


def route_by_table(df: DataFrame, column: str, routes: dict[str, str] = rules.TABLE_ROUTES) -> DataFrame:
    """Adds the route of the row's table; "" and unlisted tables go to main."""
    low = F.lower(F.col(column))
    route = F.lit("main")
    for name, target in reversed(routes.items()):
        route = F.when(low == name, target or "main").otherwise(route)
    return df.withColumn("route", route)


def write_routed(df: DataFrame, path: str) -> None:
    _balanced(df, ["route"]).write.mode("append").partitionBy("route").parquet(path)


def write_messages(df: DataFrame, path: str) -> None:
    """Message store in a fixed number of buckets by channel, sorted by channel within a file.

    Channels grow with the data, so each is no directory of its own; a read of a
    few channels prunes buckets, then row groups.
    """
    bucketed = df.withColumn("bucket", channel_bucket(F.col("channel")))
    placed = _balanced(bucketed, ["bucket"]).sortWithinPartitions("bucket", "channel")
    placed.write.mode("append").partitionBy("bucket").parquet(path)


def patch_status(df: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """updates(key, new_status, new_time), the newest of a key counts; rows without one keep their own."""
    newest = updates.groupBy(key).agg(F.max(F.struct("new_time", "new_status")).alias("_u"))
    newest = newest.select(key, "_u.new_status", "_u.new_time")
    joined = df.join(newest, key, "left")
    return joined.select(
        *[c for c in df.columns if c not in ("status", "status_time")],
        F.coalesce("new_status", "status").alias("status"),
        F.coalesce("new_time", "status_time").alias("status_time"),
    )


def mark_reviewed(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    marked = df.join(ids.select(key).distinct().withColumn("_hit", F.lit(True)), key, "left")
    return marked.withColumn("reviewed", F.coalesce("_hit", "reviewed")).drop("_hit")


def toggle_active(df: DataFrame, column: str, pattern: str, active: bool = True) -> DataFrame:
    return df.withColumn(
        "is_active", F.when(F.col(column).rlike(pattern), F.lit(active)).otherwise(F.col("is_active"))
    )


def export_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """Files in range order of the sort columns: part-00000 holds the earliest rows.

    Blanks at either end of a value are kept; an empty value reads back as NULL.
    """
    writer = df.orderBy(*order).write.mode("errorifexists").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def export_json(df: DataFrame, path: str, order: list[str]) -> None:
    df.orderBy(*order).write.mode("errorifexists").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line; NULL fields are left out."""
    df.write.mode("append").json(path)


def reject_rows(df: DataFrame, line_number: str, line: str, reason: Column) -> DataFrame:
    """(line_number, reason, line_length) of rejected rows; the line itself is not kept."""
    return df.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(
        line_number, "reason", F.length(line).alias("line_length")
    )


def split_dead_letters(df: DataFrame, required: str) -> tuple[DataFrame, DataFrame]:
    """(good, dead): messages lacking the required field go to the second."""
    missing = F.col(required).isNull() | (F.col(required) == "")
    return df.filter(~missing), df.filter(missing)
