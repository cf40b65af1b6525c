"""Per-key picks and running groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from exposura.functions import text


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """The row with the highest order of every key.

    An aggregate rather than a ranked window: every task keeps one candidate
    per key before the shuffle, so a hot key costs no more than a cold one.
    """
    return _pick(df, keys, order, cols, F.max_by)


def first_per_key(df: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """The row with the lowest order of every key."""
    return _pick(df, keys, order, cols, F.min_by)


def _pick(df, keys, order, cols, chooser) -> DataFrame:
    rest = [c for c in cols if c not in keys]
    picked = df.groupBy(*keys).agg(chooser(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def latest_overall(df: DataFrame, order: list[str], cols: list[str]) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).select(*cols).limit(1)


def best_by_score(df: DataFrame, keys: list[str], score: str, ordinal: str, cols: list[str]) -> DataFrame:
    """Highest score per key; ties keep the lowest ordinal."""
    ranked = df.withColumn("_neg", -F.col(score))
    return first_per_key(ranked, keys, ["_neg", ordinal], cols)


def tail_n(df: DataFrame, order: str, keep: Column, n: int = 100, last: int = 500) -> DataFrame:
    """The last n of those among the last rows that pass the filter."""
    recent = df.orderBy(F.desc(order)).limit(last)
    return recent.filter(keep).orderBy(F.desc(order)).limit(n)


def range_borders(df: DataFrame, columns: list[str], ranges: int, seed: int = 7) -> list[str]:
    """Up to ranges - 1 borders, as JSON, that cut the rows into ranges of similar size.

    Drawn from a sample of about fifty rows per range; only its keys reach the driver.
    """
    rows = df.count()
    if ranges < 2 or not rows:
        return []
    drawn = df.select(*columns).sample(min(1.0, 50 * ranges / rows), seed).orderBy(*columns).limit(200 * ranges)
    keys = [r[0] for r in drawn.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})).collect()]
    return list(dict.fromkeys(keys[len(keys) * k // ranges] for k in range(1, ranges) if keys))


def range_number(df: DataFrame, columns: list[str], borders: list[str]) -> Column:
    """How many borders a row has reached, by halving; the borders are one sorted literal of the plan."""
    if not borders:
        return F.lit(0)
    fields = ", ".join(f"`{c}`: {df.schema[c].dataType.simpleString()}" for c in columns)
    # sort_array, unlike array_sort, which takes a function, is computed once for the plan and not at every step of every row
    known = F.sort_array(F.from_json(F.lit("[" + ",".join(borders) + "]"), f"array<struct<{fields}>>"))
    steps = F.array(*[F.lit(1 << k) for k in range(len(borders).bit_length() - 1, -1, -1)])

    def reached(kind: Column) -> Column:
        def halve(at: Column, step: Column) -> Column:
            there = at + step
            return F.when((there <= len(borders)) & (F.get(known, there - 1) <= kind), there).otherwise(at)

        return F.aggregate(steps, F.lit(0), halve)

    return text.bind(F.struct(*columns), reached)


def block_numbers(
    df: DataFrame, key: str, order: list[str], start: Column, out: str = "block_id", rows_per_range: int = 2_000_000,
) -> DataFrame:
    """Rows numbered by block, a block running from one start row of its key to the next.

    Rows before the first start get 0. The running count is taken in two steps, so
    that no task holds a whole key: the rows fall into ranges of (key, order), which
    are of similar size however hot a key is and whose number follows the rows' own,
    are counted within their range, and raised by what the earlier ranges of the key
    hold. The ranges' borders are literals, so both steps see the same ranges without
    writing a row; the first step moves one sum per key and range.
    """
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placing = df.select(key, *order)
    ranges = max(least, -(-placing.count() // rows_per_range))
    borders = range_borders(placing, [key, *order], ranges)
    ranged = df.withColumn("_start", F.coalesce(start, F.lit(False)).cast("int")).withColumn("_range", range_number(df, [key, *order], borders))

    totals = ranged.groupBy(key, "_range").agg(F.sum("_start").alias("_sum"))
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(key).alias("_key"), F.col("_range").alias("_of"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(key, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_local", F.sum("_start").over(inside))
    return (
        local.join(offsets, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_of")))
        .withColumn(out, (F.col("_local") + F.col("_offset")).cast("long"))
        .drop("_start", "_range", "_local", "_offset", "_key", "_of")
    )
