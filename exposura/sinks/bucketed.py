"""Tables kept in buckets of their key: upserts append, reads and compaction shuffle no stored row.

A table is partitioned by a part of its key's hash and bucketed by the key. A batch
brings its newest rows into the buckets; all versions of a key are then in one
bucket, so the newest is picked where the bucket is read. Compaction rewrites the
parts that got rows since the last one and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from exposura.operators.windows import latest_per_key
from exposura.session import scratch_path

BATCH, PART = "batch_id", "part"
BASE = -1


def _names(columns: list[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def part_of(key: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")


def create(spark: SparkSession, name: str, path: str, schema: str, key: list[str], buckets: int = 64, parts: int = 16) -> None:
    """Declares the table over a folder, new or written before; a session that lost it declares it again."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}, {BATCH} BIGINT, {PART} INT) USING parquet "
        f"OPTIONS (parts '{parts}') PARTITIONED BY ({PART}) CLUSTERED BY ({_names(key)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")


def append(df: DataFrame, name: str, key: list[str], order: list[str], batch_id: int, buckets: int = 64, parts: int = 16) -> None:
    """The batch's newest row of each key. A batch that is written twice changes nothing that is read."""
    columns = [c for c in df.sparkSession.table(name).columns if c not in (BATCH, PART)]
    newest = latest_per_key(df, key, order, columns).withColumn(BATCH, F.lit(batch_id).cast("long")).withColumn(PART, part_of(key, parts))
    newest.select(*columns, BATCH, PART).repartition(buckets, *key).write.mode("append").insertInto(name)


def latest(spark: SparkSession, name: str, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the highest order, the later batch on a tie; no exchange above the scan."""
    stored = spark.table(name)
    return latest_per_key(stored, key, [*order, BATCH], [c for c in stored.columns if c not in (BATCH, PART)])


def compact(spark: SparkSession, name: str, key: list[str], order: list[str], buckets: int = 64) -> list[int]:
    """Leaves one row per key in the parts that got batches; returns those parts.

    The new rows are written aside first and then take the place of those parts only,
    so a job that dies leaves the table as it was.
    """
    stored = spark.table(name)
    touched = sorted(r[PART] for r in stored.filter(F.col(BATCH) != BASE).select(PART).distinct().collect())
    if not touched:
        return []
    columns = [c for c in stored.columns if c not in (BATCH, PART)]
    mine = stored.filter(F.col(PART).isin(touched))
    merged = latest_per_key(mine, key, [*order, BATCH], [*columns, PART]).withColumn(BATCH, F.lit(BASE).cast("long"))
    aside = scratch_path(spark, "compacted")
    merged.select(*columns, BATCH, PART).write.parquet(aside)
    rows = spark.read.parquet(aside).repartition(buckets, *key)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    return touched
