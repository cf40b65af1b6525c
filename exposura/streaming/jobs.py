"""Streaming sources, jobs and sinks over the same column functions as the batch side.

Progress lives in the checkpoint and every sink is idempotent per micro-batch,
so a lost executor or a restarted driver replays a batch without doubling rows.
"""

from __future__ import annotations

import csv
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from exposura import rules
from exposura.functions import sensitive, text, values
from exposura.operators import projections
from exposura.operators.joins import content_route
from exposura.operators.windows import latest_per_key
from exposura.sinks import bucketed

PRIVATE_TARGETS = ["address", "birthdate", "facebook_generated_email", "url"]


# --- sources ------------------------------------------------------------------

def table_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table as a stream; the glob lets it be one file or a directory."""
    path = f"{folder}/{name}.parque[t]"
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def tail_source(stream: DataFrame, ts: str, start: str) -> DataFrame:
    """Only what happened from the start on; history is skipped."""
    return stream.filter(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))


def queue_source(spark: SparkSession, path: str, schema, files_per_trigger: int = 100) -> DataFrame:
    """One JSON record per line of the files that arrive; the checkpoint stands for the ack."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)
    )


def kafka_source(spark: SparkSession, servers: str, topic: str, schema) -> DataFrame:
    """The same records from a Kafka topic, newest first start; needs the Kafka connector."""
    raw = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", "latest").load()
    )
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")


def dir_watch(
    spark: SparkSession, path: str, pattern: str = "*", files_per_trigger: int = 100, once_within: str | None = None,
) -> DataFrame:
    """(file, line) of files once they appear under their final name; each file is taken once.

    Writers move a finished file into the folder, which takes the place of
    polling for a stable size. With `once_within`, a time such as "7 days", a file
    whose content was seen under another name within that time gives no row: the
    stream keeps the digests it has met, by the time it met them, and forgets older
    ones. Files are then read whole, one to a row.
    """
    reader = spark.readStream.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger)
    if once_within is None:
        return reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    files = reader.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile").load(path).select(
        F.col("path").alias("file"), F.sha2("content", 256).alias("_digest"), F.current_timestamp().alias("_met"), "content")
    first = files.withWatermark("_met", once_within).dropDuplicatesWithinWatermark(["_digest"])
    ended = F.regexp_replace(F.col("content").cast("string"), "\n$", "")
    return first.select("file", F.explode(F.split(ended, "\n", -1)).alias("line"))


# --- running ------------------------------------------------------------------

def micro_batch(writer, seconds: int = 2):
    """Flush on elapsed time; the size bound is the source's files per trigger."""
    return writer.trigger(processingTime=f"{seconds} seconds")


def run_available(writer, checkpoint: str):
    """Take all there is, then stop; fails if the query failed."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_to(stream: DataFrame, path: str, checkpoint: str):
    return run_available(stream.writeStream.format("parquet").option("path", path), checkpoint)


# --- sinks --------------------------------------------------------------------

def write_batch(path: str, prepare: Callable[[DataFrame], DataFrame] | None = None):
    """foreachBatch sink: one directory per batch, overwritten when the batch is replayed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = prepare(batch) if prepare else batch
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def stream_upsert(stream: DataFrame, path: str, checkpoint: str, key: list[str], order: list[str]):
    """Newest row per key, merged on read.

    A micro-batch appends only its own newest rows, so its cost follows the batch
    and not the table; read_latest picks the newest across batches.
    """
    cols = stream.columns
    sink = write_batch(path, lambda b: latest_per_key(b, key, order, cols))
    return run_available(stream.writeStream.foreachBatch(sink), checkpoint)


def read_latest(spark: SparkSession, path: str, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the highest order, the later batch on a tie."""
    log = spark.read.parquet(path)
    cols = [c for c in log.columns if c != "batch_id"]
    return latest_per_key(log, key, [*order, "batch_id"], cols)


def stream_upsert_bucketed(stream: DataFrame, name: str, checkpoint: str, key: list[str], order: list[str], **layout):
    """As `stream_upsert`, into a table in buckets of the key (`sinks.bucketed`): neither a
    read nor a compaction shuffles what is stored."""
    def write(batch: DataFrame, batch_id: int) -> None:
        bucketed.append(batch, name, key, order, batch_id, **layout)

    return run_available(stream.writeStream.foreachBatch(write), checkpoint)


def compact(spark: SparkSession, path: str, target: str, key: list[str], order: list[str]) -> None:
    """Writes the merged table to a new path; the log below it can then be dropped."""
    read_latest(spark, path, key, order).write.mode("errorifexists").parquet(target)


# --- jobs ---------------------------------------------------------------------

def guarded(df: DataFrame, names: list[str], pepper: str | None) -> DataFrame:
    """Mapped identity columns as keyed hashes and kinds; names, addresses and birth dates go."""
    out = []
    for c in df.columns:
        value = F.col(f"`{c}`")
        if c not in names or c not in rules.IDENTITY_TARGETS + PRIVATE_TARGETS:
            out.append(value)
        elif c == "password":
            out.append(sensitive.secret_kind(value).alias("secret_kind"))
        elif c in projections.IDENTITY_PILLARS:
            if pepper is None:
                raise ValueError(f"{c} needs a pepper")
            out.append(sensitive.keyed_hash(text.blank_to_null(value), pepper).alias(f"{c}_hash"))
    return df.select(*out)


def stream_normalize(
    stream: DataFrame, line: str, column_map: dict[int, str], delim: str = ",", pepper: str | None = None
) -> DataFrame:
    """Delimited lines to named columns by ordinal, placeholders to NULL; empty rows go.

    Quoted fields may hold the delimiter. Identity columns leave as keyed hashes and
    kinds only.
    """
    parts = text.quoted_fields(F.col(line), delim)
    named = [
        text.null_token(text.clean_header(F.get(parts, F.lit(i)))).alias(n) for i, n in sorted(column_map.items())
    ]
    rest = [c for c in stream.columns if c != line]
    out = stream.select(*rest, *named)
    kept = out.filter(F.coalesce(*[F.col(n) for n in column_map.values()]).isNotNull())
    return guarded(kept, list(column_map.values()), pepper)


def probe_header(spark: SparkSession, path: str) -> str:
    """First line of a file; one row reaches the driver."""
    row = spark.read.text(path).first()
    return row["value"] if row else ""


def header_columns(header: str, delim: str = ",") -> list[str]:
    """Lower-cased names of a header line, quotes taken off; a quoted name may hold the delimiter."""
    return [h.strip().strip("\"'").lower() for h in next(csv.reader([header], delimiter=delim), [])]


def header_mode(columns: list[str]) -> str:
    """"transaction" where a column only transactions have is present, else "identity"."""
    return "transaction" if set(columns) & set(rules.TRANSACTION_TRIGGERS) else "identity"


def normalize_lines(
    lines: DataFrame, line: str, header: str, pepper: str, delim: str = ","
) -> DataFrame:
    """Delimited lines under a probed header, by the mode that the header tells; stream or batch.

    Both modes go through the batch functions: transaction fields under canonical
    names, identities as keyed hashes. Of repeated names the last column counts;
    repeated header lines and rows without any field go. Quoted fields may hold the
    delimiter.
    """
    columns = header_columns(header, delim)
    at = {name: i for i, name in enumerate(columns) if name}
    parts = text.quoted_fields(F.col(line), delim)
    rest = [c for c in lines.columns if c != line]
    data = lines.filter(text.strip(F.col(line)) != header.strip())

    def field(name: str) -> Column:
        return text.null_token(text.clean_header(F.get(parts, F.lit(at[name]))))

    if header_mode(columns) == "transaction":
        used = [c for c in rules.TRANSACTION_COLUMNS if c in at]
        named = data.select(*[F.col(c).alias(f"_{c}") for c in rest], *[field(c).alias(c) for c in used])
        out = projections.normalize_transaction(named)
        fields = [c for c in out.columns if not c.startswith("_")]
        out = projections.require_transaction_field(out, fields)
    else:
        named = {p: [field(a) for a in aliases if a in at] for p, aliases in rules.PILLAR_ALIASES.items()}
        named = {p: F.coalesce(*found) for p, found in named.items() if found}
        if not named:
            raise ValueError("the header names no identity column")
        pillars = data.select(*[F.col(c).alias(f"_{c}") for c in rest], *[c.alias(p) for p, c in named.items()])
        out = projections.require_pillar(projections.normalize_identity(pillars, pepper))
    kept = {f"_{c}": c for c in rest}
    return out.select(*[F.col(c).alias(kept.get(c, c)) for c in out.columns])


def stream_normalize_dict(
    stream: DataFrame, payload: str, fields: dict[str, str], pepper: str,
    embedded: dict[str, dict[str, str]] | None = None,
) -> DataFrame:
    """JSON payload to columns, stream or batch: transaction fields first, else identities.

    `embedded` names fields that hold JSON as text, each with its own fields. Where
    no transaction field is found, the identities of the payload follow as keyed
    hashes; payloads with neither go.
    """
    found = [(target, values.json_get(F.col(payload), source)) for source, target in fields.items()]
    for outer, inner in (embedded or {}).items():
        found += [(t, values.json_get(values.json_get(F.col(payload), outer), s)) for s, t in inner.items()]
    by_target: dict[str, list[Column]] = {}
    for target, value in found:
        by_target.setdefault(target, []).append(text.null_token(value))
    rest = [c for c in stream.columns if c != payload]
    has = F.coalesce(*[F.col(t) for t in by_target]).isNotNull()
    pillars = {
        p: F.coalesce(*[text.null_token(values.json_get(F.col(payload), a)) for a in aliases])
        for p, aliases in rules.PILLAR_ALIASES.items()
    }
    read = stream.select(*rest, *[values.last_non_empty(*c).alias(t) for t, c in by_target.items()],
                         *[c.alias(f"_{p}") for p, c in pillars.items()])
    norm = {"email": text.norm_email, "phone": text.norm_phone}
    hashed = [
        F.when(~has, sensitive.keyed_hash(norm.get(p, text.strip)(F.col(f"_{p}")), pepper)).alias(f"{p}_hash") for p in pillars
    ]
    mode = F.when(has, "transaction").otherwise("identity").alias("mode")
    known = has | F.coalesce(*[F.col(f"_{p}") for p in pillars]).isNotNull()
    return read.filter(known).select(*rest, *by_target, *hashed, mode)


def stream_route(stream: DataFrame, rules_df: DataFrame, kind: Column) -> DataFrame:
    """The batch routing, unchanged, over a stream and a static rule table."""
    return content_route(stream, rules_df, kind)


def live_count(stream: DataFrame, key: str, path: str, checkpoint: str):
    """Running counts; each batch writes the counts that changed."""
    counts = stream.groupBy(key).agg(F.count("*").alias("n"))
    writer = counts.writeStream.outputMode("update").foreachBatch(write_batch(path))
    return run_available(writer, checkpoint)


def window_counts(
    stream: DataFrame, ts: str, key: str, path: str, checkpoint: str,
    lateness: str = "10 minutes", width: str = "1 hour",
):
    """Counts per window and key under a watermark; a changed window is written again."""
    counts = (
        stream.withWatermark(ts, lateness)
        .groupBy(F.window(ts, width).alias("w"), key)
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), key, "n")
    )
    writer = counts.writeStream.outputMode("update").foreachBatch(write_batch(path))
    return run_available(writer, checkpoint)


def ingest_manifest(
    stream: DataFrame, path_col: str, out: str, dead: str, checkpoint: str,
    read: Callable[[list[str]], DataFrame], group: int = 10_000,
):
    """Messages name files; each batch reads its files and writes them under its number.

    Messages without a path go to the dead-letter table. A batch's paths are dealt
    into groups of about `group` by their hash, read and written group after group,
    so that no more than a group's paths reach the driver at a time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        missing = F.col(path_col).isNull() | (F.col(path_col) == "")
        batch.filter(missing).write.mode("overwrite").parquet(f"{dead}/batch_id={batch_id}")
        named = batch.filter(~missing).select(path_col).distinct()
        groups = -(-named.count() // group)
        for k in range(groups):
            mine = named.filter(F.pmod(F.xxhash64(path_col), F.lit(groups)) == k)
            paths = [r[0] for r in mine.collect()]
            if paths:
                read(paths).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}/part={k}")

    return run_available(stream.writeStream.foreachBatch(write), checkpoint)


def stream_stats(stream: DataFrame, failed: Column, path: str, checkpoint: str) -> DataFrame:
    """(batch_id, processed, uploaded, failed) of every micro-batch, counted by the cluster."""

    def write(batch: DataFrame, batch_id: int) -> None:
        stats = batch.agg(F.count("*").alias("processed"), F.count_if(failed).alias("failed"))
        stats.withColumn("uploaded", F.col("processed") - F.col("failed")).write.mode(
            "overwrite"
        ).parquet(f"{path}/batch_id={batch_id}")

    run_available(stream.writeStream.foreachBatch(write), checkpoint)
    return stream.sparkSession.read.parquet(path)


def incremental_by_id(df: DataFrame, marks: DataFrame, key: str, order: str) -> DataFrame:
    """Rows above the high-water mark of their key; keys without a mark give all."""
    joined = df.join(marks.select(key, F.col("last_id").alias("_last")), key, "left")
    return joined.filter(F.col("_last").isNull() | (F.col(order) > F.col("_last"))).drop("_last")


def high_water(df: DataFrame, key: str, order: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(order).alias("last_id"))
