"""Streaming (survey 2.13): the events table as a stream, run until all of it is taken."""

from __future__ import annotations

from pyspark.sql import functions as F

from exposura.catalog import views as v
from exposura.catalog.base import q, query, sql_list, stamp
from exposura.catalog.q_filters import VIDEO, forwarding_rules
from exposura.operators import filters as f
from exposura.session import DEMO_PEPPER, pepper, scratch_path
from exposura.sinks import bucketed
from exposura.sources.readers import table
from exposura.streaming import jobs as s

PEPPER = q(DEMO_PEPPER)


def _paths(spark, label):
    base = scratch_path(spark, label)
    return f"{base}/out", f"{base}/checkpoint"


def _events(spark, folder):
    return s.table_stream(spark, folder, "events")


def _appended(spark, stream, label):
    out, checkpoint = _paths(spark, label)
    s.append_to(stream, out, checkpoint)
    return spark.read.parquet(out)


@query("tail_source", f"SELECT event_id, {stamp('ts')} AS ts FROM events WHERE ts >= TIMESTAMP '2024-01-20'")
def tail_source(spark, folder):
    stream = s.tail_source(_events(spark, folder), "ts", "2024-01-20").select("event_id", v.stamp("ts").alias("ts"))
    return _appended(spark, stream, "tail")


def _as_queue(spark, folder):
    """events as JSON lines in several files, the way messages arrive."""
    path = scratch_path(spark, "queue")
    table(spark, folder, "events").select("event_id", "user_id", "event_type", "props").repartition(4, "event_id").write.json(path)
    return path


QUEUE = "event_id long, user_id long, event_type string, props string"


@query("queue_source", "SELECT event_id, user_id, event_type, props FROM events")
def queue_source(spark, folder):
    return _appended(spark, s.queue_source(spark, _as_queue(spark, folder), QUEUE), "queue-out")


@query("micro_batch", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def micro_batch(spark, folder):
    """Several timed micro-batches of one file each; together they hold every row once."""
    stream = s.queue_source(spark, _as_queue(spark, folder), QUEUE, files_per_trigger=1)
    out, checkpoint = _paths(spark, "micro-out")
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    running = s.micro_batch(writer, seconds=1).start()
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


@query("dir_watch", "SELECT event_id FROM events")
def dir_watch(spark, folder):
    """Files, and later copies of them under other names, which give no rows."""
    path = _as_queue(spark, folder)
    out, checkpoint = _paths(spark, "watch-out")

    def taken():
        stream = s.dir_watch(spark, path, "*.json", files_per_trigger=2, once_within="1 hour")
        s.append_to(stream.select(F.get_json_object("line", "$.event_id").cast("long").alias("event_id")), out, checkpoint)

    taken()
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    files, conf = where.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jsc.hadoopConfiguration()
    for status in files.globStatus(hadoop.Path(where, "*.json")):
        name = status.getPath().getName()
        hadoop.FileUtil.copy(files, status.getPath(), files, hadoop.Path(where, f"copy-{name}"), False, conf)
    taken()
    return spark.read.parquet(out)


@query("ingest_stream", """
SELECT 'out' AS sink, count(*) AS n FROM events UNION ALL SELECT 'dead', count(*) FROM region""")
def ingest_stream(spark, folder):
    """A manifest of the queue's files, and as many messages without a path as there are regions."""
    files = spark.read.json(_as_queue(spark, folder), schema=QUEUE).select(F.col("_metadata.file_path").alias("file_path")).distinct()
    blanks = table(spark, folder, "region").select(F.lit(None).cast("string").alias("file_path"), F.col("r_name").alias("tag"))
    manifest = scratch_path(spark, "manifest")
    files.withColumn("tag", F.lit("file")).unionByName(blanks).write.json(manifest)
    base = scratch_path(spark, "ingest")
    stream = s.queue_source(spark, manifest, "file_path string, tag string")
    s.ingest_manifest(
        stream, "file_path", f"{base}/sink=out", f"{base}/sink=dead", f"{base}-checkpoint",
        lambda paths: spark.read.schema(QUEUE).json(paths),
    )
    out = spark.read.parquet(f"{base}/sink=out").select(F.lit("out").alias("sink"))
    dead = spark.read.parquet(f"{base}/sink=dead").select(F.lit("dead").alias("sink"))
    return out.unionByName(dead).groupBy("sink").agg(F.count("*").alias("n"))


@query("stream_normalize", f"""
SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus || CASE WHEN o_orderkey % 3 = 0 THEN ', "' || o_orderkey || '" left' ELSE '' END END AS status,
  nullif(o_orderpriority, '5-LOW') AS priority FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')""")
def stream_normalize(spark, folder):
    stream = s.table_stream(spark, folder, "orders")
    more = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(', ""'), "o_orderkey", F.lit('"" left'))).otherwise("")
    line = F.concat_ws(
        ",", F.when(F.col("o_orderstatus") == "F", " NULL").otherwise(F.concat(F.lit('"'), "o_orderstatus", more, F.lit('"'))),
        F.when(F.col("o_orderpriority") == "5-LOW", "-").otherwise(F.col("o_orderpriority")),
    )
    lines = stream.select(F.col("o_orderkey").alias("id"), line.alias("line"))
    return _appended(spark, s.stream_normalize(lines, "line", {0: "status", 1: "priority"}), "normalize")


HEADERS = {"identity": "E_Mail,Name,\"Mobile\",note", "transaction": "purchase_reference_id,Payment_Vendor,charge_amount,currency"}


def _with_header(spark, rows, key, header, label):
    """Lines of a stream whose files each begin with the header, normalised under the header probed from one file."""
    path = scratch_path(spark, label)
    lines = rows.unionByName(spark.createDataFrame([(None, header)], f"{key} long, line string"))
    lines.write.parquet(path)
    probe = scratch_path(spark, f"{label}-head")
    spark.createDataFrame([(header,)], "value string").coalesce(1).write.text(probe)
    stream = spark.readStream.schema(lines.schema).parquet(path)
    found = s.normalize_lines(stream, "line", s.probe_header(spark, probe), pepper(spark, DEMO_PEPPER))
    return _appended(spark, found, f"{label}-out")


@query("stream_normalize_identity", f"""
SELECT c_custkey, sha256({PEPPER} || lower(c_name) || CASE WHEN c_custkey % 2 = 0 THEN ', jun.' ELSE '' END) AS username_hash, sha256({PEPPER} || '+1' || c_custkey) AS phone_hash FROM customer""")
def stream_normalize_identity(spark, folder):
    phone = F.concat(F.lit("+1 ("), F.col("c_custkey").cast("string"), F.lit(")"))
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit('"'), "c_name", F.lit(', jun."'))).otherwise(F.concat(F.lit(' "'), "c_name", F.lit('"')))
    line = F.concat_ws(",", F.lit("-"), name, phone, "c_mktsegment")
    rows = table(spark, folder, "customer").select(F.col("c_custkey").cast("long").alias("c_custkey"), line.alias("line"))
    return _with_header(spark, rows, "c_custkey", HEADERS["identity"], "identity").select("c_custkey", "username_hash", "phone_hash")


@query("stream_normalize_transaction", """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS purchase_ref, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '4, NOT' ELSE nullif(o_orderpriority, '5-LOW') END AS payment_vendor,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS charge_amount FROM orders""")
def stream_normalize_transaction(spark, folder):
    priority = F.col("o_orderpriority")
    vendor = F.when(priority == "5-LOW", "N/A").when(priority == "4-NOT SPECIFIED", '"4, NOT"').otherwise(priority)
    line = F.concat_ws(",", "o_orderkey", vendor, F.col("o_totalprice").cast("decimal(18,2)"), F.lit("none"))
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").cast("long").alias("o_orderkey"), line.alias("line"))
    found = _with_header(spark, rows, "o_orderkey", HEADERS["transaction"], "transaction")
    return found.select("o_orderkey", "purchase_ref", "payment_vendor", "charge_amount")


@query("stream_normalize_dict", f"""
SELECT event_id, CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS step,
       CASE WHEN event_type = 'error' THEN sha256({PEPPER} || 'user ' || user_id) END AS username_hash,
       CASE WHEN event_type <> 'error' THEN 'transaction' ELSE 'identity' END AS mode FROM events""")
def stream_normalize_dict(spark, folder):
    named = F.concat(F.lit('{"name": " User '), F.col("user_id").cast("string"), F.lit('"}'))
    payload = F.when(F.col("event_type") == "error", named).otherwise(F.col("props"))
    stream = _events(spark, folder).select("event_id", payload.alias("payload"))
    found = s.stream_normalize_dict(stream, "payload", {"k": "step"}, pepper(spark, DEMO_PEPPER)).select("event_id", "step", "username_hash", "mode")
    return _appended(spark, found, "dict")


NEWEST = """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1"""


@query("stream_upsert", NEWEST)
def stream_upsert(spark, folder):
    """Newest row per user over several micro-batches."""
    out, checkpoint = _paths(spark, "stream-upsert")
    stream = s.queue_source(spark, _as_queue(spark, folder), QUEUE, files_per_trigger=1).drop("props")
    s.stream_upsert(stream, out, checkpoint, ["user_id"], ["event_id"])
    return s.read_latest(spark, out, ["user_id"], ["event_id"])


@query("stream_upsert_bucketed", NEWEST)
def stream_upsert_bucketed(spark, folder):
    """Newest row per user, kept in buckets of the user; compacted, and then more batches."""
    out, checkpoint = _paths(spark, "bucketed")
    name = "newest_" + out.split("-")[-1].split("/")[0]
    layout = {"buckets": 8, "parts": 4}
    bucketed.create(spark, name, out, "user_id BIGINT, event_id BIGINT, event_type STRING", ["user_id"], **layout)
    rows = table(spark, folder, "events").select("user_id", "event_id", "event_type")
    bucketed.append(rows.filter("event_id % 5 = 0"), name, ["user_id"], ["event_id"], 0, **layout)
    bucketed.compact(spark, name, ["user_id"], ["event_id"], 8)
    stream = s.queue_source(spark, _as_queue(spark, folder), QUEUE, files_per_trigger=1).drop("props")
    s.stream_upsert_bucketed(stream, name, checkpoint, ["user_id"], ["event_id"], **layout)
    return bucketed.latest(spark, name, ["user_id"], ["event_id"])


@query("retry_and_spill", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def retry_and_spill(spark, folder):
    """A stream whose first attempt fails before its batch is noted; the restart writes each row once."""
    out, checkpoint = _paths(spark, "retry")
    source = _as_queue(spark, folder)
    write = s.write_batch(out)

    def failing(batch, batch_id):
        write(batch, batch_id)
        raise RuntimeError("lost after the write")

    stream = s.queue_source(spark, source, QUEUE)
    try:
        s.run_available(stream.writeStream.foreachBatch(failing), checkpoint)
    except Exception:
        s.run_available(stream.writeStream.foreachBatch(write), checkpoint)
    return spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


@query("stream_stats", """
SELECT count(*) AS processed, count(*) FILTER (event_type <> 'error') AS uploaded, count(*) FILTER (event_type = 'error') AS failed FROM events""")
def stream_stats(spark, folder):
    out, checkpoint = _paths(spark, "stats")
    stats = s.stream_stats(_events(spark, folder), F.col("event_type") == "error", out, checkpoint)
    return stats.agg(*[F.sum(c).alias(c) for c in ("processed", "uploaded", "failed")])


@query("incremental_by_id", f"""
WITH {v.MESSAGES}, marks AS (SELECT channel, max(message_id) AS last_id FROM messages WHERE message_id < 3 AND channel < 50 GROUP BY channel)
SELECT m.channel, m.message_id FROM messages m LEFT JOIN marks USING (channel) WHERE last_id IS NULL OR message_id > last_id""")
def incremental_by_id(spark, folder):
    m = v.messages(spark, folder).select("channel", "message_id")
    seen = m.filter("message_id < 3 AND channel < 50")
    return s.incremental_by_id(m, s.high_water(seen, "channel", "message_id"), "channel", "message_id")


@query("stream_route", f"""
WITH {v.MESSAGES}, kinds AS (SELECT channel, message_id, CASE WHEN media_type IS NULL OR media_type = 'MessageMediaWebPage' THEN 'text'
    WHEN media_type = 'MessageMediaPhoto' THEN 'image' WHEN {VIDEO} THEN 'video' ELSE 'document' END AS kind FROM messages)
SELECT channel, message_id, destination, kind FROM kinds
JOIN (VALUES ('desk', 'text'), ('desk', 'image'), ('archive', 'document'), ('archive', 'text')) r(destination, kind) USING (kind)""")
def stream_route(spark, folder):
    path = scratch_path(spark, "route-in")
    m = v.messages(spark, folder).select("channel", "message_id", "media_type", "media_path")
    m.write.parquet(path)
    stream = spark.readStream.schema(m.schema).parquet(path)
    routed = s.stream_route(stream, forwarding_rules(spark), f.message_kind())
    return _appended(spark, routed.select("channel", "message_id", "destination", "kind"), "route-out")


@query("live_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def live_count(spark, folder):
    out, checkpoint = _paths(spark, "live")
    stream = s.queue_source(spark, _as_queue(spark, folder), QUEUE, files_per_trigger=1)
    s.live_count(stream, "event_type", out, checkpoint)
    return s.read_latest(spark, out, ["event_type"], ["n"])


@query("window_counts", f"""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL""")
def window_counts(spark, folder):
    """Hourly counts per kind under a watermark of ten minutes."""
    out, checkpoint = _paths(spark, "windows")
    stream = _events(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    s.window_counts(stream, "ts", "event_type", out, checkpoint)
    latest = s.read_latest(spark, out, ["window_start", "event_type"], ["n"])
    return latest.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query("stream_flag", f"""
WITH {v.THREADS}, kw AS (SELECT doc_id, len(list_filter({sql_list(v.KEYWORDS)}, lambda k: contains(lower(title || ' ' || content), k))) AS n_hits FROM threads)
SELECT doc_id, n_hits FROM kw WHERE n_hits > 0""")
def stream_flag(spark, folder):
    """The batch keyword match, unchanged, over the documents as a stream."""
    from exposura.functions import text
    from exposura.operators.dedup import keyword_flagged

    d = s.table_stream(spark, folder, "documents").select(
        "doc_id", text.first_line(F.col("text")).alias("title"), F.col("text").alias("content")
    )
    hits = keyword_flagged(d, "title", "content", v.KEYWORDS)
    return _appended(spark, hits.select("doc_id", F.size("matched_keywords").cast("long").alias("n_hits")), "flag")
