"""Sinks (survey 2.2): a write to the shared folder, then a plain read of what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from exposura import rules
from exposura.catalog import views as v
from exposura.catalog.base import q, query, sql_redacted, stamp
from exposura.operators.aggregates import job_summary as summarise
from exposura.operators.dedup import upsert
from exposura.operators.projections import MESSAGE_COLUMNS
from exposura.plans.jobs import redact
from exposura.session import scratch_path
from exposura.sinks import writers as w
from exposura.sources.readers import table


@query("write_index", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY event_type")
def write_index(spark, folder):
    path = scratch_path(spark, "index")
    w.write_index(table(spark, folder, "events").select("event_id", "event_type"), path, partition_by=["event_type"])
    return spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("upsert_index", """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def upsert_index(spark, folder):
    e = table(spark, folder, "events").select("user_id", "event_id", "event_type", "ts")
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    path = scratch_path(spark, "upsert")
    w.upsert_index(e.filter(F.col("ts") >= split), e.filter(F.col("ts") < split), path, ["user_id"], ["ts", "event_id"])
    return spark.read.parquet(path).drop("ts")


ROUTES = {"Click": "web", "view": "", "purchase": "orders"}
ROUTE_SQL = "CASE event_type WHEN 'click' THEN 'web' WHEN 'purchase' THEN 'orders' ELSE 'main' END"


@query("route_by_table", f"SELECT {ROUTE_SQL} AS route, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def route_by_table(spark, folder):
    path = scratch_path(spark, "routes")
    e = table(spark, folder, "events").select("event_id", F.upper("event_type").alias("source_table"))
    routes = {k.lower(): t for k, t in ROUTES.items()}
    w.write_routed(w.route_by_table(e, "source_table", routes), path)
    return spark.read.parquet(path).groupBy("route").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("patch_status", """
SELECT c_custkey, CASE WHEN n.n_name IS NOT NULL THEN 'processed' ELSE 'pending' END AS status,
       CASE WHEN n.n_name IS NOT NULL THEN 'later' ELSE 'before' END AS status_time
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 10) n ON c_nationkey = n_nationkey""")
def patch_status(spark, folder):
    c = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("k"), F.lit("pending").alias("status"), F.lit("before").alias("status_time")
    )
    updates = table(spark, folder, "nation").filter("n_nationkey < 10").select(
        F.col("n_nationkey").alias("k"), F.lit("processed").alias("new_status"), F.lit("later").alias("new_time")
    )
    return w.patch_status(c, updates, "k").drop("k")


@query("mark_reviewed", f"""
WITH {v.THREADS}, {v.FLAGGED} SELECT f.doc_id, f.reviewed OR coalesce(l.toxic = 1, false) AS reviewed
FROM flagged f JOIN labels l USING (doc_id)""")
def mark_reviewed(spark, folder):
    ids = table(spark, folder, "labels").filter("toxic = 1")
    return w.mark_reviewed(v.flagged(spark, folder).select("doc_id", "reviewed"), ids, "doc_id")


@query("toggle_active", f"""
WITH {v.FORUMS} SELECT forum, is_active OR regexp_matches(base_url, 'src2\\d\\.') AS is_active FROM forums""")
def toggle_active(spark, folder):
    return w.toggle_active(v.forums(spark, folder), "base_url", r"src2\d\.").select("forum", "is_active")


EXPORT = f"""
WITH {v.MESSAGES} SELECT message_id, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, first_name, username,
  md5({sql_redacted("message")}) AS message_hash, media_type, media_path, views, channel FROM messages"""
EXPORTED = (
    "message_id long, date string, sender_id long, first_name string, last_name string, username string, message string, "
    "media_type string, media_path string, reply_to long, post_author string, views long, forwards long, reactions string, channel long"
)
EXPORT_ORDER = ["date", "channel", "message_id"]


def _export(spark, folder):
    """All fourteen columns and the channel, the text redacted."""
    m = redact(v.messages(spark, folder), "message")
    return m.select(*MESSAGE_COLUMNS, "channel").withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))


def _exported(rows):
    return rows.select(
        "message_id", "date", "first_name", "username", F.md5("message").alias("message_hash"), "media_type", "media_path",
        "views", "channel",
    )


@query("export_csv", EXPORT)
def export_csv(spark, folder):
    path = scratch_path(spark, "export-csv")
    w.export_csv(_export(spark, folder), path, EXPORT_ORDER)
    reader = spark.read.schema(EXPORTED).option("header", True).option("escape", '"').option("multiLine", True)
    return _exported(reader.csv(path))


@query("export_json", EXPORT)
def export_json(spark, folder):
    path = scratch_path(spark, "export-json")
    w.export_json(_export(spark, folder), path, EXPORT_ORDER)
    return _exported(spark.read.schema(EXPORTED).json(path))


@query("write_jsonl", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def write_jsonl(spark, folder):
    path = scratch_path(spark, "write-jsonl")
    w.write_jsonl(table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    return spark.read.schema("c_custkey long, c_name string, c_mktsegment string").json(path)


@query("write_rejects", f"""
WITH {v.LINES} SELECT CAST(pos AS BIGINT) + 1 AS line_number, CASE WHEN line = '' THEN 'empty' ELSE 'too_long' END AS reason,
       length(line) AS line_length, count(*) AS n FROM lines WHERE line = '' OR length(line) > 1000 GROUP BY ALL""")
def write_rejects(spark, folder):
    lines = v.lines_of(table(spark, folder, "documents"), "doc_id", "text").withColumn(
        "line_number", F.col("pos").cast("long") + 1
    )
    reason = F.when(F.col("line") == "", "empty").when(F.length("line") > 1000, "too_long")
    path = scratch_path(spark, "rejects")
    w.reject_rows(lines, "line_number", F.col("line"), reason).write.json(path)
    back = spark.read.schema("line_number long, reason string, line_length long").json(path)
    return back.groupBy("line_number", "reason", "line_length").agg(F.count("*").alias("n"))


@query("job_summary", f"""
WITH {v.RUNS}, s AS (SELECT count(*) AS total, count(*) FILTER (status = 'failed') AS failed,
  (epoch_us(max(finished_at)) - epoch_us(min(started_at))) // 1000000 AS elapsed FROM runs)
SELECT total, total - failed AS ok, failed, elapsed, round(total / CAST(elapsed AS DOUBLE), 3) AS rate FROM s""")
def job_summary(spark, folder):
    return summarise(v.runs(spark, folder), F.col("status") == "failed", F.col("started_at"), F.col("finished_at"))


@query("write_dead_letter", """
SELECT 'dead' AS part, count(*) AS n FROM events WHERE event_type = 'error'
UNION ALL SELECT 'good', count(*) FROM events WHERE event_type <> 'error'""")
def write_dead_letter(spark, folder):
    e = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.concat(F.lit("in/"), "event_id")).alias("file_path")
    )
    base = scratch_path(spark, "dead-letter")
    for part, rows in zip(("good", "dead"), w.split_dead_letters(e, "file_path")):
        rows.write.parquet(f"{base}/part={part}")
    return spark.read.parquet(base).groupBy("part").agg(F.count("*").alias("n"))
