"""Windows, sorts and set operations (survey 2.7 and 2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from exposura import rules
from exposura.catalog import views as v
from exposura.catalog.base import q, query, stamp
from exposura.functions import lines
from exposura.operators import filters as f
from exposura.operators import ordering as o
from exposura.operators import windows as w
from exposura.sources.readers import table

MSG = f"WITH {v.MESSAGES} "


@query("latest_per_key", f"""
WITH {v.RUNS} SELECT forum, run_id, status, {stamp('started_at')} AS started_at FROM (
  SELECT *, row_number() OVER (PARTITION BY forum ORDER BY started_at DESC, run_id DESC) AS r FROM runs) WHERE r = 1""")
def latest_per_key(spark, folder):
    out = w.latest_per_key(
        v.runs(spark, folder), ["forum"], ["started_at", "run_id"], ["forum", "run_id", "status", "started_at"]
    )
    return out.withColumn("started_at", v.stamp("started_at"))


@query("latest_overall", f"WITH {v.RUNS} SELECT run_id, {stamp('started_at')} AS started_at FROM runs ORDER BY runs.started_at DESC, run_id DESC LIMIT 1")
def latest_overall(spark, folder):
    out = w.latest_overall(v.runs(spark, folder), ["started_at", "run_id"], ["run_id", "started_at"])
    return out.withColumn("started_at", v.stamp("started_at"))


@query("first_per_key", """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""")
def first_per_key(spark, folder):
    e = table(spark, folder, "events")
    return w.first_per_key(e, ["user_id"], ["ts", "event_id"], ["user_id", "event_id", "event_type"])


@query("best_by_score", """
SELECT user_id, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r = 1""")
def best_by_score(spark, folder):
    e = table(spark, folder, "events")
    return w.best_by_score(e, ["user_id"], "value", "event_id", ["user_id", "event_id", "value"])


@query("tail_n", """
SELECT event_id, event_type FROM (SELECT * FROM events ORDER BY event_id DESC LIMIT 500)
WHERE event_type = 'error' ORDER BY event_id DESC LIMIT 50""")
def tail_n(spark, folder):
    e = table(spark, folder, "events").select("event_id", "event_type")
    return w.tail_n(e, "event_id", F.col("event_type") == "error", 50)


@query("separator_position", f"""
WITH {v.LINES} SELECT doc_id, min(pos) FILTER (regexp_matches(line, '(?i)licen[sc]e')) + 1 AS position FROM lines GROUP BY doc_id""")
def separator_position(spark, folder):
    d = table(spark, folder, "documents")
    return d.select("doc_id", lines.separator_position(F.col("text"), "(?i)licen[sc]e").alias("position"))


@query("forward_fill_block", """
WITH m AS (SELECT user_id, event_id, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS block_id FROM events)
SELECT user_id, CAST(block_id AS BIGINT) AS block_id, count(*) AS n, min(event_id) AS first_event FROM m GROUP BY 1, 2""")
def forward_fill_block(spark, folder):
    e = table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type")
    numbered = w.block_numbers(e, "user_id", ["ts", "event_id"], F.col("event_type") == "signup")
    return numbered.groupBy("user_id", "block_id").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("text_blocks", f"""
WITH {v.LINES}, m AS (SELECT doc_id, sum(CASE WHEN pos > 0 AND regexp_matches(line, '^(The|And) ') THEN 1 ELSE 0 END)
                  OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS b FROM lines)
SELECT doc_id, CAST(max(b) AS BIGINT) + 1 AS n_blocks FROM m GROUP BY doc_id""")
def text_blocks(spark, folder):
    """The same grouping of lines where a block stays within one text: no shuffle."""
    d = table(spark, folder, "documents")
    return d.select("doc_id", F.size(lines.blocks(F.col("text"), "(?:The|And) ")).cast("long").alias("n_blocks"))


# --- sorts, limits, set operations ---------------------------------------------------

@query("order_by_name", f"WITH {v.FORUMS} SELECT forum, is_active FROM forums ORDER BY forum")
def order_by_name(spark, folder):
    return v.forums(spark, folder).select("forum", "is_active").orderBy("forum")


@query("recent_page", f"""
WITH {v.THREADS} SELECT doc_id, forum, (SELECT count(*) FROM threads) AS total FROM threads
ORDER BY crawled_at DESC, doc_id LIMIT 20 OFFSET 40""")
def recent_page(spark, folder):
    t = v.threads(spark, folder)
    page = o.recent_page(t, [F.desc("crawled_at"), F.col("doc_id")], 3, 20, ["doc_id", "forum", "crawled_at"])
    return page.drop("crawled_at")


@query("deep_page", """
SELECT l_orderkey, l_linenumber, l_extendedprice, (SELECT count(*) FROM lineitem) AS total FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 50 OFFSET (SELECT count(*) * 3 // 5 // 50 * 50 FROM lineitem)""")
def deep_page(spark, folder):
    """A page far down: three fifths of all rows lie before it."""
    l = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    page = l.count() * 3 // 5 // 50 + 1
    return o.deep_page(l, ["-l_extendedprice", "l_orderkey", "l_linenumber"], page, 50, l.columns, rows_per_range=2000)


@query("recent_sample", f"""
WITH {v.THREADS} SELECT doc_id, forum FROM threads WHERE title <> '' ORDER BY crawled_at DESC, doc_id LIMIT 5""")
def recent_sample(spark, folder):
    t = v.threads(spark, folder)
    return o.recent_sample(t, F.col("title") != "", [F.desc("crawled_at"), F.col("doc_id")]).select("doc_id", "forum")


@query("search_limit", MSG + """
SELECT channel, message_id FROM messages WHERE message ILIKE '%the%' ORDER BY date DESC, channel, message_id LIMIT 50""")
def search_limit(spark, folder):
    found = f.advanced_search(v.messages(spark, folder), text_term="the")
    return found.select("channel", "message_id")


@query("display_top10", """
SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS total FROM orders
WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def display_top10(spark, folder):
    hits = table(spark, folder, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    return o.display_top(hits, [F.desc("o_totalprice"), F.col("o_orderkey")])


@query("order_export", MSG + f"SELECT {stamp('date')} AS date, channel, message_id FROM messages ORDER BY messages.date, channel, message_id")
def order_export(spark, folder):
    m = v.messages(spark, folder).select("date", "channel", "message_id").orderBy("date", "channel", "message_id")
    return m.withColumn("date", v.stamp("date"))


@query("union_channels", MSG + "SELECT channel, message_id, username FROM messages WHERE channel IN (1, 2, 5)")
def union_channels(spark, folder):
    m = v.messages(spark, folder).select("channel", "message_id", "username")
    return o.union_channels(m, "channel", [1, 2, 5])


@query("query_batch_and_live", """
SELECT event_id, user_id, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN true END AS stream_mode FROM events""")
def query_batch_and_live(spark, folder):
    e = table(spark, folder, "events")
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    batch = e.filter(F.col("ts") < split).select("event_id", "user_id")
    live = e.filter(F.col("ts") >= split).select("event_id", "user_id", F.lit(True).alias("stream_mode"))
    return o.union_tables(batch, live)


@query("set_difference", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def set_difference(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", "source")
    return o.set_difference(d, table(spark, folder, "labels"), ["doc_id"])


@query("merge_dicts", "SELECT n_nationkey % 13 AS k, CASE WHEN max(n_nationkey) < 13 THEN 'old' ELSE 'new' END || lpad(CAST(max(n_nationkey) AS VARCHAR), 3, '0') AS value FROM nation GROUP BY 1")
def merge_dicts(spark, folder):
    """Thirteen old entries and twelve that override all but one of them."""
    from exposura.operators.dedup import upsert

    tagged = table(spark, folder, "nation").select(
        (F.col("n_nationkey") % 13).alias("k"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("s"), "n_nationkey"
    )
    old = tagged.filter("n_nationkey < 13").select("k", F.concat(F.lit("old"), "s").alias("value"), F.lit(0).alias("v"))
    new = tagged.filter("n_nationkey >= 13").select("k", F.concat(F.lit("new"), "s").alias("value"), F.lit(0).alias("v"))
    return upsert(old, new, ["k"], ["v"]).select("k", "value")
