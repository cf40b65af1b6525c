"""Filters and predicates (survey 2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from exposura import rules
from exposura.catalog import views as v
from exposura.catalog.base import like_any, q, query, sql_in, sql_list, strip, sub
from exposura.functions import lines, times
from exposura.operators import filters as f
from exposura.operators.joins import content_route as content_route_rows
from exposura.sources.readers import table

MSG = f"WITH {v.MESSAGES} "
KEY = ["channel", "message_id"]


def _kept(df, column):
    """doc_id with size and digest of a cleaned text; the text itself stays behind."""
    return df.select("doc_id", F.length(column).cast("long").alias("n_kept"), F.md5(column).alias("text_hash"))


@query("contains_literal", "SELECT doc_id FROM documents WHERE contains(text, 'License')")
def contains_literal(spark, folder):
    return table(spark, folder, "documents").filter(f.contains_literal(F.col("text"), "License")).select("doc_id")


@query("ci_search", f"""
WITH {v.THREADS} SELECT doc_id, forum FROM threads WHERE contains(lower(title), 'THEAND'.lower()) OR contains(lower(content), lower('THEAND'))""")
def ci_search(spark, folder):
    t = v.threads(spark, folder)
    return t.filter(f.ci_search([F.col("title"), F.col("content")], "THEAND")).select("doc_id", "forum")


@query("array_ci_search", f"""
WITH {v.THREADS} SELECT doc_id FROM threads WHERE len(list_filter({sql_list(v.KEYWORDS)},
  lambda k: contains(lower(title || ' ' || content), k) AND contains(k, 'licens'))) > 0""")
def array_ci_search(spark, folder):
    from exposura.operators.dedup import keyword_flagged

    t = keyword_flagged(v.threads(spark, folder), "title", "content", v.KEYWORDS)
    return t.filter(f.array_ci_search(F.col("matched_keywords"), "LICENS")).select("doc_id")


@query("regex_search", MSG + "SELECT channel, message_id FROM messages WHERE regexp_matches(message, '(?i)thea[nt]d?|\\bof the\\b')")
def regex_search(spark, folder):
    m = v.messages(spark, folder)
    return m.filter(f.regex_search(F.col("message"), r"thea[nt]d?|\bof the\b")).select(*KEY)


@query("like_search", MSG + "SELECT channel, message_id FROM messages WHERE message ILIKE '%OF THE%'")
def like_search(spark, folder):
    return v.messages(spark, folder).filter(f.like_search(F.col("message"), "OF THE")).select(*KEY)


@query("date_range", MSG + """
SELECT channel, message_id FROM messages WHERE date >= TIMESTAMP '2024-01-02' AND date < TIMESTAMP '2024-01-04'""")
def date_range(spark, folder):
    return v.messages(spark, folder).filter(times.in_days(F.col("date"), "2024-01-02", "2024-01-03")).select(*KEY)


@query("sender_filter", MSG + "SELECT channel, message_id FROM messages WHERE username ILIKE '%SIST%' OR first_name ILIKE '%SIST%'")
def sender_filter(spark, folder):
    return v.messages(spark, folder).filter(f.sender_filter("SIST")).select(*KEY)


VIDEO = "coalesce(regexp_matches(media_path, '(?i)\\.(mp4|mov|avi|mkv|webm)$'), false)"


@query("media_filter", MSG + f"""
SELECT 'photo' AS kind, channel, message_id FROM messages WHERE media_type = 'MessageMediaPhoto'
UNION ALL SELECT 'video', channel, message_id FROM messages WHERE media_type = 'MessageMediaDocument' AND {VIDEO}
UNION ALL SELECT 'doc', channel, message_id FROM messages WHERE media_type = 'MessageMediaDocument' AND NOT {VIDEO}
UNION ALL SELECT 'text', channel, message_id FROM messages WHERE media_type IS NULL AND message <> ''
UNION ALL SELECT 'any', channel, message_id FROM messages WHERE media_type <> 'MessageMediaWebPage'""")
def media_filter(spark, folder):
    m = v.messages(spark, folder)
    kinds = ["photo", "video", "doc", "text", "any"]
    hits = F.array_compact(F.array(*[F.when(f.media_filter(k), F.lit(k)) for k in kinds]))
    return m.select(*KEY, F.explode(hits).alias("kind"))


@query("min_views", MSG + "SELECT channel, message_id FROM messages WHERE views >= 50")
def min_views(spark, folder):
    return v.messages(spark, folder).filter(f.min_views(50)).select(*KEY)


@query("advanced_search", MSG + """
SELECT channel, message_id FROM messages
WHERE message ILIKE '%the%' AND regexp_matches(message, '(?i)on|an') AND date >= TIMESTAMP '2024-01-02'
  AND username ILIKE '%user%' AND media_type IS NULL AND message <> '' AND views >= 10
ORDER BY date DESC, channel, message_id LIMIT 20""")
def advanced_search(spark, folder):
    found = f.advanced_search(
        v.messages(spark, folder), text_term="the", pattern="on|an", start="2024-01-02", sender="user",
        media="text", views=10, limit=20,
    )
    return found.select(*KEY)


@query("content_route", MSG + f"""
, kinds AS (SELECT channel, message_id, message, CASE WHEN media_type IS NULL OR media_type = 'MessageMediaWebPage' THEN 'text'
    WHEN media_type = 'MessageMediaPhoto' THEN 'image' WHEN {VIDEO} THEN 'video' ELSE 'document' END AS kind FROM messages),
rules AS (SELECT * FROM (VALUES ('desk', 'text'), ('desk', 'image'), ('archive', 'document'), ('archive', 'text')) t(destination, kind))
SELECT channel, message_id, destination, kind FROM kinds JOIN rules USING (kind) WHERE kind <> 'text' OR message <> ''""")
def content_route(spark, folder):
    m = v.messages(spark, folder)
    wanted = m.filter((f.message_kind() != "text") | (F.col("message") != ""))
    return content_route_rows(wanted, forwarding_rules(spark), f.message_kind()).select(*KEY, "destination", "kind")


def forwarding_rules(spark):
    """The user's routing rules, one row per destination and kind of content."""
    rows = [("desk", "text"), ("desk", "image"), ("archive", "document"), ("archive", "text")]
    return spark.createDataFrame(rows, "destination string, kind string")


@query("missing_media", MSG + """
SELECT channel, message_id FROM messages WHERE media_type <> 'MessageMediaWebPage' AND coalesce(media_path, '') = ''""")
def missing_media(spark, folder):
    return v.messages(spark, folder).filter(f.missing_media()).select(*KEY)


@query("nested_filter", """
SELECT doc_id FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents)
GROUP BY doc_id HAVING bool_or(length(l) > 400 AND contains(l, 'the'))""")
def nested_filter(spark, folder):
    d = table(spark, folder, "documents")
    structs = F.transform(lines.split_lines(F.col("text")), lambda x: F.struct(x.alias("line"), F.length(x).alias("n")))
    hit = f.nested_filter(structs, lambda s: (s["n"] > 400) & s["line"].contains("the"))
    return d.filter(hit).select("doc_id")


@query("term", "SELECT doc_id, source FROM documents WHERE lang = 'fr'")
def term_query(spark, folder):
    return table(spark, folder, "documents").filter(f.term_query(F.col("lang"), "fr")).select("doc_id", "source")


@query("match", """
SELECT doc_id FROM documents WHERE list_has_any(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), ['license', 'lizenz', 'apache'])""")
def match_query(spark, folder):
    d = table(spark, folder, "documents")
    return d.filter(f.match_query(F.col("text"), "License lizenz APACHE")).select("doc_id")


@query("range", "SELECT o_orderkey FROM orders WHERE o_totalprice BETWEEN 100000 AND 150000")
def range_query(spark, folder):
    return table(spark, folder, "orders").filter(f.range_query(F.col("o_totalprice"), 100000, 150000)).select("o_orderkey")


@query("table_filter", """
SELECT event_id, upper(event_type) AS table_name FROM events WHERE event_type IN ('click', 'view')""")
def table_filter(spark, folder):
    e = table(spark, folder, "events").select("event_id", F.upper("event_type").alias("table_name"))
    return e.filter(f.table_filter(F.col("table_name"), ["Click", "view", "error"], ["error"]))


# --- line cleaning ------------------------------------------------------------------

S = strip("line")
BANNER = (
    f"({S} = '' OR regexp_matches({S}, {q(rules.DECORATIVE_LINE)}) OR regexp_matches({S}, '^(#|//|--|/\\*|\\*|;)')"
    f" OR {like_any(f'lower({S})', rules.BANNER_KEYWORDS + ['licensed under'])} OR regexp_matches({S}, '(?i)^https?://[^:\\t ]*$'))"
)
SYM = f"(length({S}) > 10 AND (length({S}) - length({sub(S, rules.SYMBOL_CLASS, '')})) / length({S}) > 0.8)"


def _rejoin(where: str, line: str = "line") -> str:
    return f"""
WITH {v.LINES}, kept AS (SELECT doc_id, string_agg({line}, chr(10) ORDER BY pos) AS t FROM lines WHERE {where} GROUP BY doc_id)
SELECT doc_id, length(coalesce(t, '')) AS n_kept, md5(coalesce(t, '')) AS text_hash
FROM documents LEFT JOIN kept USING (doc_id)"""


BANNER_PLAIN = BANNER.replace(" OR contains(lower(" + S + "), 'licensed under')", "")


@query("drop_banner_lines", _rejoin(f"NOT {BANNER_PLAIN}"))
def drop_banner_lines(spark, folder):
    d = table(spark, folder, "documents")
    return _kept(d.withColumn("t", lines.drop_banner_lines(F.col("text"))), "t")


@query("drop_symbol_lines", _rejoin(f"NOT (length({S}) > 10 AND (length({S}) - length({sub(S, rules.SYMBOL_CLASS, '')})) / length({S}) > 0.25)"))
def drop_symbol_lines(spark, folder):
    """A ratio of 0.25, since the prose has no line beyond the default of 0.8."""
    d = table(spark, folder, "documents")
    return _kept(d.withColumn("t", lines.drop_symbol_lines(F.col("text"), 0.25)), "t")


@query("drop_keyword_lines", _rejoin(f"{S} <> '' AND NOT {like_any(f'lower({S})', rules.SKIP_WORDS + ['licensed'])}", S))
def drop_keyword_lines(spark, folder):
    d = table(spark, folder, "documents")
    return _kept(d.withColumn("t", lines.drop_keyword_lines(F.col("text"), rules.SKIP_WORDS + ["licensed"])), "t")


@query("line_clean", _rejoin(f"NOT {BANNER_PLAIN} AND NOT {SYM}"))
def line_clean(spark, folder):
    d = table(spark, folder, "documents")
    return _kept(d.withColumn("t", lines.line_clean(F.col("text"))), "t")


SEPARATOR = r"(?i)licen[sc]e"


@query("strip_watermark", f"""
WITH {v.LINES}, sep AS (SELECT doc_id, min(pos) AS sp FROM lines WHERE regexp_matches(line, {q(SEPARATOR)}) GROUP BY doc_id),
tail AS (SELECT l.* FROM lines l JOIN sep USING (doc_id) WHERE pos > sp),
first_data AS (SELECT doc_id, min(pos) AS fp FROM tail WHERE {S} <> '' GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS t FROM tail JOIN first_data USING (doc_id)
         WHERE pos >= fp AND NOT (length({S}) > 0 AND length(regexp_replace({S}, '[\\x00-\\x7f]', '', 'g')) * 2 > length({S}))
         GROUP BY doc_id),
out AS (SELECT d.doc_id, CASE WHEN sp IS NULL THEN text ELSE coalesce(t, '') END AS t
        FROM documents d LEFT JOIN sep USING (doc_id) LEFT JOIN kept USING (doc_id))
SELECT doc_id, length(t) AS n_kept, md5(t) AS text_hash FROM out""")
def strip_watermark(spark, folder):
    """License lines stand for the separator, which the prose lacks."""
    d = table(spark, folder, "documents")
    return _kept(d.withColumn("t", lines.strip_watermark(F.col("text"), SEPARATOR)), "t")


@query("drop_header_row", f"""
WITH {v.LINES} SELECT doc_id, count(*) AS n FROM lines WHERE NOT (pos = 0 AND doc_id % 2 = 0) GROUP BY doc_id""")
def drop_header_row(spark, folder):
    from exposura.functions.text import drop_header_names

    l = v.lines_of(table(spark, folder, "documents"), "doc_id", "text")
    headed = F.when((F.col("pos") == 0) & (F.col("doc_id") % 2 == 0), F.concat(F.lit("URL,Email,"), "line")).otherwise(F.col("line"))
    return l.filter(drop_header_names(headed)).groupBy("doc_id").agg(F.count("*").alias("n"))


@query("select_channels", MSG + "SELECT channel, message_id FROM messages WHERE channel IN (1, 2, 3)")
def select_channels(spark, folder):
    return v.messages(spark, folder).filter(f.select_channels([1, 2, 3, 10**9])).select(*KEY)


@query("notable_processes", """
SELECT name, pid FROM (SELECT p_name AS name, min(p_partkey) AS pid FROM part
  WHERE p_name NOT IN ('red bolt', 'old gear') AND NOT contains(p_name, 'widget') GROUP BY p_name)""")
def notable_processes(spark, folder):
    p = table(spark, folder, "part").select(
        F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.col("p_name")).alias("name"),
        F.col("p_partkey").alias("pid"),
    )
    return f.notable_processes(p, rules.SYSTEM_PROCESSES + ["Red Bolt", "old gear"], rules.PROCESS_NOISE + ["widget"])


@query("valid_alias_key", f"""
WITH long AS (SELECT doc_id, unnest(list_concat(string_split(replace(text, chr(10), ' '), ' '), string_split(text, chr(10)),
  [CAST(doc_id AS VARCHAR), '{{' || doc_id || '}}', text])) AS k FROM documents)
SELECT doc_id, count(*) AS n_keys, count(*) FILTER (s <> '' AND length(s) <= 50 AND NOT regexp_matches(s, '^[0-9]+$')
  AND NOT regexp_matches(s, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$') AND NOT regexp_matches(s, '[\\[\\]{{}}"'']')
  AND NOT regexp_matches(s, '[\\x00-\\x08\\x0e-\\x1f]') AND NOT contains(s, '�')) AS n_valid
FROM (SELECT doc_id, {strip('k')} AS s FROM long) GROUP BY doc_id""")
def valid_alias_key(spark, folder):
    """Every word, every line, the id and the text itself as keys."""
    d = table(spark, folder, "documents")
    keys = F.concat(
        F.split("text", "[ \n]", -1), F.split("text", "\n", -1),
        F.array(F.col("doc_id").cast("string"), F.concat(F.lit("{"), "doc_id", F.lit("}")), F.col("text")),
    )
    marked = d.select("doc_id", F.explode(keys).alias("k")).select("doc_id", f.valid_alias_key(F.col("k")).alias("valid"))
    return marked.groupBy("doc_id").agg(F.count("*").alias("n_keys"), F.count_if("valid").alias("n_valid"))


LOG = """log AS (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'WARNING' ELSE 'INFO' END AS level,
  event_type || ' by ' || user_id || ' ' || props AS message FROM events)"""


def run_log(spark, folder):
    """events as log lines, read back by the log parser."""
    from exposura.sources.readers import read_run_log

    e = table(spark, folder, "events")
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "view", "WARNING").otherwise("INFO")
    message = F.concat(F.col("event_type"), F.lit(" by "), F.col("user_id"), F.lit(" "), F.col("props"))
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" ["), level, F.lit("] "), message)
    return read_run_log(e.select(line.alias("value")))


@query("log_filter", f"WITH {LOG} SELECT timestamp, level, message FROM log WHERE level = 'ERROR' AND contains(message, 'by 1')")
def log_filter(spark, folder):
    return run_log(spark, folder).filter(f.log_filter("ERROR", "BY 1"))


@query("source_type_filter", f"WITH {v.FORUMS} SELECT forum, base_url FROM forums WHERE source_type = 'onion'")
def source_type_filter(spark, folder):
    return v.forums(spark, folder).filter(f.source_type_filter("onion")).select("forum", "base_url")
