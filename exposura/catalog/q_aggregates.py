"""Aggregations (survey 2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from exposura import rules
from exposura.catalog import views as v
from exposura.catalog.base import q, query, sql_in, sql_redacted, stamp
from exposura.functions import text
from exposura.functions.sensitive import redact
from exposura.operators import aggregates as a
from exposura.plans import jobs
from exposura.sources.readers import table

MSG = f"WITH {v.MESSAGES} "


@query("overall_stats", f"""
WITH {v.THREADS}, {v.FORUMS}, {v.FLAGGED}, {v.RUNS}
SELECT (SELECT count(*) FROM threads) AS total_threads, (SELECT count(*) FROM forums WHERE is_active) AS active_forums,
       (SELECT count(*) FROM flagged) AS total_flagged, (SELECT count(*) FROM flagged WHERE NOT reviewed) AS unreviewed,
       (SELECT {stamp('max(started_at)')} FROM runs) AS last_run, (SELECT bool_or(status = 'running') FROM runs) AS any_running""")
def overall_stats(spark, folder):
    out = a.overall_stats(
        v.threads(spark, folder), v.forums(spark, folder), v.flagged(spark, folder), v.runs(spark, folder)
    )
    return out.withColumn("last_run", v.stamp("last_run"))


@query("count_if", "SELECT source, count(*) FILTER (n_chars > 2000) AS n_long, count(*) AS n FROM documents GROUP BY source")
def count_if(spark, folder):
    d = table(spark, folder, "documents")
    return d.groupBy("source").agg(a.count_where(F.col("n_chars") > 2000).alias("n_long"), F.count("*").alias("n"))


@query("messages_span", MSG + f"SELECT {stamp('min(date)')} AS first_date, {stamp('max(date)')} AS last_date, count(*) AS n FROM messages")
def messages_span(spark, folder):
    out = a.messages_span(v.messages(spark, folder))
    return out.select(v.stamp("first_date").alias("first_date"), v.stamp("last_date").alias("last_date"), "n")


@query("messages_per_channel", MSG + "SELECT channel, count(*) AS n FROM messages GROUP BY channel")
def messages_per_channel(spark, folder):
    return v.messages(spark, folder).groupBy("channel").agg(F.count("*").alias("n"))


@query("media_coverage", MSG + """
SELECT count(*) FILTER (media_type <> 'MessageMediaWebPage') AS media_total,
       count(*) FILTER (media_type <> 'MessageMediaWebPage' AND media_path IS NOT NULL) AS media_with_path FROM messages""")
def media_coverage(spark, folder):
    return a.media_coverage(v.messages(spark, folder))


@query("dir_rollup", f"""
WITH {v.PAGE_FILES} SELECT parent_path, count(*) AS child_count,
  CAST(sum(CASE WHEN is_directory THEN 0 ELSE file_size_bytes END) AS BIGINT) AS total_size FROM page_files GROUP BY parent_path""")
def dir_rollup(spark, folder):
    return a.dir_rollup(v.page_files(spark, folder))


@query("catalog_totals", f"WITH {v.PAGE_FILES} SELECT is_directory, count(*) AS n FROM page_files GROUP BY is_directory")
def catalog_totals(spark, folder):
    return a.catalog_totals(v.page_files(spark, folder))


@query("file_type_summary", f"""
SELECT count(*) AS file_count, count(*) FILTER (ext IN {sql_in(rules.SCREENSHOT_SUFFIXES)}) AS image_count,
       array_to_string(list_sort(list_distinct(list(ext) FILTER (ext IN {sql_in(rules.TRACKED_SUFFIXES)}))), ',') AS file_types
FROM (SELECT (['.txt', '.png', '.pdf', '.exe', '.gif', '.csv'])[p_size % 6 + 1] AS ext FROM part)""")
def file_type_summary(spark, folder):
    exts = F.array(*[F.lit(e) for e in [".txt", ".png", ".pdf", ".exe", ".gif", ".csv"]])
    c = table(spark, folder, "part").select(
        F.get(exts, F.col("p_size") % 6).alias("extension"), F.lit(False).alias("is_directory")
    )
    return a.file_type_summary(c)


@query("skip_rate", """
SELECT count(*) AS parsed, count(*) FILTER (n_chars < 500) AS skipped,
       count(*) FILTER (n_chars < 500) / CAST(count(*) AS DOUBLE) AS rate FROM documents""")
def skip_rate(spark, folder):
    return a.skip_rate(table(spark, folder, "documents"), F.col("n_chars") < 500)


@query("canary_skip_rate", """
SELECT 'file' || (o_orderkey % 4) AS file, count(*) AS parsed, count(*) FILTER (o_orderstatus <> 'F' OR o_orderkey % 4 = 1) AS skipped,
       count(*) FILTER (o_orderstatus <> 'F' OR o_orderkey % 4 = 1) / CAST(count(*) AS DOUBLE) AS rate,
       count(*) FILTER (o_orderstatus <> 'F' OR o_orderkey % 4 = 1) / CAST(count(*) AS DOUBLE) > 0.6 AS second_schema
FROM orders WHERE o_orderkey // 4 + 1 <= 20000 GROUP BY 1""")
def canary_skip_rate(spark, folder):
    """Orders dealt out to four files; the probe of the first 20,000 rows is the operator itself."""
    k = F.col("o_orderkey")
    o = table(spark, folder, "orders").select(
        F.concat(F.lit("file"), k % 4).alias("file"), (F.floor(k / 4) + 1).alias("ordinal"), "o_orderstatus", "o_orderkey"
    )
    return a.canary_skip_rate(o, (F.col("o_orderstatus") != "F") | (k % 4 == 1), "file", "ordinal")


@query("top_domains_by_count", """
SELECT regexp_extract(url, 'https?://([^/:]+)', 1) AS host, count(*) AS n FROM pages GROUP BY 1 ORDER BY n DESC, host LIMIT 20""")
def top_domains_by_count(spark, folder):
    return a.top_by_count(table(spark, folder, "pages").select(text.url_host(F.col("url")).alias("host")), "host")


HOSTS = "(SELECT regexp_extract(url, '/(de|en|es|fr)/', 1) AS section, regexp_extract(url, 'https?://([^/:]+)', 1) AS host FROM pages)"


@query("domains_alphabetical", f"""
SELECT section, array_to_string(list_slice(list_sort(list_distinct(list(host))), 1, 20), ',') AS domains FROM {HOSTS} GROUP BY section""")
def domains_alphabetical(spark, folder):
    p = table(spark, folder, "pages").select(
        F.regexp_extract("url", "/(de|en|es|fr)/", 1).alias("section"), text.url_host(F.col("url")).alias("host")
    )
    return a.first_names(p, "section", "host").select("section", F.array_join("names", ",").alias("domains"))


@query("top_n_array", """
SELECT source, array_to_string(list_slice(list_sort(list_distinct(list(w))), 1, 20), ' ') AS words FROM (
  SELECT source, unnest(string_split(replace(""" + sql_redacted("text") + """, chr(10), ' '), ' ')) AS w FROM documents) WHERE w <> '' GROUP BY source""")
def top_n_array(spark, folder):
    d = table(spark, folder, "documents")
    w = d.select("source", F.explode(F.split(redact(F.col("text")), "[ \n]", -1)).alias("w"))
    return a.first_names(w, "source", "w").select("source", F.array_join("names", " ").alias("words"))


@query("source_summary", "SELECT source, lang, count(*) AS n FROM documents GROUP BY source, lang")
def source_summary(spark, folder):
    return table(spark, folder, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))


@query("distinct_count", """
SELECT count(DISTINCT lang) AS n_langs, count(DISTINCT source) AS n_sources FROM documents""")
def distinct_count(spark, folder):
    return table(spark, folder, "documents").agg(
        F.countDistinct("lang").alias("n_langs"), F.countDistinct("source").alias("n_sources")
    )


KINDS = list(v.KINDS.values())


@query("host_statistics", f"WITH {v.HOST_COUNTS} SELECT host_id, " + ", ".join(
    f"count(*) FILTER (kind = '{k}') AS total_{k}, count(*) FILTER (kind = '{k}') > 0 AS has_{k}" for k in KINDS
) + " FROM host_counts GROUP BY host_id")
def host_statistics(spark, folder):
    return a.host_statistics(v.host_counts(spark, folder), "host_id", "kind", "n", KINDS)


def _score_sql(weights) -> str:
    """Points in ten-thousandths, rounded half to even on a tenth."""
    points = " + ".join(
        f"CASE WHEN count(*) FILTER (kind = '{k}') > 0 THEN least({round(cap * 10000)},"
        f" count(*) FILTER (kind = '{k}') * {round(unit * 10000)}) + {round(flat * 10000)} ELSE 0 END"
        for k, unit, cap, flat in weights
    )
    return f"""
WITH {v.HOST_COUNTS}, p AS (SELECT host_id, least(100000, {points}) AS t FROM host_counts GROUP BY host_id)
SELECT host_id, (t // 1000 + CASE WHEN t % 1000 > 500 OR (t % 1000 = 500 AND (t // 1000) % 2 = 1) THEN 1 ELSE 0 END) / 10.0::DOUBLE AS risk_score
FROM p"""


def _score(weights):
    return lambda spark, folder: jobs.score_hosts(v.host_counts(spark, folder), "host_id", "kind", "n", weights)


for _name, _weights in [("risk_score", rules.RISK_WEIGHTS_A), ("risk_score_b", rules.RISK_WEIGHTS_B), ("risk_score_c", rules.RISK_WEIGHTS_C)]:
    query(_name, _score_sql(_weights))(_score(_weights))


@query("rows_per_table", "SELECT event_type AS table_name, count(*) AS n FROM events GROUP BY event_type")
def rows_per_table(spark, folder):
    return table(spark, folder, "events").groupBy(F.col("event_type").alias("table_name")).agg(F.count("*").alias("n"))


@query("format_counts", """
SELECT CASE WHEN event_type = 'purchase' THEN 'transaction' WHEN event_type = 'error' THEN 'skipped' ELSE 'identity' END AS mode,
       count(*) AS n FROM events GROUP BY 1""")
def format_counts(spark, folder):
    kind = F.col("event_type")
    mode = F.when(kind == "purchase", "transaction").when(kind == "error", "skipped").otherwise("identity")
    return table(spark, folder, "events").groupBy(mode.alias("mode")).agg(F.count("*").alias("n"))


@query("bulk_result_counts", """
SELECT count(*) FILTER (s BETWEEN 200 AND 299) AS ok, count(*) FILTER (s NOT BETWEEN 200 AND 299) AS failed
FROM (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) * 5 AS s FROM events)""")
def bulk_result_counts(spark, folder):
    s = F.get_json_object("props", "$.k").cast("long") * 5
    return a.bulk_result_counts(table(spark, folder, "events").select(s.alias("s")), "s")


# Lists and tables planted as texts: both have lines of the list's layout, the tables a header too.
LIST_TEXT = "ann@example.com:invented1\nbob@example.com:invented2\n"
TABLE_TEXT = "ID\tfirst_name\tphone\n1 ann 5550\n2 bob 5551\n"
SHARED = f"""docs AS (SELECT doc_id, CASE doc_id % 7 WHEN 1 THEN {q(LIST_TEXT)} WHEN 2 THEN {q(TABLE_TEXT)}
  WHEN 3 THEN 'user;billing_city' || chr(10) || {q(LIST_TEXT)} ELSE text END AS text FROM documents),
lines AS (SELECT doc_id, unnest(range(len(a))) AS pos, unnest(a) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM docs))"""
HEADED = " OR ".join(
    f"(contains(low, {d}) AND len(list_filter(list_transform(string_split(low, {d}), lambda x: trim(trim(x), chr(39) || '\"')), "
    f"lambda x: x IN {sql_in(h for h in rules.TABLE_HEADERS if not h.endswith('_'))} OR starts_with(x, 'billing_') OR starts_with(x, 'street_'))) > 0)"
    for d in ("','", "chr(9)", "';'"))


def _shared(spark, folder):
    k = F.col("doc_id") % 7
    planted = F.when(k == 1, LIST_TEXT).when(k == 2, TABLE_TEXT).when(k == 3, "user;billing_city\n" + LIST_TEXT).otherwise(F.col("text"))
    return table(spark, folder, "documents").select("doc_id", planted.alias("text"))


SHARE_LINES = """
ls AS (SELECT doc_id, pos, line FROM (SELECT doc_id, pos, """ + "regexp_replace(line, '^\\s+|\\s+$', '', 'g')" + """ AS line FROM lines)
       WHERE line <> '' AND NOT starts_with(line, '#') QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY pos) <= 25),
parts AS (SELECT doc_id, pos, d, list_filter(list_transform(string_split(line, d), lambda p: regexp_replace(p, '^\\s+|\\s+$', '', 'g')), lambda p: p <> '') AS p
          FROM ls, (SELECT unnest([chr(9), ':', ' ']) AS d)),
shaped AS (SELECT doc_id, pos, bool_or(len(p) BETWEEN 2 AND 4
             AND (len(list_filter(p, lambda x: contains(x, '@') AND contains(x, '.'))) > 0
                  OR coalesce(regexp_matches(p[1], '^[a-zA-Z0-9_.\\-+@#$*!=|]+$'), false))
             AND len(list_filter(p, lambda x: NOT (contains(x, '@') AND contains(x, '.')) AND length(x) >= 3)) > 0) AS s
           FROM parts GROUP BY doc_id, pos),
headed AS (SELECT doc_id, bool_or(""" + HEADED + """) AS h FROM (
  SELECT doc_id, lower(line) AS low FROM ls QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY pos) = 1) GROUP BY doc_id),
share AS (SELECT doc_id, CASE WHEN bool_or(h) THEN 0.0 ELSE coalesce(avg(CASE WHEN s THEN 1.0 WHEN NOT s THEN 0.0 END), 0.0) END AS share
  FROM docs LEFT JOIN shaped USING (doc_id) LEFT JOIN headed USING (doc_id) GROUP BY doc_id)
"""


@query("ulp_shape_share", f"WITH {SHARED}, {SHARE_LINES} SELECT doc_id, round(share, 6) AS share, share >= 0.7 AS quarantined FROM share")
def ulp_shape_share(spark, folder):
    out = jobs.credential_list_quarantine(_shared(spark, folder), "doc_id", "text")
    return out.select("doc_id", F.round("share", 6).alias("share"), "quarantined")


@query("credential_list_quarantine", f"WITH {SHARED}, {SHARE_LINES} SELECT doc_id FROM share WHERE share >= 0.7")
def credential_list_quarantine(spark, folder):
    out = jobs.credential_list_quarantine(_shared(spark, folder), "doc_id", "text")
    return out.filter("quarantined").select("doc_id")


@query("report_rollup", """
SELECT source, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY ROLLUP (source, lang)""")
def report_rollup(spark, folder):
    d = table(spark, folder, "documents")
    return d.rollup("source", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"))
