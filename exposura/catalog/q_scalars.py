"""Scalar functions (survey 2.10) over columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from exposura import rules
from exposura.catalog import views as v
from exposura.catalog.base import case_first, q, query, sql_in, stamp, strip, sub
from exposura.functions import files, sensitive, text, times, values
from exposura.session import DEMO_PEPPER, pepper
from exposura.operators import joins
from exposura.sources.readers import table

MSG = f"WITH {v.MESSAGES} "
PEPPER = q(DEMO_PEPPER)


def _documents(spark, folder):
    return table(spark, folder, "documents")


def _tokens(spark, folder):
    """(doc_id, pos, token): the e-mail addresses and the words of every text."""
    d = _documents(spark, folder)
    found = F.concat(sensitive.tokens(F.col("text"), rules.EMAIL), F.split("text", "[ \n]", -1))
    return d.select("doc_id", F.posexplode(found).alias("pos", "token"))


TOKENS = f"""tokens AS (
  SELECT doc_id, unnest(range(len(a))) AS pos, unnest(a) AS token FROM (
    SELECT doc_id, list_concat(regexp_extract_all(text, {q(rules.EMAIL)}),
                               string_split(replace(text, chr(10), ' '), ' ')) AS a FROM documents))"""


@query("norm_email", f"""
SELECT doc_id, i, sha256({PEPPER} || lower(e)) AS email_hash FROM (
  SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS e FROM (
    SELECT doc_id, regexp_extract_all(text, {q(rules.EMAIL)}) AS a FROM documents))""")
def norm_email(spark, folder):
    d = _documents(spark, folder)
    t = d.select("doc_id", F.posexplode(sensitive.tokens(F.col("text"), rules.EMAIL)).alias("p", "e"))
    hashed = sensitive.keyed_hash(text.norm_email(F.concat(F.lit(" "), F.upper("e"))), pepper(spark, DEMO_PEPPER))
    return t.select("doc_id", F.col("p").cast("long").alias("i"), hashed.alias("email_hash"))


@query("norm_phone", f"""
SELECT doc_id, i, sha256({PEPPER} || CASE WHEN starts_with(p, '+') THEN '+' ELSE '' END
                         || regexp_replace(p, '[^0-9]', '', 'g')) AS phone_hash FROM (
  SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS p FROM (
    SELECT doc_id, regexp_extract_all(text, {q(rules.PHONE)}) AS a FROM documents))""")
def norm_phone(spark, folder):
    d = _documents(spark, folder)
    t = d.select("doc_id", F.posexplode(sensitive.tokens(F.col("text"), rules.PHONE)).alias("i", "p"))
    hashed = sensitive.keyed_hash(text.norm_phone(F.col("p")), pepper(spark, DEMO_PEPPER))
    return t.select("doc_id", F.col("i").cast("long").alias("i"), hashed.alias("phone_hash"))


@query("is_phone", f"""
SELECT doc_id, count(*) AS n, count(*) FILTER (regexp_matches(p, '^\\+?[0-9][0-9\\s\\-(). ]{{6,19}}$')
       AND length(regexp_replace(p, '[^0-9]', '', 'g')) BETWEEN 7 AND 15) AS n_phone FROM (
  SELECT doc_id, {strip("unnest(regexp_extract_all(text, '[+0-9][0-9 ().-]+'))")} AS p FROM documents)
GROUP BY doc_id""")
def is_phone(spark, folder):
    d = _documents(spark, folder)
    runs = F.regexp_extract_all("text", F.lit("[+0-9][0-9 ().-]+"), F.lit(0))
    t = d.select("doc_id", F.explode(runs).alias("p"))
    return t.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.count_if(text.is_phone(F.col("p"))).alias("n_phone")
    )


ASSET = case_first([
    ("contains(token, '@')", "'email'"),
    (f"regexp_matches({sub('token', '[\\s\\-+().]', '')}, '^[0-9]{{7,15}}$')", "'phone'"),
    ("contains(token, '.') AND NOT starts_with(token, 'http')", "'domain'"),
], "'username'")


@query("asset_kind", f"WITH {TOKENS} SELECT doc_id, {ASSET} AS kind, count(*) AS n FROM tokens GROUP BY 1, 2")
def asset_kind(spark, folder):
    t = _tokens(spark, folder).select("doc_id", text.asset_kind(F.col("token")).alias("kind"))
    return t.groupBy("doc_id", "kind").agg(F.count("*").alias("n"))


ASSET2 = case_first([
    ("regexp_matches(token, '^[^@]+@[^@]+\\.[^@]+')", "'email'"),
    ("regexp_matches(token, '^https?://')", "'url'"),
    ("regexp_matches(token, '^(?:[a-zA-Z0-9-]+\\.)+[a-zA-Z]{2,}$')", "'domain'"),
    ("NOT regexp_matches(token, '^[0-9]+$') AND NOT contains(token, ' ') AND NOT contains(token, '.')", "'username'"),
], "'keyword'")


@query("asset_kind2", f"WITH {TOKENS} SELECT doc_id, {ASSET2} AS kind, count(*) AS n FROM tokens GROUP BY 1, 2")
def asset_kind2(spark, folder):
    t = _tokens(spark, folder).select("doc_id", text.asset_kind2(F.col("token")).alias("kind"))
    return t.groupBy("doc_id", "kind").agg(F.count("*").alias("n"))


IS_IP = "regexp_matches(x, '^[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}$')"
IS_URL = case_first([
    ("regexp_matches(lower(x), '^(https?://|android://|chrome://|ftp://|www\\.)')", "true"),
    ("contains(x, '@')", "false"),
    ("contains(x, '/') AND contains(x, '.')", "true"),
], "regexp_matches(lower(x), '^(?:[a-z0-9\\-]+\\.)+[a-z]{2,6}$')")


@query("is_ip", f"""
SELECT doc_id, count(*) FILTER ({IS_IP}) AS n_ip, count(*) AS n FROM (
  SELECT doc_id, unnest(string_split(text, ' ')) AS x FROM documents) GROUP BY doc_id""")
def is_ip(spark, folder):
    words = F.split("text", " ", -1)
    return _documents(spark, folder).select(
        "doc_id", F.size(F.filter(words, text.is_ip)).cast("long").alias("n_ip"),
        F.size(words).cast("long").alias("n"),
    )


@query("is_url", f"""
SELECT page_id, part, {IS_URL} AS is_url FROM (
  SELECT page_id, 'url' AS part, url AS x FROM pages
  UNION ALL SELECT page_id, 'path', regexp_replace(url, '^https?://[^/]+', '') FROM pages
  UNION ALL SELECT page_id, 'host', regexp_extract(url, 'https?://([^/:]+)', 1) FROM pages)""")
def is_url(spark, folder):
    p = table(spark, folder, "pages")
    parts = F.array(
        F.struct(F.lit("url").alias("part"), F.col("url").alias("x")),
        F.struct(F.lit("path").alias("part"), F.regexp_replace("url", "^https?://[^/]+", "").alias("x")),
        F.struct(F.lit("host").alias("part"), text.url_host(F.col("url")).alias("x")),
    )
    long = p.select("page_id", F.inline(parts))
    return long.select("page_id", "part", text.is_url(F.col("x")).alias("is_url"))


VALID_HOST = """(length(h) >= 3 AND (regexp_matches(h, '^(https?|android|ftp|ssh|mongodb|mysql)://')
  OR regexp_matches(h, '^[0-9]{1,3}(\\.[0-9]{1,3}){3}(:[0-9]+)?$')
  OR (contains(h, '[') AND contains(h, ']')) OR (contains(h, '.') AND regexp_matches(h, '\\p{L}'))))"""


@query("is_valid_host", f"""
WITH {TOKENS} SELECT doc_id, count(*) FILTER ({VALID_HOST}) AS n_host, count(*) AS n
FROM (SELECT doc_id, lower(token) AS h FROM tokens) GROUP BY doc_id""")
def is_valid_host(spark, folder):
    t = _tokens(spark, folder)
    return t.groupBy("doc_id").agg(
        F.count_if(text.is_valid_host(F.col("token"))).alias("n_host"), F.count("*").alias("n")
    )


@query("norm_host", """
SELECT page_id, CASE WHEN contains(h, '://') THEN lower(regexp_extract(h, '^(.*?://)', 1)) || regexp_replace(h, '^.*?://', '')
                     ELSE lower(h) END AS host
FROM (SELECT page_id, regexp_replace(CASE WHEN page_id % 2 = 0 THEN upper(url) ELSE upper(regexp_replace(url, '^https?://', '')) END,
      '/+$', '') AS h FROM pages)""")
def norm_host(spark, folder):
    u = F.upper(F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.regexp_replace("url", "^https?://", "")))
    return table(spark, folder, "pages").select("page_id", text.norm_host(F.concat(u, F.lit(" "))).alias("host"))


@query("fix_double_scheme", "SELECT page_id, 'https://' || regexp_replace(url, '^https?://', '') AS url FROM pages")
def fix_double_scheme(spark, folder):
    u = F.concat(F.lit("https://http://"), F.col("url"))
    return table(spark, folder, "pages").select("page_id", text.fix_double_scheme(u).alias("url"))


@query("registered_domain", f"SELECT page_id, {v.sql_domain('url')} AS domain FROM pages")
def registered_domain(spark, folder):
    p = table(spark, folder, "pages")
    return p.select("page_id", text.registered_domain(F.col("url"), v.SUFFIXES).alias("domain"))


# A table of suffixes made from the hosts themselves: last labels, every third last two labels,
# a wildcard and an exception for some.
SUFFIX_TABLE = """hosts AS (SELECT page_id, string_split(regexp_extract(url, 'https?://([^/:]+)', 1), '.') AS a FROM pages),
rules AS (SELECT DISTINCT unnest([a[-1], CASE WHEN page_id % 3 = 0 THEN a[-2] || '.' || a[-1] END,
  CASE WHEN page_id % 7 = 0 THEN '*.' || a[-3] || '.' || a[-2] || '.' || a[-1] END,
  CASE WHEN page_id % 14 = 0 AND len(a) > 3 THEN '!' || a[-4] || '.' || a[-3] || '.' || a[-2] || '.' || a[-1] END]) AS rule FROM hosts)"""


@query("registered_domain_table", f"""
WITH {SUFFIX_TABLE}, listed AS (SELECT ltrim(replace(rule, '*.', ''), '!') AS ending, starts_with(rule, '!') AS excepted, starts_with(rule, '*.') AS wild FROM rules WHERE rule IS NOT NULL),
ends AS (SELECT page_id, len(a) AS n, k, array_to_string(a[-k:], '.') AS ending, a FROM hosts, range(1, 9) r(k) WHERE k <= len(a)),
met AS (SELECT page_id, a, excepted, CASE WHEN excepted THEN k ELSE k + wild::INT END AS reach, CASE WHEN excepted THEN k ELSE k + wild::INT + 1 END AS kept
        FROM ends JOIN listed USING (ending) WHERE excepted OR n > k + wild::INT),
best AS (SELECT page_id, array_to_string(a[-kept:], '.') AS domain FROM met QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY excepted DESC, reach DESC) = 1)
SELECT page_id, coalesce(domain, '') AS domain FROM pages LEFT JOIN best USING (page_id)""")
def registered_domain_table(spark, folder):
    """Registered domains by a suffix table that is data."""
    p = table(spark, folder, "pages").select("page_id", "url")
    a, k = F.split(text.url_host(F.col("url")), "[.]"), F.col("page_id")

    def last(n):
        return F.array_join(F.slice(a, -n, n), ".")

    rules_ = F.array(
        last(1), F.when(k % 3 == 0, last(2)), F.when(k % 7 == 0, F.concat(F.lit("*."), last(3))),
        F.when((k % 14 == 0) & (F.size(a) > 3), F.concat(F.lit("!"), last(4))))
    suffixes = p.select(F.explode(rules_).alias("rule")).distinct().filter("rule IS NOT NULL")
    return joins.registered_domains(p, "url", suffixes).select("page_id", "domain")


@query("url_host", "SELECT page_id, regexp_extract(url, 'https?://([^/:]+)', 1) AS host FROM pages")
def url_host(spark, folder):
    return table(spark, folder, "pages").select("page_id", text.url_host(F.col("url")).alias("host"))


@query("abs_url", """
SELECT page_id, root || '/' || ltrim(path, '/') AS from_path, url AS from_url FROM (
  SELECT page_id, url, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) AS root,
         regexp_replace(url, '^[a-zA-Z]+://[^/?#]+', '') AS path FROM pages)""")
def abs_url(spark, folder):
    root = text.root_url(F.col("url"))
    path = F.regexp_replace("url", "^[a-zA-Z]+://[^/?#]+", "")
    return table(spark, folder, "pages").select(
        "page_id", text.abs_url(path, root).alias("from_path"), text.abs_url(F.col("url"), root).alias("from_url")
    )


@query("strip_query", "SELECT page_id, split_part(url, '?', 1) AS url FROM pages")
def strip_query(spark, folder):
    return table(spark, folder, "pages").select("page_id", text.strip_query(F.col("url")).alias("url"))


@query("slug_name", f"""
SELECT p_partkey, CASE WHEN s = '' THEN 'general' ELSE s END AS slug FROM (
  SELECT p_partkey, {sub(sub(sub("lower(p_name || ' ' || replace(p_brand, '#', '_'))", '[^a-z0-9]', '-'), '-+', '-'), '^-+|-+$', '')} AS s
  FROM part)""")
def slug_name(spark, folder):
    raw = F.concat(
        F.lit("in/[HASH]"), F.col("p_name"), F.lit(" "), F.translate("p_brand", "#", "_"), F.lit("__.tar.gz")
    )
    return table(spark, folder, "part").select("p_partkey", text.slug_name(raw).alias("slug"))


@query("slug_index", f"""
SELECT p_partkey, left('ix-' || {sub(sub(sub("lower(p_name || ' ' || p_brand || ' ' || repeat(p_type, 12))", '[^a-z0-9_-]', '-'), '-+', '-'), '^-+|-+$', '')}, 100) AS slug
FROM part""")
def slug_index(spark, folder):
    raw = F.concat_ws(" ", "p_name", "p_brand", F.repeat("p_type", F.lit(12)))
    return table(spark, folder, "part").select("p_partkey", text.slug_index(raw, "ix-").alias("slug"))


@query("slug_asset", f"""
SELECT page_id, 'asset-domain-' || left({sub('lower(url)', '[^a-z0-9]', '')}, 80) AS slug FROM pages""")
def slug_asset(spark, folder):
    p = table(spark, folder, "pages")
    return p.select("page_id", text.slug_asset(F.lit("domain"), F.col("url"), "asset-").alias("slug"))


@query("filename_tag", """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'hash' WHEN 1 THEN 'nohash' ELSE 'unknown' END AS tag FROM part""")
def filename_tag(spark, folder):
    tag = F.when(F.col("p_partkey") % 3 == 0, "[Hash]").when(F.col("p_partkey") % 3 == 1, "[nohash]").otherwise("")
    name = F.concat("p_name", tag, F.lit(".txt"))
    return table(spark, folder, "part").select("p_partkey", text.filename_tag(name).alias("tag"))


@query("shape_signature", f"""
WITH {v.LINES} SELECT left({sub('line', '[\\p{L}\\p{N}]', '')}, 15) AS shape, count(*) AS n FROM lines GROUP BY 1""")
def shape_signature(spark, folder):
    l = v.lines_of(_documents(spark, folder), "doc_id", "text")
    return l.groupBy(text.shape_signature(F.col("line")).alias("shape")).agg(F.count("*").alias("n"))


SYMBOLS = f"length(regexp_replace(text, {q(rules.SYMBOL_CLASS)}, '', 'g'))"


@query("symbol_ratio", f"""
SELECT doc_id, CASE WHEN length(text) > 0 THEN (length(text) - {SYMBOLS}) / length(text) ELSE 0.0::DOUBLE END AS ratio FROM documents""")
def symbol_ratio(spark, folder):
    return _documents(spark, folder).select("doc_id", text.symbol_ratio(F.col("text")).alias("ratio"))


KIND_SQL = case_first(
    [("w IS NULL OR w = '' OR upper(w) = 'NULL'", "'empty'")]
    + [(f"regexp_matches(w, {q(p)})", q(n)) for n, p in rules.SECRET_KINDS], "'plaintext'"
)


@query("secret_kind", f"""
SELECT doc_id, {KIND_SQL} AS kind, count(*) AS n FROM (
  SELECT doc_id, unnest(string_split(regexp_replace(text, '["\n]', ' ', 'g'), ' ')) AS w FROM documents) GROUP BY 1, 2""")
def secret_kind(spark, folder):
    d = _documents(spark, folder)
    words = d.select("doc_id", F.explode(F.split(F.regexp_replace("text", '["\n]', " "), " ", -1)).alias("w"))
    return words.groupBy("doc_id", sensitive.secret_kind(F.col("w")).alias("kind")).agg(F.count("*").alias("n"))


@query("human_bytes", """
SELECT o_orderkey, CASE WHEN b < 1024 THEN printf('%.1f B', b) WHEN b < 1048576 THEN printf('%.1f KB', b / 1024)
  WHEN b < 1073741824 THEN printf('%.1f MB', b / 1048576) ELSE printf('%.1f GB', b / 1073741824) END AS size
FROM (SELECT o_orderkey, CAST(o_orderkey * o_orderkey AS DOUBLE) AS b FROM orders)""")
def human_bytes(spark, folder):
    b = (F.col("o_orderkey") * F.col("o_orderkey")).cast("double")
    return table(spark, folder, "orders").select("o_orderkey", text.human_bytes(b).alias("size"))


@query("is_executable_magic", """
SELECT page_id, page_id % 2 = 0 AS is_exec, false AS plain FROM pages""")
def is_executable_magic(spark, folder):
    marked = F.concat(F.when(F.col("page_id") % 2 == 0, "#!").otherwise(""), F.col("html"))
    return table(spark, folder, "pages").select(
        "page_id", files.is_executable_magic(F.encode(marked, "UTF-8")).alias("is_exec"),
        files.is_executable_magic(F.encode("html", "UTF-8")).alias("plain"),
    )


@query("clean_header", "SELECT p_partkey, p_name AS header FROM part")
def clean_header(spark, folder):
    raw = F.concat(F.lit("\t \"'"), F.col("p_name"), F.lit("'\" "))
    return table(spark, folder, "part").select("p_partkey", text.clean_header(raw).alias("header"))


@query("null_token", "SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders")
def null_token(spark, folder):
    raw = F.when(F.col("o_orderpriority") == "5-LOW", F.when(F.col("o_orderkey") % 2 == 0, " N/A ").otherwise("None"))
    value = F.coalesce(raw, F.concat(F.lit(" "), F.col("o_orderpriority")))
    return table(spark, folder, "orders").select("o_orderkey", text.null_token(value).alias("priority"))


@query("display_name", MSG + """
SELECT channel, message_id, CASE WHEN message_id % 3 = 0 THEN first_name || ' ' || username WHEN message_id % 3 = 1 THEN username
  ELSE CAST(channel AS VARCHAR) END AS name FROM messages""")
def display_name(spark, folder):
    m = v.messages(spark, folder)
    k = F.col("message_id") % 3
    first = F.when(k == 0, F.col("first_name")).when(k == 1, "")
    last = F.when(k < 2, F.col("username"))
    return m.select("channel", "message_id", text.display_name(first, last, F.col("channel")).alias("name"))


@query("preview", f"""
SELECT doc_id, length(p200) AS n200, length(p300) AS n300, md5(p200) AS title_hash, md5(p300) AS content_hash
FROM (SELECT doc_id, left(split_part(text, chr(10), 1), 200) AS p200, left(text, 300) AS p300 FROM documents)""")
def preview(spark, folder):
    title = text.preview(text.first_line(F.col("text")), 200)
    body = text.preview(F.col("text"), 300)
    return _documents(spark, folder).select(
        "doc_id", F.length(title).cast("long").alias("n200"), F.length(body).cast("long").alias("n300"),
        F.md5(title).alias("title_hash"), F.md5(body).alias("content_hash"),
    )


# --- date and time ----------------------------------------------------------------

@query("sanitize_date", f"""
WITH {v.TRANSACTIONS} SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL
  ELSE replace(transaction_time, ' ', 'T') END AS day FROM transactions""")
def sanitize_date(spark, folder):
    t = v.transactions(spark, folder)
    return t.select("o_orderkey", times.sanitize_date(F.col("transaction_time")).alias("day"))


@query("dmy_timestamp", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS iso FROM events""")
def dmy_timestamp(spark, folder):
    raw = F.when(F.col("event_type") == "error", F.date_format("ts", "dd.MM.yyyy")).otherwise(
        F.date_format("ts", "dd.MM.yyyy HH:mm:ss")
    )
    return table(spark, folder, "events").select("event_id", times.dmy_timestamp(raw).alias("iso"))


@query("epoch_timestamp", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') END AS iso FROM events""")
def epoch_timestamp(spark, folder):
    raw = F.when(F.col("event_type") != "error", F.unix_timestamp("ts").cast("string")).otherwise("soon")
    return table(spark, folder, "events").select("event_id", times.epoch_timestamp(raw).alias("iso"))


@query("run_duration", f"""
WITH {v.RUNS} SELECT run_id, coalesce(CAST((epoch_us(finished_at) - epoch_us(started_at)) // 1000000 AS VARCHAR), 'running') AS duration
FROM runs""")
def run_duration(spark, folder):
    r = v.runs(spark, folder)
    return r.select("run_id", times.run_duration(F.col("started_at"), F.col("finished_at")).alias("duration"))


@query("age_hours", """
SELECT event_id, round((epoch(TIMESTAMP '2024-02-01') - floor(epoch(ts))) / 3600.0, 1) AS age FROM events""")
def age_hours(spark, folder):
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    return table(spark, folder, "events").select("event_id", times.age_hours(now, F.col("ts")).alias("age"))


@query("next_day", "SELECT event_id, strftime(CAST(ts AS DATE) + 1, '%Y-%m-%d') AS day FROM events")
def next_day(spark, folder):
    return table(spark, folder, "events").select("event_id", times.next_day(F.col("ts")).cast("string").alias("day"))


# --- arrays, maps, JSON --------------------------------------------------------------

@query("array_len_stats", """
SELECT doc_id, len(string_split(text, chr(10))) AS n_lines, len(string_split(replace(text, chr(10), ' '), ' ')) AS n_words
FROM documents""")
def array_len_stats(spark, folder):
    return _documents(spark, folder).select(
        "doc_id", F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.size(F.split("text", "[ \n]", -1)).cast("long").alias("n_words"),
    )


def _order_map():
    return F.create_map(
        F.lit("extra_data.status"), F.col("o_orderstatus"),
        F.lit("extra_data.priority"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise(""),
        F.lit("plain"), F.when(F.col("o_orderkey") % 2 == 0, "x"),
    )


def _map_text(m):
    pairs = F.transform(F.map_entries(m), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.array_join(F.sort_array(pairs), ";")


def _order_map_sql(prefix: str) -> str:
    return f"""SELECT o_orderkey, concat_ws(';',
      CASE WHEN o_orderpriority <> '5-LOW' THEN '{prefix}priority=' || o_orderpriority END,
      '{prefix}status=' || o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN 'plain=x' END) AS pairs FROM orders"""


@query("map_skip_empty", _order_map_sql("extra_data."))
def map_skip_empty(spark, folder):
    o = table(spark, folder, "orders")
    return o.select("o_orderkey", _map_text(values.map_skip_empty(_order_map())).alias("pairs"))


@query("map_prefix_strip", """
SELECT o_orderkey, concat_ws(';', CASE WHEN o_orderkey % 2 = 0 THEN 'plain=x' END,
  CASE WHEN o_orderpriority <> '5-LOW' THEN 'priority=' || o_orderpriority END, 'status=' || o_orderstatus) AS pairs FROM orders""")
def map_prefix_strip(spark, folder):
    m = values.map_prefix_strip(values.map_skip_empty(_order_map()))
    return table(spark, folder, "orders").select("o_orderkey", _map_text(m).alias("pairs"))


@query("map_merge", """
SELECT o_orderkey, concat_ws(';', 'a=' || CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'old' END,
  'b=' || o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN 'c=' || o_orderpriority END) AS pairs FROM orders""")
def map_merge(spark, folder):
    key = F.when(F.col("o_orderstatus") == "F", "a").otherwise("c")
    first = F.create_map(F.lit("a"), F.lit("old"), F.lit("b"), F.col("o_orderstatus"))
    merged = values.map_merge(first, F.create_map(key, F.col("o_orderpriority")))
    return table(spark, folder, "orders").select("o_orderkey", _map_text(merged).alias("pairs"))


@query("json_get", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_get(spark, folder):
    return table(spark, folder, "events").select("event_id", values.json_get(F.col("props"), "k").alias("k"))


@query("json_array_explode", """
SELECT event_id, i, CASE i WHEN 0 THEN k ELSE CAST(user_id AS BIGINT) END AS k FROM (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, unnest([0, 1]) AS i FROM events)""")
def json_array_explode(spark, folder):
    line = F.concat(F.lit("["), F.col("props"), F.lit(', {"k": '), F.col("user_id"), F.lit("}]"))
    parsed = F.from_json(line, "array<struct<k: long>>")
    e = table(spark, folder, "events").select("event_id", F.posexplode(parsed).alias("i", "r"))
    return e.select("event_id", "i", "r.k")


# --- numbers ---------------------------------------------------------------------------

@query("depth_level", f"WITH {v.PAGE_FILES} SELECT depth_level, is_directory, count(*) AS n FROM page_files GROUP BY 1, 2")
def depth_level(spark, folder):
    c = v.page_files(spark, folder)
    return c.groupBy(F.col("depth_level").cast("long").alias("depth_level"), "is_directory").agg(F.count("*").alias("n"))


@query("confidence_score", f"""
SELECT page_id, CASE WHEN starts_with(lower(h), 'https://') THEN 55 WHEN starts_with(lower(h), 'http://') THEN 50
    WHEN {VALID_HOST} THEN 40 ELSE 0 END
  + CASE WHEN contains(h, '/') AND NOT ends_with(h, '://') THEN 10 ELSE 0 END
  + CASE page_id % 3 WHEN 0 THEN 20 WHEN 1 THEN 15 ELSE 10 END AS score
FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE regexp_extract(url, 'https?://([^/:]+)', 1) END AS h FROM pages)""")
def confidence_score(spark, folder):
    host = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(text.url_host(F.col("url")))
    k = F.col("page_id") % 3
    user = F.when(k == 0, "a@example.com").when(k == 1, F.lpad(F.col("page_id").cast("string"), 9, "5")).otherwise("someone")
    return table(spark, folder, "pages").select("page_id", sensitive.confidence_score(host, user).alias("score"))
