"""The reference shapes (threads, messages, runs, ...) as views over the given tables.

Every view is a projection of a whole table; its SQL twin stands beside it.
Attributes the tables lack (dates of texts, media of messages) are computed
from their keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from exposura import rules
from exposura.catalog.base import strip, sub
from exposura.functions import text
from exposura.operators.dedup import thread_hash
from exposura.operators.projections import derive_message_row
from exposura.sources.readers import catalog_columns, table

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# The invented prose holds none of the default keywords; these do occur in it.
EXTRA_KEYWORDS = ["licensed under", "license", "token =", "# watch", "apache", "theand", "erver", "nicht"]
KEYWORDS = rules.KEYWORDS + [k for k in EXTRA_KEYWORDS if not k.startswith("#")]

# example.* registered below these three, so that hosts stay apart.
SUFFIXES = ["com", "net", "org", "example.com", "example.net", "example.org"]


def stamp(c):
    return F.date_format(c, STAMP)


def threads(spark: SparkSession, folder: str) -> DataFrame:
    """documents as threads; Spanish ones stand for rows stored before hashes were kept."""
    d = table(spark, folder, "documents")
    t = d.select(
        "doc_id", F.col("source").alias("forum"), text.first_line(F.col("text")).alias("title"),
        F.col("text").alias("content"), "lang", "n_chars",
        F.expr("timestampadd(DAY, cast(doc_id % 30 as int), timestamp_ntz'2024-01-01 00:00:00')").alias("crawled_at"),
    )
    return t.withColumn(
        "dedup_hash", F.when(F.col("lang") != "es", thread_hash(F.col("title"), F.col("forum")))
    )


THREADS = f"""threads AS (
  SELECT doc_id, forum, title, content, lang, n_chars, crawled_at,
         CASE WHEN lang <> 'es' THEN sha256(concat({strip('lower(title)')}, '|', forum)) END AS dedup_hash
  FROM (SELECT doc_id, source AS forum, split_part(text, chr(10), 1) AS title, text AS content,
               lang, n_chars, TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 30 AS INTEGER)) AS crawled_at
        FROM documents))"""


def forums(spark: SparkSession, folder: str) -> DataFrame:
    """Sources as forums, three without any thread among them."""
    d = table(spark, folder, "nation").select(F.concat(F.lit("src"), F.col("n_nationkey")).alias("forum"), "n_nationkey")
    return d.select(
        "forum",
        F.concat(F.lit("https://"), F.col("forum"), F.lit(".example.org")).alias("base_url"),
        F.when(F.col("n_nationkey") % 3 == 0, "onion").otherwise("clearnet").alias("source_type"),
        (F.col("n_nationkey") % 4 != 0).alias("is_active"),
    )


FORUMS = """forums AS (
  SELECT 'src' || n_nationkey AS forum, 'https://src' || n_nationkey || '.example.org' AS base_url,
         CASE WHEN n_nationkey % 3 = 0 THEN 'onion' ELSE 'clearnet' END AS source_type,
         n_nationkey % 4 <> 0 AS is_active
  FROM nation)"""


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """events as crawl runs; a view is a run still going."""
    e = table(spark, folder, "events")
    status = (
        F.when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "view", "running").otherwise("done")
    )
    done = F.expr("timestampadd(SECOND, cast(floor(value) as int), ts)")
    return e.select(
        F.col("event_id").alias("run_id"), F.concat(F.lit("src"), F.col("user_id") % 22).alias("forum"),
        F.col("ts").alias("started_at"), status.alias("status"),
        F.when(F.col("event_type") != "view", done).alias("finished_at"),
    )


RUNS = """runs AS (
  SELECT event_id AS run_id, 'src' || (user_id % 22) AS forum, ts AS started_at,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' ELSE 'done' END AS status,
         CASE WHEN event_type <> 'view' THEN ts + to_seconds(CAST(floor(value) AS BIGINT)) END AS finished_at
  FROM events)"""


def flagged(spark: SparkSession, folder: str) -> DataFrame:
    """Threads flagged earlier: those with a label; reviewed where of good quality."""
    t = threads(spark, folder).select("doc_id", "dedup_hash")
    l = table(spark, folder, "labels").select("doc_id", (F.col("quality") == 1).alias("reviewed"))
    return t.join(l, "doc_id")


FLAGGED = """flagged AS (
  SELECT t.doc_id, t.dedup_hash, l.quality = 1 AS reviewed FROM threads t JOIN labels l USING (doc_id))"""


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """conversations as channel messages; date, media and views follow from the keys."""
    c = table(spark, folder, "conversations")
    n = F.col("conv_id") + F.col("turn")
    media = (
        F.when(n % 5 == 0, "MessageMediaPhoto").when(n % 5 == 1, "MessageMediaDocument")
        .when(n % 5 == 2, "MessageMediaWebPage")
    )
    ext = F.when(F.col("conv_id") % 3 == 0, ".mp4").when(F.col("conv_id") % 3 == 1, ".pdf")
    return derive_message_row(
        c,
        {
            "message_id": F.col("turn"),
            "date": F.expr("timestampadd(MINUTE, cast(conv_id * 60 + turn as int), timestamp_ntz'2024-01-01 00:00:00')"),
            "username": F.col("role"),
            "first_name": F.initcap("role"),
            "message": F.col("text"),
            "media_type": media,
            "media_path": F.when(media != "MessageMediaWebPage", F.concat(F.lit("media/"), n.cast("string"), ext)),
            "views": F.length("text") % 100,
            "channel": F.col("conv_id"),
        },
    )


MESSAGES = """messages AS (
  SELECT turn AS message_id, TIMESTAMP '2024-01-01' + to_minutes(conv_id * 60 + turn) AS date,
         role AS username, upper(left(role, 1)) || substr(role, 2) AS first_name,
         CAST(NULL AS VARCHAR) AS last_name, text AS message, media_type,
         CASE WHEN media_type <> 'MessageMediaWebPage' AND ext IS NOT NULL
              THEN 'media/' || (conv_id + turn) || ext END AS media_path,
         length(text) % 100 AS views, conv_id AS channel
  FROM (SELECT *, CASE (conv_id + turn) % 5 WHEN 0 THEN 'MessageMediaPhoto' WHEN 1 THEN 'MessageMediaDocument'
                       WHEN 2 THEN 'MessageMediaWebPage' END AS media_type,
               CASE conv_id % 3 WHEN 0 THEN '.mp4' WHEN 1 THEN '.pdf' END AS ext
        FROM conversations))"""

KINDS = {"signup": "password", "error": "token", "purchase": "card", "click": "cookie", "view": "autofill"}


def host_counts(spark: SparkSession, folder: str) -> DataFrame:
    """events as counts per host and kind."""
    e = table(spark, folder, "events")
    kind = F
    for event, name in KINDS.items():
        kind = kind.when(F.col("event_type") == event, name)
    return e.select(F.col("user_id").alias("host_id"), kind.alias("kind"), F.lit(1).cast("long").alias("n"))


HOST_COUNTS = "host_counts AS (SELECT user_id AS host_id, CASE event_type " + " ".join(
    f"WHEN '{e}' THEN '{k}'" for e, k in KINDS.items()
) + " END AS kind, 1 AS n FROM events)"


def page_files(spark: SparkSession, folder: str) -> DataFrame:
    """pages as a file catalog: the address is the path, a trailing slash a directory."""
    p = table(spark, folder, "pages")
    path = F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "^https?://", "")
    base = p.select(
        "page_id", F.regexp_replace(path, "/$", "").alias("path"), path.endswith("/").alias("dir"),
        F.octet_length("html").alias("size"),
    )
    return catalog_columns(base, "path", "size", F.col("dir"))


_P = sub("path", "/$", "")
PAGE_FILES = f"""page_files AS (
  SELECT relative_path, filename, CASE WHEN NOT is_directory THEN ext END AS extension, file_size_bytes,
         regexp_extract(relative_path, '([^/]+)/[^/]*$', 1) AS parent_directory,
         regexp_extract(relative_path, '^(.*)/[^/]*$', 1) AS parent_path,
         CASE WHEN is_directory THEN n_parts - 1 ELSE n_parts END AS depth_level, is_directory,
         CASE WHEN NOT is_directory THEN ltrim(ext, '.') END AS estimated_type, 'pending' AS processing_status
  FROM (SELECT *, string_split(relative_path, '/')[-1] AS filename, len(string_split(relative_path, '/')) AS n_parts,
               lower(regexp_extract(string_split(relative_path, '/')[-1], '^.+(\\.[^.]*[^.])$', 1)) AS ext
        FROM (SELECT page_id, {_P} AS relative_path, ends_with(path, '/') AS is_directory, strlen(html) AS file_size_bytes
              FROM (SELECT *, {sub(sub('url', '[?#].*$', ''), '^https?://', '')} AS path FROM pages)))
  WHERE NOT list_has_any(string_split(relative_path, '/'), ['__MACOSX', 'venv', '.git', '__pycache__']))"""


def lines_of(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, pos, line) of every line."""
    from exposura.functions.lines import split_lines

    return df.select(key, F.posexplode(split_lines(F.col(column))).alias("pos", "line"))


LINES = """lines AS (
  SELECT doc_id, unnest(range(len(a))) AS pos, unnest(a) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents))"""


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """orders under raw transaction headers."""
    o = table(spark, folder, "orders")
    return o.select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("user_id"),
        F.concat(F.lit(" R"), F.col("o_orderkey")).alias("purchase_reference_id"),
        F.when(F.col("o_orderstatus") == "F", "n/a").otherwise(F.col("o_orderstatus")).alias("payment_country"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("revenue_country"),
        F.format_string("%.2f", F.col("o_totalprice")).alias("charge_amount"),
        F.when(F.col("o_orderkey") % 7 == 0, "0000-00-00 00:00:00")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("transaction_time"),
    )


TRANSACTIONS = """transactions AS (
  SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS user_id, ' R' || o_orderkey AS purchase_reference_id,
         CASE WHEN o_orderstatus = 'F' THEN 'n/a' ELSE o_orderstatus END AS payment_country,
         CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS revenue_country,
         printf('%.2f', o_totalprice) AS charge_amount,
         CASE WHEN o_orderkey % 7 = 0 THEN '0000-00-00 00:00:00'
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS transaction_time
  FROM orders)"""


def owned_domains(spark: SparkSession, folder: str) -> DataFrame:
    """The watchlist: domains of the pages served over https, and the mail domains m < 6."""
    from_pages = table(spark, folder, "pages").filter(F.col("url").startswith("https:")).select(
        text.registered_domain(F.col("url"), SUFFIXES).alias("domain")
    )
    from_mail = table(spark, folder, "nation").filter(F.col("n_nationkey") < 6).select(
        F.concat(F.lit("mail"), F.col("n_nationkey"), F.lit(".example.com")).alias("domain")
    )
    return from_pages.filter(F.col("domain") != "").unionByName(from_mail).distinct()


def sql_domain(x: str) -> str:
    """SQL for registered_domain."""
    tail = f"string_split({x}, '@')[-1]"
    host = f"lower(regexp_extract(regexp_replace({tail}, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^([^/:?#\\s]+)', 1))"
    return (
        f"coalesce(nullif(regexp_extract({host}, '([^.]+\\.example\\.(com|net|org))$', 1), ''),"
        f" regexp_extract({host}, '([^.]+\\.(com|net|org))$', 1))"
    )


OWNED = f"""owned AS (
  SELECT DISTINCT domain FROM (
    SELECT {sql_domain('url')} AS domain FROM pages WHERE starts_with(url, 'https:')
    UNION ALL SELECT 'mail' || n_nationkey || '.example.com' FROM nation WHERE n_nationkey < 6)
  WHERE domain <> '')"""
