"""Dedup, keyword matching and the flagship report (survey 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from exposura.catalog import views as v
from exposura.catalog.base import q, query, sql_list, strip
from exposura.functions import files, text
from exposura.operators import dedup, joins
from exposura.plans import jobs
from exposura.sources.readers import table

HITS = (
    f"list_filter({sql_list(v.KEYWORDS)}, lambda k: "
    "contains(lower(coalesce(title, '') || ' ' || coalesce(content, '')), k))"
)


@query("thread_hash", f"""
WITH {v.THREADS} SELECT doc_id, sha256(concat({strip('lower(title)')}, '|', forum)) AS thread_hash FROM threads""")
def thread_hash(spark, folder):
    t = v.threads(spark, folder)
    return t.select("doc_id", dedup.thread_hash(F.col("title"), F.col("forum")).alias("thread_hash"))


@query("unique_sparse", f"""
WITH {v.THREADS} SELECT min(doc_id) AS doc_id, dedup_hash, first(forum ORDER BY doc_id) AS forum
FROM threads WHERE dedup_hash IS NOT NULL GROUP BY dedup_hash
UNION ALL SELECT doc_id, dedup_hash, forum FROM threads WHERE dedup_hash IS NULL""")
def unique_sparse(spark, folder):
    t = v.threads(spark, folder).select("doc_id", "dedup_hash", "forum")
    return dedup.unique_sparse(t, "dedup_hash", ["doc_id"], ["doc_id", "dedup_hash", "forum"])


@query("dedup_files", """
SELECT sha256(text) AS content_hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1""")
def dedup_files(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", files.digest(F.col("text")).alias("content_hash"))
    return d.groupBy("content_hash").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("md5_digest", "SELECT doc_id, md5(text) AS md5_hash FROM documents")
def md5_digest(spark, folder):
    return table(spark, folder, "documents").select("doc_id", files.md5_digest(F.col("text")).alias("md5_hash"))


@query("dedup_composite", """
SELECT min(o_orderkey) AS o_orderkey, o_custkey,
       first(o_orderpriority ORDER BY o_orderkey) AS o_orderpriority
FROM orders GROUP BY o_custkey, lower(o_orderpriority)""")
def dedup_composite(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cols = ["o_orderkey", "o_custkey", "o_orderpriority"]
    return dedup.dedup_composite(o, ["o_custkey", "o_orderpriority"], ["o_orderkey"], cols)


@query("insert_or_ignore", """
WITH old AS (SELECT user_id, event_id, event_type FROM (
       SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events
       WHERE ts < TIMESTAMP '2024-01-02') WHERE r = 1),
     new AS (SELECT user_id, event_id, event_type FROM (
       SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events
       WHERE ts >= TIMESTAMP '2024-01-02') WHERE r = 1)
SELECT * FROM old UNION ALL SELECT * FROM new WHERE user_id NOT IN (SELECT user_id FROM old)""")
def insert_or_ignore(spark, folder):
    e = table(spark, folder, "events").select("user_id", "event_id", "event_type", "ts")
    day = F.lit("2024-01-02").cast("timestamp_ntz")
    cols = ["user_id", "event_id", "event_type"]
    from exposura.operators.windows import first_per_key

    old = first_per_key(e.filter(F.col("ts") < day), ["user_id"], ["event_id"], cols)
    return dedup.insert_or_ignore(old, e.filter(F.col("ts") >= day).select(*cols), ["user_id"], ["event_id"])


@query("entry_dedup", f"""
WITH {v.THREADS} SELECT min(doc_id) AS doc_id, forum, count(*) AS n
FROM threads WHERE {strip('title')} <> '' GROUP BY forum, lower(title)""")
def entry_dedup(spark, folder):
    t = v.threads(spark, folder).select("doc_id", "forum", "title")
    first = dedup.entry_dedup(t, "forum", "title", ["doc_id"], ["doc_id", "forum", "title"])
    sizes = t.filter(text.strip(F.col("title")) != "").groupBy("forum", F.lower("title").alias("_t")).agg(
        F.count("*").alias("n")
    )
    keyed = first.withColumn("_t", F.lower("title"))
    return keyed.join(sizes, ["forum", "_t"]).select("doc_id", "forum", "n")


@query("ordered_distinct", """
WITH words AS (SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS w FROM (
  SELECT doc_id, string_split(replace(text, chr(10), ' '), ' ') AS a FROM documents)),
firsts AS (SELECT doc_id, w, min(i) AS i FROM words GROUP BY doc_id, w)
SELECT doc_id, count(*) AS n_distinct, md5(string_agg(w, ' ' ORDER BY i)) AS words_hash FROM firsts GROUP BY doc_id""")
def ordered_distinct(spark, folder):
    d = table(spark, folder, "documents")
    words = F.array_distinct(F.split("text", "[ \n]", -1))
    return d.select("doc_id", F.size(words).cast("long").alias("n_distinct"), F.md5(F.array_join(words, " ")).alias("words_hash"))


@query("keyword_flag", f"""
WITH {v.THREADS} SELECT doc_id, array_to_string({HITS}, ',') AS matched FROM threads WHERE len({HITS}) > 0""")
def keyword_flag(spark, folder):
    t = dedup.keyword_flagged(v.threads(spark, folder), "title", "content", v.KEYWORDS)
    return t.select("doc_id", F.array_join("matched_keywords", ",").alias("matched"))


@query("flag_incremental", f"""
WITH {v.THREADS}, {v.FLAGGED}
SELECT doc_id, dedup_hash, array_to_string({HITS}, ',') AS matched, strftime(crawled_at, '%Y-%m-%d') AS flagged_at,
       false AS reviewed
FROM threads WHERE dedup_hash IS NOT NULL AND len({HITS}) > 0
  AND dedup_hash NOT IN (SELECT dedup_hash FROM flagged WHERE dedup_hash IS NOT NULL)""")
def flag_incremental(spark, folder):
    out = jobs.flag_incremental(
        v.threads(spark, folder), v.flagged(spark, folder), v.KEYWORDS,
        flagged_at=F.date_format("crawled_at", "yyyy-MM-dd"),
    )
    return out.select(
        "doc_id", "dedup_hash", F.array_join("matched_keywords", ",").alias("matched"), "flagged_at", "reviewed"
    )


@query("flag_report", f"""
WITH {v.THREADS},
hits AS (SELECT doc_id, forum, dedup_hash, len({HITS}) AS n_hits FROM threads),
uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dedup_hash ORDER BY doc_id) AS r FROM hits)
         WHERE r = 1 OR dedup_hash IS NULL)
SELECT forum, count(*) AS n_threads, count(*) FILTER (n_hits > 0) AS n_flagged,
       CAST(sum(n_hits) AS BIGINT) AS n_hits FROM uniq GROUP BY forum""")
def flag_report(spark, folder):
    return jobs.flag_report(v.threads(spark, folder), "doc_id", v.KEYWORDS)


@query("keyword_table", """
SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text))""")
def keyword_table(spark, folder):
    """keyword_flag with a table of phrases in place of a word list."""
    d, b = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return joins.contains_matches(d, "doc_id", "text", b.withColumnRenamed("text", "phrase"), "item_id", "phrase")


@query("keyword_table_by_grams", """
SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text))""")
def keyword_table_by_grams(spark, folder):
    """The same for a phrase table too large to be held as literals."""
    d, b = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return joins.contains_by_grams(d, "doc_id", "text", b.withColumnRenamed("text", "phrase"), "item_id", "phrase")


@query("ingest_files", f"""
WITH {v.LINES}, known AS (SELECT sha256(text) AS h FROM documents SEMI JOIN labels USING (doc_id)),
s AS (SELECT doc_id, {strip('line')} AS line FROM lines
  WHERE {strip('line')} <> '' AND NOT starts_with({strip('line')}, '#') QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY pos) <= 20),
m AS (SELECT doc_id, avg(length(line) - length(replace(line, ',', '')) + 1) AS fields,
  avg(length(replace(line, '://', '')) - length(replace(replace(line, '://', ''), ':', ''))) AS colons FROM s GROUP BY doc_id),
shapes AS (SELECT doc_id, sha256(text) AS content_hash, strlen(text) AS size, CASE WHEN fields IS NULL THEN 'list' WHEN fields >= 8 THEN 'table'
    WHEN colons >= 0.8 AND fields < 4 THEN 'list' ELSE 'undecided' END AS shape FROM documents LEFT JOIN m USING (doc_id))
SELECT content_hash, doc_id, size, shape FROM shapes WHERE content_hash NOT IN (SELECT h FROM known)
QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY doc_id) = 1""")
def ingest_files(spark, folder):
    """Catalog, dedup against the registry and classification in one job.

    An inner join, as a semi join would be moved below the digest and shuffle the texts.
    """
    d = table(spark, folder, "documents").select("doc_id", "text")
    digests = d.select("doc_id", files.digest(F.col("text")).alias("sha256"))
    registry = digests.join(table(spark, folder, "labels").select("doc_id").distinct(), "doc_id").select("sha256")
    out = jobs.ingest(d, registry, "doc_id", "text")
    return out.select(
        F.col("sha256").alias("content_hash"), "doc_id", F.col("size").cast("long").alias("size"), "shape"
    )


@query("score_by_country", f"""
WITH {v.HOST_COUNTS}, p AS (SELECT host_id, count(*) FILTER (kind = 'password') AS pw, count(*) FILTER (kind = 'token') AS tk,
  count(*) FILTER (kind = 'card') AS cd, count(*) FILTER (kind = 'cookie') AS ck, count(*) FILTER (kind = 'autofill') AS af FROM host_counts GROUP BY host_id),
t AS (SELECT host_id, least(100000, least(30000, pw * 1000) + CASE WHEN tk > 0 THEN 20000 ELSE 0 END + CASE WHEN cd > 0 THEN 10000 ELSE 0 END
  + least(10000, ck * 10) + least(5000, af * 100)) AS t FROM p),
s AS (SELECT host_id, t // 1000 + CASE WHEN t % 1000 > 500 OR (t % 1000 = 500 AND (t // 1000) % 2 = 1) THEN 1 ELSE 0 END AS tenths FROM t)
SELECT n_name AS country_name, count(*) AS n_hosts, max(tenths) / 10.0::DOUBLE AS max_score,
       CAST(sum(tenths) AS BIGINT) AS score_tenths FROM s JOIN nation ON n_nationkey = host_id % 25 GROUP BY n_name""")
def score_by_country(spark, folder):
    """Host counts to scores to a rollup per country."""
    scores = jobs.score_hosts(v.host_counts(spark, folder), "host_id", "kind", "n")
    coded = scores.withColumn("code", F.concat(F.lit("n"), (F.col("host_id") % 25).cast("string")))
    countries = table(spark, folder, "nation").select(
        F.concat(F.lit("N"), "n_nationkey").alias("country_code"), F.col("n_name").alias("country_name")
    )
    named = joins.country_lookup(coded, "code", countries)
    tenths = F.round(F.col("risk_score") * 10).cast("long")
    return named.groupBy("country_name").agg(
        F.count("*").alias("n_hosts"), F.max("risk_score").alias("max_score"), F.sum(tenths).alias("score_tenths")
    )
