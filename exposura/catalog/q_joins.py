"""Joins (survey 2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from exposura import rules
from exposura.catalog import views as v
from exposura.catalog.base import case_first, q, query, stamp
from exposura.functions import files, text
from exposura.operators import joins as j
from exposura.plans import jobs
from exposura.sources.readers import table


@query("new_only", f"""
WITH {v.THREADS}, {v.FLAGGED} SELECT doc_id, dedup_hash FROM threads
WHERE dedup_hash IS NOT NULL AND dedup_hash NOT IN (SELECT dedup_hash FROM flagged WHERE dedup_hash IS NOT NULL)""")
def new_only(spark, folder):
    t = v.threads(spark, folder).filter(F.col("dedup_hash").isNotNull()).select("doc_id", "dedup_hash")
    return j.new_only(t, v.flagged(spark, folder), "dedup_hash")


@query("already_seen", f"""
WITH {v.THREADS}, {v.FLAGGED} SELECT doc_id, dedup_hash FROM threads WHERE dedup_hash IN (SELECT dedup_hash FROM flagged)""")
def already_seen(spark, folder):
    return j.already_seen(v.threads(spark, folder).select("doc_id", "dedup_hash"), v.flagged(spark, folder), "dedup_hash")


@query("registry_anti", """
WITH r AS (SELECT DISTINCT sha256(text) AS h FROM documents SEMI JOIN labels USING (doc_id))
SELECT doc_id, sha256(text) AS content_hash FROM documents WHERE sha256(text) NOT IN (SELECT h FROM r)""")
def registry_anti(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", files.digest(F.col("text")).alias("content_hash"))
    registry = d.join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    return j.new_only(d, registry, "content_hash").select("doc_id", "content_hash")


@query("forum_thread_counts", f"""
WITH {v.FORUMS}, {v.THREADS} SELECT f.forum, count(t.doc_id) AS n_threads,
  count(*) FILTER (length(t.content) > 1000) AS n_with_content FROM forums f LEFT JOIN threads t USING (forum) GROUP BY f.forum""")
def forum_thread_counts(spark, folder):
    t = v.threads(spark, folder).select("forum", "n_chars")
    return j.count_by_dimension(
        v.forums(spark, folder).select("forum"), t, "forum",
        {"n_threads": F.count("*"), "n_with_content": F.count_if(F.col("n_chars") > 1000)},
    )


@query("forum_latest_run", f"""
WITH {v.FORUMS}, {v.RUNS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY forum ORDER BY started_at DESC, run_id DESC) AS r FROM runs)
SELECT f.forum, coalesce(status, 'never') AS status, {stamp('started_at')} AS started_at
FROM forums f LEFT JOIN ranked r ON f.forum = r.forum AND r.r = 1""")
def forum_latest_run(spark, folder):
    out = j.latest_by_dimension(
        v.forums(spark, folder).select("forum"), v.runs(spark, folder), "forum", ["started_at", "run_id"],
        ["status", "started_at"],
    )
    return out.select("forum", F.coalesce("status", F.lit("never")).alias("status"), v.stamp("started_at").alias("started_at"))


@query("country_lookup", """
SELECT c_custkey, CASE WHEN n_nationkey < 20 THEN n_name END AS country_name
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def country_lookup(spark, folder):
    """Nations stand for countries, letter pairs for their codes; the last five are unknown."""
    def code(c):
        return F.concat(F.lit("N"), F.char(F.lit(65) + c))

    countries = table(spark, folder, "nation").filter("n_nationkey < 20").select(
        code(F.col("n_nationkey")).alias("country_code"), F.col("n_name").alias("country_name")
    )
    c = table(spark, folder, "customer").select("c_custkey", F.lower(code(F.col("c_nationkey"))).alias("code"))
    return j.country_lookup(c, "code", countries).select("c_custkey", "country_name")


PART_LABELS = {"gear": "wheel", "red": "warm", "red gear": "gearing", "hot": "warm", "small": "tiny", "small ring": "jewel"}


def _label_sql(pairs) -> str:
    test = case_first([(f"contains(lower(n), {q(k)})", q(x)) for k, x in pairs], "coalesce(nullif(n, ''), 'Unknown')")
    return f"SELECT p_partkey, {test} AS label FROM (SELECT p_partkey, CASE WHEN p_size = 1 THEN '' ELSE upper(p_name) END AS n FROM part)"


def _part_names(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", F.when(F.col("p_size") == 1, "").otherwise(F.upper("p_name")).alias("n")
    )


@query("canonical_label", _label_sql(sorted(PART_LABELS.items(), key=lambda kv: -len(kv[0]))))
def canonical_label(spark, folder):
    return _part_names(spark, folder).select("p_partkey", text.canonical_label(F.col("n"), PART_LABELS).alias("label"))


@query("canonical_label_first", _label_sql(PART_LABELS.items()))
def canonical_label_first(spark, folder):
    return _part_names(spark, folder).select("p_partkey", text.canonical_label_first(F.col("n"), PART_LABELS).alias("label"))


LAYOUTS = [("blog.", "blog"), ("spam", "farm"), ("www.", "plain"), ("th", "prose")]


@query("dispatch_by_domain", f"""
SELECT page_id, {case_first([(f"contains(h, {q(k)})", q(x)) for k, x in LAYOUTS])} AS layout
FROM (SELECT page_id, lower(regexp_extract(url, 'https?://([^/:]+)', 1)) AS h FROM pages)""")
def dispatch_by_domain(spark, folder):
    host = text.host_of(F.col("url"))
    rule = text.first_rule([(host.contains(k), x) for k, x in LAYOUTS])
    return table(spark, folder, "pages").select("page_id", rule.alias("layout"))


TAXONOMY = {"gear": "machine", "bolt": "fixing", "widget": "machine", "ring": "ornament", "red": "colour"}
EXCLUDED = rules.SOFTWARE_EXCLUDED + ["old"]


@query("taxonomy_label", f"""
SELECT name, category FROM (SELECT DISTINCT p_name AS name,
  {case_first([(f"contains(lower(p_name), {q(k)})", q(x)) for k, x in TAXONOMY.items()])} AS category FROM part
  WHERE NOT ({' OR '.join(f"contains(lower(p_name), {q(x)})" for x in EXCLUDED)})
    AND (NOT contains(p_name, 'driver') OR contains(p_name, 'chipset')))
WHERE category IS NOT NULL""")
def taxonomy_label(spark, folder):
    return j.taxonomy_label(table(spark, folder, "part"), "p_name", TAXONOMY, EXCLUDED)


@query("fallback_join", """
WITH c AS (SELECT DISTINCT event_type AS name FROM events),
a AS (SELECT * FROM (VALUES ('click', 'url'), ('signup', 'username')) t(name, target))
SELECT upper(c.name) AS name, coalesce(a.target, upper(c.name)) AS target FROM c LEFT JOIN a USING (name)""")
def fallback_join(spark, folder):
    columns = table(spark, folder, "events").select(F.upper("event_type").alias("name")).distinct()
    aliases = spark.createDataFrame([("click", "url"), ("signup", "username")], "name string, target string")
    return j.fallback_join(columns, aliases)


EXPOSURE = f"""
WITH {v.THREADS}, {v.OWNED},
found AS (
  SELECT doc_id, forum, crawled_at, 'email' AS kind, unnest(regexp_extract_all(content, {q(rules.EMAIL)})) AS x FROM threads
  UNION ALL SELECT doc_id, forum, crawled_at, 'url', unnest(regexp_extract_all(content, 'https?://[A-Za-z0-9.-]+')) FROM threads),
hits AS (SELECT forum, strftime(crawled_at, '%Y-%m-%d') AS day, kind, {v.sql_domain('x')} AS domain FROM found)"""


@query("watchlist_exposure", EXPOSURE + """
SELECT domain, kind, forum, day, count(*) AS n FROM hits JOIN owned USING (domain) GROUP BY ALL""")
def watchlist_exposure(spark, folder):
    return exposure(spark, folder).select("domain", "kind", "forum", "day", "n")


def exposure(spark, folder):
    t = v.threads(spark, folder).select("forum", F.date_format("crawled_at", "yyyy-MM-dd").alias("day"), "content")
    return jobs.watchlist_exposure(t, v.owned_domains(spark, folder), ["forum", "day"], "content", v.SUFFIXES)
