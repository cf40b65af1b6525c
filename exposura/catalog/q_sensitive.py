"""Sensitive-content detection and the exposure report (survey 2.14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from exposura import rules
from exposura.catalog import views as v
from exposura.catalog.base import q, query, sql_redacted
from exposura.catalog.q_joins import EXPOSURE, exposure
from exposura.plans import jobs
from exposura.sources.readers import table


def _len(*patterns: str) -> str:
    return " + ".join(f"len(regexp_extract_all(text, {q(p)}))" for p in patterns)


# One invented value of every kind; planted into every third text.
PLANTED = (
    "\n(555) 010-9999 and 2001:db8::1 with Bearer abcd.efgh-1234, sk_live_ABCDEFGHIJKLMNOP1234\napi-key: \"my long value\" password='two words'\n"
    "eyJhbGciOi.eyJzdWIiOi.c2lnbmF0dXJl\n-----BEGIN RSA PRIVATE KEY-----\nAAAAinvented\n-----END RSA PRIVATE KEY-----\n")
PLANTED_SQL = f"d AS (SELECT doc_id, source, CASE WHEN doc_id % 3 = 0 THEN text || {q(PLANTED)} ELSE text END AS text FROM documents)"


def _planted(spark, folder):
    more = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(PLANTED))).otherwise(F.col("text"))
    return table(spark, folder, "documents").select("doc_id", "source", more.alias("text"))


LUHN = """(list_sum(list_transform(range(1, length(c) + 1), lambda i:
  CASE WHEN i % 2 = 1 THEN CAST(reverse(c)[i] AS INTEGER)
       WHEN CAST(reverse(c)[i] AS INTEGER) > 4 THEN CAST(reverse(c)[i] AS INTEGER) * 2 - 9
       ELSE CAST(reverse(c)[i] AS INTEGER) * 2 END)) % 10 = 0)"""


@query("pii_scan", f"""
WITH {PLANTED_SQL}, cards AS (SELECT doc_id, count(*) FILTER ({LUHN}) AS n FROM (
  SELECT doc_id, regexp_replace(unnest(regexp_extract_all(text, {q(rules.CARD)})), '[ -]', '', 'g') AS c FROM d) GROUP BY doc_id)
SELECT doc_id, {_len(rules.EMAIL)} AS n_email,
  len(list_filter(regexp_extract_all(text, {q(rules.PHONE)}), lambda p: length(regexp_replace(p, '[^0-9]', '', 'g')) BETWEEN 7 AND 15))
    + {_len(rules.LOCAL_PHONE)} AS n_phone,
  {_len(rules.IPV4, rules.IPV6)} AS n_ip, coalesce(n, 0) AS n_card, {_len(rules.KEY, rules.SERVICE_KEY, rules.KEY_BLOCK)} AS n_key,
  {_len(rules.TOKEN, rules.BEARER)} AS n_token, {_len(rules.SECRET)} AS n_secret
FROM d LEFT JOIN cards USING (doc_id)""")
def pii_scan(spark, folder):
    return jobs.pii_scan(_planted(spark, folder), "doc_id", "text")


MASKS = r"\[(EMAIL|KEY|PHONE|CARD|IP|SECRET|TOKEN)\]"


@query("redact", f"""
WITH {PLANTED_SQL} SELECT doc_id, length(t) AS n_chars, md5(t) AS text_hash, len(regexp_extract_all(t, {q(MASKS)})) AS n_masked
FROM (SELECT doc_id, {sql_redacted('text')} AS t FROM d)""")
def redact(spark, folder):
    d = jobs.redact(_planted(spark, folder).select("doc_id", "text"), "text")
    return d.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_hash"),
        F.regexp_count("text", F.lit(MASKS)).cast("long").alias("n_masked"),
    )


@query("pii_by_source", f"""
WITH s AS (SELECT source, {_len(rules.EMAIL)} AS n_email, {_len(rules.IPV4, rules.IPV6)} AS n_ip,
  {_len(rules.KEY, rules.SERVICE_KEY, rules.KEY_BLOCK)} AS n_key FROM documents)
SELECT source, CAST(sum(n_email) AS BIGINT) AS n_email, CAST(sum(n_ip) AS BIGINT) AS n_ip, CAST(sum(n_key) AS BIGINT) AS n_key FROM s GROUP BY source""")
def pii_by_source(spark, folder):
    from exposura.functions.sensitive import pii_counts

    counts = pii_counts(F.col("text"))
    d = table(spark, folder, "documents").select("source", *[counts[k].alias(k) for k in ("n_email", "n_ip", "n_key")])
    return d.groupBy("source").agg(*[F.sum(k).alias(k) for k in ("n_email", "n_ip", "n_key")])


@query("exposure_report", EXPOSURE + """
, c AS (SELECT domain, kind, forum, day, count(*) AS n FROM hits JOIN owned USING (domain) GROUP BY ALL)
SELECT domain, kind, forum, day, CAST(sum(n) AS BIGINT) AS n, count(DISTINCT domain) AS n_domains,
       least(10.0, sum(n) * 0.1)::DOUBLE AS risk_score
FROM c GROUP BY ROLLUP (domain, kind, forum, day)""")
def exposure_report(spark, folder):
    report = jobs.exposure_report(exposure(spark, folder), ["domain", "kind", "forum", "day"])
    score = F.least(F.lit(10).cast("decimal(18,1)"), (F.col("n") * F.lit("0.1").cast("decimal(4,1)")).cast("decimal(18,1)"))
    return report.withColumn("risk_score", score.cast("double"))
